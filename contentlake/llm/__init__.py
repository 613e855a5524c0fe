"""Operators that prepare training data for language models.

Functions of this package travel to the executors by value, so a job only needs the package where
its driver runs.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
