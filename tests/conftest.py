import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contentlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Run a column function over a list of values (or tuples of values), keeping their order."""

    def run(values, fn):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        names = [f"c{k}" for k in range(len(rows[0]) - 1)]
        df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names))
        out = df.select("i", fn(*names).alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]

    return run
