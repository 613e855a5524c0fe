"""A training corpus from raw documents: reject toxic ones, keep one of each group of near copies,
drop documents with benchmark passages, mix the sources to target weights, and deal the result into
shards.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns the columns of documents;
the last one adds shard and slot. Stages keep null texts, empty tables and extra columns as their operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contentlake.llm import toxicity
from contentlake.llm.decontamination import decontaminate
from contentlake.llm.jaccard_join import keep_one
from contentlake.llm.mixing import mixed_documents
from contentlake.llm.sharding import shard_wide_rows
from contentlake.llm.tables import q, table
from contentlake.session import limit_batches, materialize

#: Documents at or above this score are rejected.
TOXIC = 0.7
SHARDS = 24


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below ``TOXIC``, learned from the labels of ``docs``."""
    limit_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(F.struct(*[q(c) for c in docs.columns]).alias("row"), q("text").alias("text")), model)
    return scored.filter(F.col("score") < TOXIC).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by five-word shingle similarities of 0.8 or more."""
    return keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or runs of their words, drawn so that the sources meet their target weights."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into shards of equal numbers of rows."""
    return shard_wide_rows(docs, SHARDS)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: Boosted trees, SimHash windows and the random draws are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
