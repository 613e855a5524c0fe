"""Incremental survey ingestion with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.aggregates import MAX_COMMENTS, finish_feedback, join_comments, page_statistics, rated_pages
from ..plans.survey import clean_survey, map_product
from ..session import materialize

KEYS = ["canonical_url", "product"]


def answers_once(answers: DataFrame, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each response id once.

    Without a watermark every id is remembered in the state store, so a repeat is caught however
    late it comes (use the RocksDB provider for large state). ``watermark`` is (time column, delay): state
    is then bounded, and an answer later than the delay is no longer told from a repeat.
    """
    if watermark:
        return answers.withWatermark(*watermark).dropDuplicatesWithinWatermark(["response_id"])
    return answers.dropDuplicates(["response_id"])


def run_feedback_stream(
    answers: DataFrame,
    target: str,
    *,
    origin: str,
    products: DataFrame,
    rules: DataFrame | None = None,
    exclude: DataFrame | None = None,
    watermark: tuple[str, str] | None = None,
) -> None:
    """Process all data that is available, then stop; call again for what arrives later.

    Every batch goes through the cleaning of a whole survey (redirects, exclusion, e-mail scrub) and
    the product map. A batch overwrites its own folder only, so a repeated batch leaves the same result.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch, "new-answers")  # cleaning reads it more than once; the states are visited once
        cleaned = clean_survey(batch, origin=origin, rules=rules, exclude=exclude)
        mapped = map_product(cleaned, "canonical_url", products)
        rated = rated_pages(mapped, url="canonical_url", rating="q1", comment="q2", date="start_date", order="row_id", product=F.col("product"))
        rows = f"{target}/rows/batch={batch_id}"
        rated.write.mode("overwrite").parquet(rows)
        stored = batch.sparkSession.read.schema(rated.schema).parquet(rows)
        page_statistics(stored, KEYS, "q1", "q2").write.mode("overwrite").parquet(f"{target}/statistics/batch={batch_id}")

    started = (
        answers_once(answers, watermark)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()


def read_feedback(spark: SparkSession, target: str, max_comments: int = MAX_COMMENTS) -> DataFrame:
    """Feedback per page over all batches so far: the sums merge, the comments keep row order."""
    statistics = (
        spark.read.parquet(f"{target}/statistics")
        .groupBy(*KEYS)
        .agg(F.sum("sum_q1").alias("sum_q1"), F.sum("n").alias("n"), F.sum("n_comments").alias("n_comments"))
    )
    rows = spark.read.parquet(f"{target}/rows").drop("batch")
    return finish_feedback(statistics, join_comments(rows, KEYS, "q2", ["row_id"], max_comments), KEYS)
