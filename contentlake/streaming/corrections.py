"""Feedback ingestion with corrections: the newest answer of every response counts, its older ones are taken back.

The state of a response is its last answer; the states of many responses are kept together, by a hash. A newer one yields two signed rows: the new answer and, taken back, the
old one. Both go through the cleaning of a survey and add to the sums of their pages, so a batch writes only the pages that its answers
touch, and the sums over all batches equal those of a fresh run over the newest answers.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.aggregates import MAX_COMMENTS, finish_feedback, join_comments, rated_pages
from ..operators.skew import lookup_join, stored
from ..plans.survey import clean_survey, map_product
from ..session import materialize
from .feedback import KEYS

#: Folders of the rows of a batch, by a hash of the page.
BUCKETS = 16


#: Groups of responses whose last answers lie together in one state; fixed for the life of a checkpoint.
STATE_GROUPS = 1024


def _answers_schema(answers: DataFrame) -> pa.Schema:
    """Arrow types of the answers; times without a zone, as pandas has them."""
    fields = [(f.name, pa.timestamp("us") if pa.types.is_timestamp(f.type) else f.type) for f in to_arrow_schema(answers.schema)]
    return pa.schema(fields)


def _packed(answers: pd.DataFrame, schema: pa.Schema) -> bytes:
    """Answers as one compressed Arrow stream."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(pa.Table.from_pandas(answers, schema=schema, preserve_index=False))
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_pandas()


def signed_answers(
    answers: DataFrame, key: str = "response_id", version: str = "row_id", forget: tuple[str, str] | None = None, groups: int = STATE_GROUPS
) -> DataFrame:
    """The stream's changes: columns of ``answers`` and ``sign``, 1 for an answer that counts now, -1 for the one it replaces.

    The larger ``version`` is the newer answer; an older or equal one that comes late changes nothing. ``forget``, (time column,
    delay), ends the state of a response once the watermark has passed its last answer by the delay: what was counted stays counted,
    and an answer later than that counts as the first of its response. Answers without ``key`` have no state in common and are left out.

    The last answers of all responses lie in ``groups`` states by a hash of ``key``, so a batch calls Python once a group and
    compares whole columns, not once a response. A batch rewrites the states of the groups it changes.
    """
    columns, schema = answers.columns, _answers_schema(answers)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in answers.schema.fields)
    time = forget[0] if forget else None

    def changes(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        warnings.simplefilter("ignore", FutureWarning)  # joined frames may have empty columns
        if state.hasTimedOut:
            state.remove()
            return
        fresh = pd.concat(list(frames), ignore_index=True)[columns]
        fresh = fresh.sort_values(version, ascending=False, kind="stable").drop_duplicates(key)
        known = _unpacked(state.get[0]) if state.exists else fresh.iloc[:0]
        ended = 0
        if time is not None:
            passed = known[time] < pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
            known, ended = known[~passed], passed.sum()
        before = fresh[key].map(known.set_index(key)[version])
        fresh = fresh[(before.isna() | (fresh[version] > before)).to_numpy()]
        again = known[key].isin(fresh[key])
        if len(fresh) or ended:
            last = pd.concat([known[~again], fresh], ignore_index=True) if len(known) else fresh
            state.update((_packed(last, schema),))
            yield pd.concat([fresh.assign(sign=1), known[again].assign(sign=-1)], ignore_index=True)
        else:
            last = known
        if time is not None:
            latest = last[time].max()
            state.setTimeoutTimestamp(max(int(latest.timestamp() * 1000) if pd.notna(latest) else 0, state.getCurrentWatermarkMs()) + 1)

    known = answers.filter(F.col(key).isNotNull() & F.col(version).isNotNull())
    known = known.withWatermark(*forget) if forget else known
    timeout = GroupStateTimeout.EventTimeTimeout if forget else GroupStateTimeout.NoTimeout
    grouped = known.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")).groupBy("_group")
    return grouped.applyInPandasWithState(changes, f"{fields}, sign int", "answers binary", "append", timeout)


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int")


def run_corrected_stream(
    answers: DataFrame, target: str, *, origin: str, products: DataFrame, rules: DataFrame | None = None, exclude: DataFrame | None = None, forget: tuple[str, str] | None = None
) -> None:
    """Process all data that is available, then stop; call again for what arrives later.

    A batch overwrites its own folders only, so a batch repeated after a failure leaves the same result. Rules and
    products must stay the same for the life of ``target``, since an answer is taken back from the page they give it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch, "signed-answers")  # cleaning reads it more than once; the states are visited once
        cleaned = clean_survey(batch, origin=origin, rules=rules, exclude=exclude)
        mapped = map_product(cleaned, "canonical_url", products)
        order = ["row_id", "response_id", "sign"]
        rated = rated_pages(mapped, url="canonical_url", rating="q1", comment="q2", date="start_date", order=order, product=F.col("product"))
        rows = f"{target}/rows/batch={batch_id}"
        rated.withColumn("bucket", _bucket()).write.mode("overwrite").partitionBy("bucket").parquet(rows)
        written = batch.sparkSession.read.schema(rated.schema).parquet(rows)
        sums = [F.sum(F.col("q1") * F.col("sign")).alias("sum_q1"), F.sum("sign").alias("n"), F.sum(F.when(F.col("q2").isNotNull(), F.col("sign")).otherwise(0)).alias("n_comments")]
        written.groupBy(*KEYS).agg(*sums).write.mode("overwrite").parquet(f"{target}/statistics/batch={batch_id}")

    started = signed_answers(answers, forget=forget).writeStream.foreachBatch(store).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
    started.awaitTermination()


def read_corrected(spark: SparkSession, target: str, max_comments: int = MAX_COMMENTS, since: int | None = None) -> DataFrame:
    """Feedback per page over all batches so far; with ``since`` only of pages that later batches touched.

    Only the folders of rows that hold such pages are read. Pages that have lost all their answers are left out.
    """
    statistics = spark.read.parquet(f"{target}/statistics")
    rows = spark.read.parquet(f"{target}/rows")
    if since is not None:
        touched = stored(statistics.filter(F.col("batch") > since).select(*KEYS).distinct(), "touched-pages")
        folders = [r["bucket"] for r in touched.select(_bucket().alias("bucket")).distinct().collect()]  # at most BUCKETS numbers
        named = touched.select(*[F.coalesce(k, F.lit("")).alias(f"_{k}") for k in KEYS])
        near = lambda df: lookup_join(df.select("*", *[F.coalesce(k, F.lit("")).alias(f"_{k}") for k in KEYS]), named, [f"_{k}" for k in KEYS], "left_semi").drop(*[f"_{k}" for k in KEYS])
        statistics, rows = near(statistics), near(rows.filter(F.col("bucket").isin(folders)))
    totals = statistics.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("sum_q1", "n", "n_comments")]).filter("n > 0")
    gone = rows.filter("sign < 0").select("response_id", "row_id")
    kept = lookup_join(rows.filter("sign > 0").select(*KEYS, "row_id", "response_id", "q2"), gone, ["response_id", "row_id"], "left_anti")
    return finish_feedback(totals, join_comments(stored(kept.drop("response_id"), "kept-answers"), KEYS, "q2", ["row_id"], max_comments), KEYS)
