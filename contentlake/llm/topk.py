"""Exact top-k inner products by distributed histogram selection.

Queries meet all candidates in blocks of ``QUERY_BLOCK`` queries, each broadcast (a size fixed by
block and dimension). For a block every candidate is scored by matrix products; tasks return counts
of scores per (query, bin), which are summed. The bin with a query's k-th best score becomes the
range of the next, finer histogram until the k-th score is known as an integer. A last pass keeps
the scores at or above it, ties by smaller id; no task keeps more than k rows of a query.

Cases: a null vector or one with a null or non-finite component takes no part, neither does a row
without id; an empty vector and vectors of different length never meet; rows of a repeated id are
separate candidates, but a query never meets rows of its own id, and a repeated query id is one
query (its smallest vector); fewer than k candidates give fewer rows; an empty table gives none.
Components are scaled to integers, ``floor(scale * x)``, at most 2**53 in size; products are exact
in 64 bits and stop at the ends of that range beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

QUERY_BLOCK = 4096
ROWS = 1024
BINS = 512
LIMIT = 2**53


def usable(df: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, v array<bigint>): the rows that take part, scaled."""
    raw = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("raw"))
    fine = raw.filter(F.col("id").isNotNull() & F.col("raw").isNotNull()).filter(
        F.forall("raw", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    )
    bound = lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x))
    return fine.select("id", F.transform("raw", lambda x: F.floor(bound(x * float(scale)))).alias("v"))


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products, rows by queries; saturated at 64 bits."""
    if not rows.size or not queries.size:
        return np.zeros((len(rows), len(queries)), np.int64)
    bound = int(np.abs(rows).max()) * int(np.abs(queries).max()) * rows.shape[1]
    if bound < LIMIT:  # every partial sum is an exact double
        return (rows.astype(np.float64) @ queries.T.astype(np.float64)).astype(np.int64)
    if bound < 2**63:
        return rows @ queries.T
    exact = rows.astype(object) @ queries.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, vectors: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(candidate ids, query numbers, scores, meets) of each run of candidates of one length."""
    for batch in batches:
        lists = batch.column("v")
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(lengths)])
        flat, own = lists.flatten().to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
        for dim in np.unique(lengths):
            if int(dim) not in vectors:
                continue
            numbers, queries = vectors[int(dim)]
            hit = np.flatnonzero(lengths == dim)
            step = max(1, min(ROWS, (1 << 22) // max(1, len(numbers))))
            for a in range(0, len(hit), step):
                some = hit[a : a + step]
                rows = flat[first[some][:, None] + np.arange(dim)[None, :]]
                yield own[some], numbers, products(rows, queries), own[some][:, None] != ids[numbers][None, :]


def top_k(df: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank from 1, id, score) of the k best rows of ``df`` for every row of ``queries``."""
    spark = df.sparkSession
    rows = usable(df, id_column, vector_column, scale)
    asked = usable(queries, id_column, vector_column, scale).groupBy("id").agg(F.min("v").alias("v")).filter(F.size("v") > 0)
    numbered = materialize(asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 20))), "topk-queries")
    n = numbered.observed["rows"]
    blocks = -(-n // QUERY_BLOCK)
    out = None
    for b in range(blocks):
        # a bounded share of the queries by a hash of the id, in parts of about QUERY_BLOCK
        share = numbered.filter(F.expr(f"part * {blocks} div {1 << 20} = {b}")).select("id", "v").orderBy("id").toPandas()
        for a in range(0, len(share), QUERY_BLOCK):
            found = materialize(_block(spark, rows, share.iloc[a : a + QUERY_BLOCK], k), "topk")
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    return out


def _block(spark, rows: DataFrame, share, k: int) -> DataFrame:
    ids = share["id"].to_numpy(np.int64)
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    lengths = np.array([len(v) for v in share["v"]])
    for dim in np.unique(lengths):
        hit = np.flatnonzero(lengths == dim)
        by_length[int(dim)] = (hit, np.stack([np.asarray(share["v"].iloc[i], np.int64) for i in hit]))
    sent = spark.sparkContext.broadcast((ids, by_length))

    def extremes(batches):
        known, vectors = sent.value
        low, high, n = np.full(len(known), 2**63 - 1), np.full(len(known), -(2**63)), np.zeros(len(known), np.int64)
        for _, numbers, scores, meets in _scored(batches, known, vectors):
            n[numbers] += meets.sum(0)
            low[numbers] = np.minimum(low[numbers], np.where(meets, scores, 2**63 - 1).min(0))
            high[numbers] = np.maximum(high[numbers], np.where(meets, scores, -(2**63)).max(0))
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(low[hit]), pa.array(high[hit]), pa.array(n[hit])], ["q", "low", "high", "n"])

    met = rows.mapInArrow(extremes, "q int, low long, high long, n long").groupBy("q").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).toPandas()
    # per query: the range [low, high] that holds the k-th best score, and how many scores lie above it
    low, high, above = np.full(len(ids), 1, object), np.full(len(ids), 0, object), np.zeros(len(ids), np.int64)
    for r in met.itertuples():
        low[r.q], high[r.q] = int(r.low), int(r.low) if r.n <= k else int(r.high)
    while any(h > lo for lo, h in zip(low, high, strict=True)):
        widths = np.array([max(1, -(-(int(h) - int(lo) + 1) // BINS)) for lo, h in zip(low, high, strict=True)], np.uint64)
        state = spark.sparkContext.broadcast((low.astype(np.int64), high.astype(np.int64), widths))

        def histogram(batches, state=state):
            known, vectors = sent.value
            lows, highs, width = state.value
            counts = np.zeros((len(known), BINS), np.int64)
            for _, numbers, scores, meets in _scored(batches, known, vectors):
                inside = meets & (scores >= lows[numbers]) & (scores <= highs[numbers]) & (lows < highs)[numbers]
                r, c = np.nonzero(inside)
                bins = ((scores[r, c].astype(np.uint64) - lows[numbers[c]].astype(np.uint64)) // width[numbers[c]]).astype(np.int64)
                np.add.at(counts, (numbers[c], bins), 1)
            x, y = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(counts[x, y])], ["q", "bin", "n"])

        summed = rows.mapInArrow(histogram, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        higher = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1))
        spots = summed.withColumn("higher", F.coalesce(higher, F.lit(0)))
        need = spark.createDataFrame([(int(i), k - int(above[i])) for i in range(len(ids))], "q int, need long")
        found = spots.join(F.broadcast(need), "q").filter("higher < need and higher + n >= need").select("q", "bin", "higher").collect()  # a row per query
        done = set()
        for r in found:
            lo, w = int(low[r["q"]]), int(widths[r["q"]])
            high[r["q"]] = min(int(high[r["q"]]), lo + (r["bin"] + 1) * w - 1)
            low[r["q"]] = lo + r["bin"] * w
            above[r["q"]] += r["higher"]
            done.add(r["q"])
        for i in range(len(ids)):  # defensive: a range without its k-th score can't occur
            if high[i] > low[i] and i not in done:
                raise RuntimeError("the scores changed between two passes")
        state.unpersist()
    least = spark.sparkContext.broadcast((low.astype(np.int64), np.array([h >= lo for lo, h in zip(low, high, strict=True)])))

    def best(batches):
        known, vectors = sent.value
        bound, any_ = least.value
        kept = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        waiting = [kept]
        size = 0
        for cand, numbers, scores, meets in _scored(batches, known, vectors):
            r, c = np.nonzero(meets & any_[numbers] & (scores >= bound[numbers]))
            waiting.append((numbers[c].astype(np.int32), cand[r], scores[r, c]))
            size += len(r)
            if size > 200_000:
                waiting = [_first_k(waiting, k)]
                size = 0
        kept = _first_k(waiting, k)
        yield pa.RecordBatch.from_arrays([pa.array(known[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], ["query_id", "id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    top = rows.mapInArrow(best, "query_id long, id long, score long").withColumn("rank", F.row_number().over(order).cast("int"))
    return top.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _first_k(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q, i, s = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((i, ~s, q))  # ~s falls as s rises, without overflow
    q, i, s = q[order], i[order], s[order]
    start = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - start < k
    return q[keep], i[keep], s[keep]
