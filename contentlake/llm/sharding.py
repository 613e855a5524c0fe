"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows fall into blocks by a hash of their values. The driver draws how many rows of each block go to
each shard: a table with the given block totals and shard totals, distributed as in a uniform
shuffle (multivariate hypergeometric). Every block is permuted by itself and cut at these counts,
the pieces are exchanged, and every shard is permuted again, in buckets so that no task holds a
whole shard. Nothing but the counts passes through the driver: blocks * shards numbers, where the
number of blocks is rows / ``ROWS_PER_BLOCK``.

Cases: null values hash like any other value; equal rows are interchangeable, so ties change
nothing; an empty table gives no rows; a column named like an output column is replaced by it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .tables import free_names, q

ROWS_PER_BLOCK = 500_000
MIN_BLOCKS = 256


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Marked items among ``draws`` drawn from ``good`` marked and ``bad`` others, for any size.

    numpy draws below 10**9; above it, ratio of uniforms around the mode (exact rejection).
    """
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low

    def log_weight(k: int) -> float:
        return -sum(math.lgamma(x + 1) for x in (k, good - k, draws - k, bad - draws + k))

    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(max(0.25, draws * good / total * (bad / total) * (total - draws) / (total - 1)))
    top, center = log_weight(mode), mode + 0.5
    reach = 1.7156 * math.sqrt(spread**2 + 0.5) + 0.8989  # half width of the hat
    while True:
        u, v = rng.random(), rng.random()
        if not u:
            continue
        k = math.floor(center + reach * (v - 0.5) * 2 / u)
        if low <= k <= high and 2 * math.log(u) <= log_weight(k) - top:
            return k


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each block sends to each shard; shard totals differ by one at most.

    Shards are split in halves again and again: a half's share of a block is one hypergeometric
    draw, so blocks * shards draws suffice.
    """
    rng = np.random.default_rng(seed)
    n = sum(block_rows)
    totals = [n // shards + (s < n % shards) for s in range(shards)]
    out = np.zeros((len(block_rows), shards), np.int64)

    def halve(counts: list[int], a: int, b: int) -> None:
        if b - a == 1:
            out[:, a] = counts
            return
        mid = (a + b) // 2
        rest, left = sum(counts), sum(totals[a:mid])
        half = []
        for c in counts:
            # left of the remaining items are marked "first half"; this block draws c of them
            k = hypergeometric(rng, left, rest - left, c)
            half.append(k)
            rest, left = rest - c, left - k
        halve(half, a, mid)
        halve([c - k for c, k in zip(counts, half, strict=True)], mid, b)

    if block_rows:
        halve(list(block_rows), 0, shards)
    return out


def shard_rows(df: DataFrame, shards: int, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless position in the shard).

    ``key`` names the columns whose values place a row (all columns when unset); rows with equal
    keys may swap places between runs, other rows never do.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot")])
    keys = [k for k in key or df.columns if k in df.columns]
    block, draw, draw2, rank, bucket, before = free_names(df, "block", "draw", "draw2", "rank", "bucket", "before")
    spark = df.sparkSession
    rows = df.withColumn(draw, F.xxhash64(F.lit(seed), *[F.to_json(F.struct(q(k))) if "map" in dict(df.dtypes)[k] else q(k) for k in keys]))
    rows = rows.withColumn(draw2, F.xxhash64(F.lit(seed + 1), q(draw)))
    n = rows.count()
    blocks = max(MIN_BLOCKS, -(-n // ROWS_PER_BLOCK))
    rows = rows.withColumn(block, F.pmod(F.xxhash64(F.lit(seed + 2), q(draw)), F.lit(blocks)).cast("int"))
    counts = [0] * blocks
    for r in rows.groupBy(q(block).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():  # one number per block
        counts[r["b"]] = r["n"]
    ends = np.cumsum(communication_matrix(counts, shards, seed), axis=1)
    matrix = spark.createDataFrame([(b, [int(x) for x in ends[b]]) for b in range(blocks)], f"{block} int, ends array<long>")

    # the first permutation: rank inside the block; the matrix row says where the block is cut
    inside = Window.partitionBy(q(block)).orderBy(q(draw), q(draw2), *[q(k) for k in keys if dict(df.dtypes)[k] in ORDERABLE])
    ranked = rows.withColumn(rank, F.row_number().over(inside))
    cut = ranked.join(F.broadcast(matrix.withColumnRenamed("ends", before)), block)
    cut = cut.withColumn("shard", F.size(F.filter(q(before), lambda e: e < q(rank))).cast("int")).drop(before, rank, block)

    # the exchange and the second permutation, in buckets of a shard by ranges of the second draw
    parts = max(8, -(-n // (shards * ROWS_PER_BLOCK)))
    cut = cut.withColumn(bucket, F.pmod(F.shiftright(q(draw2), 16), F.lit(parts)).cast("int"))
    sizes = cut.groupBy("shard", bucket).agg(F.count(F.lit(1)).alias("rows"))
    offset = F.sum("rows").over(Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    offsets = [(r["shard"], r[bucket], r["first"]) for r in sizes.withColumn("first", F.coalesce(offset, F.lit(0))).collect()]
    first = spark.createDataFrame(offsets, f"shard int, {bucket} int, {before} long")  # shards * parts rows
    order = Window.partitionBy("shard", bucket).orderBy(q(draw2), q(draw), *[q(k) for k in keys if dict(df.dtypes)[k] in ORDERABLE])
    placed = cut.withColumn("slot", F.row_number().over(order).cast("long")).join(F.broadcast(first), ["shard", bucket])
    placed = placed.withColumn("slot", q("slot") - 1 + q(before))
    return placed.select(*[q(c) for c in df.columns], "shard", "slot")


def shard_wide_rows(df: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """As :func:`shard_rows`, for rows with texts: only 128-bit hashes of the rows are permuted, texts move once.

    Equal rows share a hash and are told apart by their places alone.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot")])
    kinds = dict(df.dtypes)
    plain = [F.to_json(F.struct(q(c))) if "<" in kinds[c] or kinds[c] == "variant" else q(c).cast("string") for c in df.columns]
    values = [F.coalesce(v, F.lit("\0")) for v in plain]
    keyed = df.select(F.xxhash64(*values).alias("k1"), F.xxhash64(F.lit(seed), *reversed(values)).alias("k2"), F.struct(*[q(c) for c in df.columns]).alias("row"))
    placed = shard_rows(keyed.select("k1", "k2"), shards, seed)
    return placed.join(keyed.groupBy("k1", "k2").agg(F.first("row").alias("row")), ["k1", "k2"]).select("row.*", "shard", "slot")


#: Types that break ties of the draws; others can't be compared or need no more.
ORDERABLE = {"string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "binary"}


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 42) -> None:
    """Write the shuffled rows as one folder per shard, whose files hold ascending ranges of slots, each sorted.

    A shard is written by as many tasks as its size asks for. Cases as in :func:`shard_rows`; no rows, no shard folder.
    """
    placed = shard_wide_rows(df, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
