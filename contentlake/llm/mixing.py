"""Mix sources to target weights by drawing fixed-length word blocks.

The words of a source, document after document, are packed into blocks of ``block_words`` words.
A source's target is met by slots: slot j of pass e stands for block perm(source, e)(j), where perm
is a keyed permutation of the block numbers (a Feistel network with cycle walking). Complete passes
use every block once; the last pass is cut when the target is reached, inside a block if need be.
So a source's words meet its target to the word, and with targets of at most ``max_passes`` times a
source no block, hence no document, is used more often than that. Per output shard the source
counts are a multinomial draw given the totals (the sampling without replacement of
:func:`sharding.communication_matrix`). Slots and document pieces are joined on (source, block).

Positions come from a running sum over buckets of a source, so a source with a third of all rows is
spread over many tasks. The driver holds one number per source and shard, and one per bucket.

Cases: a null text has no words; a null source is a source of its own, after all others; documents
without words are taken 0 times; equal rows are separate documents; an empty table or one without any words gives an
empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .sharding import communication_matrix
from .tables import n_words, q
from .textarrays import U64, mix

BLOCK_WORDS = 256
WEIGHTS = (5, 2, 1)
ROWS_PER_BUCKET = 200_000
MIN_BUCKETS = 32
CHUNK = 1 << 16


def targets(sizes: list[int], weights: list[float], share: float, max_passes: float) -> list[float]:
    """Split ``share`` * sum of sizes by weight; nobody gets more than ``max_passes`` times its size."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while open_:
        per = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if per * weights[s] > max_passes * sizes[s]]
        for s in full or open_:
            out[s] = float(max_passes * sizes[s]) if full else per * weights[s]
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in set(full)] if full else []
    return out


def _half_bits(n: int) -> int:
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def permute(index: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. n-1 applied to ``index`` (four Feistel rounds, cycle walking)."""
    if n <= 1:
        return np.zeros_like(index)
    half = _half_bits(n)
    mask, out = U64((1 << half) - 1), index.astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> U64(half), out[todo] & mask
        for r in reversed(range(4)) if inverse else range(4):
            salt = U64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
            if inverse:
                left, right = right ^ (mix(left ^ salt) & mask), left
            else:
                left, right = right, left ^ (mix(right ^ salt) & mask)
        out[todo] = (left << U64(half)) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def plan_slots(words: int, target: float, block_words: int, key: int) -> tuple[int, int, int]:
    """(blocks, slots, words of the last slot) of a source."""
    blocks = -(-words // block_words)
    want = int(round(target))
    if not words or not want:
        return blocks, 0, 0
    passes, rest = divmod(want, words)
    short = words - (blocks - 1) * block_words
    if not rest:
        last = int(permute(np.array([blocks - 1]), blocks, key + passes - 1)[0])
        return blocks, passes * blocks, short if last == blocks - 1 else block_words
    at_short = int(permute(np.array([blocks - 1]), blocks, key + passes, inverse=True)[0])
    m = -(-rest // block_words)
    while True:
        before = (m - 1) * block_words - (block_words - short if at_short < m - 1 else 0)
        room = short if at_short == m - 1 else block_words
        if rest - before <= room:
            return blocks, passes * blocks + m, rest - before
        m += 1


def _permuted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {n: batch.column(n).to_numpy() for n in ("source_no", "slot", "blocks", "key")}
        block = np.zeros(batch.num_rows, np.int64)
        passes = col["slot"] // np.maximum(col["blocks"], 1)
        for s, e in set(zip(col["source_no"].tolist(), passes.tolist(), strict=True)):
            hit = np.flatnonzero((col["source_no"] == s) & (passes == e))
            n = int(col["blocks"][hit[0]])
            block[hit] = permute(col["slot"][hit] % n, n, int(col["key"][hit[0]]) + e)
        yield pa.RecordBatch.from_arrays([batch.column("source_no"), batch.column("slot"), pa.array(block)], ["source_no", "slot", "block"])


def positioned(df: DataFrame, size: Column, source: Column, seed: int = 7) -> tuple[DataFrame, list[tuple]]:
    """``df`` as struct ``doc`` with size, source_no and first word position; and (source, words) in order."""
    doc = F.struct(*[q(c) for c in df.columns])
    rows = df.select(doc.alias("doc"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), source.cast("string").alias("source"))
    rows = rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc"))
    n = df.count()
    buckets = max(MIN_BUCKETS, -(-n // ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("int"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")).collect()
    names = sorted({r["source"] for r in sums}, key=lambda s: (s is None, s or ""))
    number = {s: k for k, s in enumerate(names)}
    at: dict[str | None, int] = dict.fromkeys(names, 0)
    first = []
    for r in sorted(sums, key=lambda r: (number[r["source"]], r["bucket"])):
        first.append((r["source"], number[r["source"]], r["bucket"], at[r["source"]]))
        at[r["source"]] += r["words"]
    spark = df.sparkSession
    starts = spark.createDataFrame(first, "source string, source_no int, bucket int, first long").withColumnsRenamed({"source": "source_", "bucket": "bucket_"})
    rows = rows.join(F.broadcast(starts), F.col("source").eqNullSafe(F.col("source_")) & (F.col("bucket") == F.col("bucket_")))
    run = Window.partitionBy("source_no", "bucket").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("offset", F.col("first") + F.sum("size").over(run) - F.col("size"))
    return rows.select("doc", "size", "source_no", "offset"), [(s, at[s]) for s in names]


def mix_sources(df: DataFrame, size: Column, source: Column, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, max_passes: int = 2, block_words: int = BLOCK_WORDS, shards: int = 24, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(mix, sources). ``df`` should be thin: its rows travel with the joins.

    mix: every piece of a document in every slot it takes part in: doc (struct of the input row),
    size, source_no, offset (its place in the source), block, and shard, slot, pass, start_word, n_words; a
    document in no slot has one row with null shard and n_words 0. sources: source_no, source,
    source_size, target, slots. Weights repeat over the sources in code point order, null last.
    """
    spark = df.sparkSession
    rows, sources = positioned(df, size, source, seed)
    sizes = [w for _, w in sources]
    per_source = targets(sizes, [weights[k % len(weights)] for k in range(len(sizes))], share, max_passes)
    keys = [seed * 1_000_003 + 1009 * k for k in range(len(sizes))]
    plans = [plan_slots(w, t, block_words, key) for w, t, key in zip(sizes, per_source, keys, strict=True)]
    matrix = np.cumsum(communication_matrix([p[1] for p in plans], shards, seed), axis=1) if plans else []
    made = spark.createDataFrame(
        [(k, s, w, t, p[0], p[1], p[2], key, [int(x) for x in matrix[k]]) for k, ((s, w), t, p, key) in enumerate(zip(sources, per_source, plans, keys, strict=True))],
        "source_no int, source string, source_size long, target double, blocks long, slots long, last_words long, key long, shard_ends array<long>",
    )
    wide = made.filter("slots > 0").select("source_no", "blocks", "slots", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {CHUNK}"))).alias("chunk"))
    wide = wide.repartition("source_no", "chunk").select("source_no", "blocks", "key", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK) - 1)).alias("slot"))
    slots = wide.mapInArrow(_permuted, "source_no int, slot long, block long")
    known = made.select("source_no", "blocks", "slots", "last_words", "shard_ends").withColumnRenamed("source_no", "no")
    slots = slots.join(F.broadcast(known), F.col("source_no") == F.col("no")).select(
        "source_no", "block", "slot", F.expr("slot div blocks").alias("pass"), F.size(F.filter("shard_ends", lambda e: e <= F.col("slot"))).alias("shard"),
        F.when(F.col("slot") == F.col("slots") - 1, F.col("last_words")).otherwise(F.lit(block_words)).alias("take"),
    )
    b = F.lit(block_words)
    pieces = rows.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(F.expr(f"offset div {block_words}"), F.expr(f"(offset + size - 1) div {block_words}"))).otherwise(F.array(F.lit(-1).cast("long")))))
    joined = pieces.join(slots, ["source_no", "block"], "left")
    start = F.greatest(F.col("offset"), F.col("block") * b)
    end = F.least(F.col("offset") + F.col("size"), F.col("block") * b + F.coalesce("take", F.lit(0)))
    mix_rows = joined.select(
        "doc", "size", "source_no", "offset", "block", "shard", "slot", "pass",
        (start - F.col("offset")).alias("start_word"), F.greatest(F.lit(0).cast("long"), end - start).alias("n_words"),
    )
    return mix_rows, made.select("source_no", "source", "source_size", "target", "slots")


def words_taken(mixed: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per document: doc, size, source_no, offset, source, source_size, target, taken, in_shards."""
    shard = F.when(F.col("n_words") > 0, F.col("shard"))
    per = mixed.groupBy("source_no", "offset", "size", "doc").agg(
        F.sum("n_words").alias("taken"), F.countDistinct(shard).cast("int").alias("in_shards"), F.sum(F.when(F.col("size") == 0, 1)).alias("copies")
    )
    # (source, offset) names a document with words; equal rows without words share a place, and are counted
    per = per.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
    return per.join(F.broadcast(sources), "source_no").drop("copies", "copy", "slots")


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    Each pass in which a document takes part gives a row: the whole text if all its words were
    taken, else the taken runs of words, joined by blanks. Texts are shuffled once, for the join.
    """
    key = F.struct(F.xxhash64(*[q(c) for c in docs.columns]), F.crc32(F.coalesce(q(text), F.lit(""))), F.length(q(text)))
    thin = docs.select(key.alias("key"), q(source).alias("source"), n_words(q(text)).alias("size"))
    mixed, _ = mix_sources(thin, F.col("size"), F.col("source"), **how)
    # slots of one pass come in one run of slot numbers, so the blocks of a document in a pass are told apart by it
    taken = mixed.filter("n_words > 0").select("doc.key", "size", "source_no", "offset", "pass", "start_word", "n_words")
    taken = taken.groupBy("key", "source_no", "offset", "pass").agg(F.max("size").alias("size"), F.sum("n_words").alias("n"), F.array_sort(F.collect_list(F.struct("start_word", "n_words"))).alias("runs"))
    whole = docs.select(key.alias("key"), F.struct(*[q(c) for c in docs.columns]).alias("row")).groupBy("key").agg(F.first("row").alias("row"))
    both = taken.join(whole, "key")
    words = F.split(F.regexp_replace(F.translate(F.col("row").getField(text), "\t\n\x0b\x0c\r", "     "), "^ +", ""), " +")
    parts = F.transform("runs", lambda r: F.array_join(F.slice(words, (r["start_word"] + 1).cast("int"), r["n_words"].cast("int")), " "))
    cut = F.when(F.col("n") == F.col("size"), F.col("row").getField(text)).otherwise(F.array_join(parts, " "))
    return both.withColumn("cut", cut).select(*[F.col("cut").alias(c) if c == text else F.length("cut").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row").getField(c).alias(c) for c in docs.columns])
