"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A store is a folder of tables. A batch of inserts, deletes and revised counts becomes signed entries:
minus what the store holds for a key, plus what the batch says. Entries and their sums per group are
written to new folders; the batch counts from the moment its commit row is written, last. So a batch
that fails leaves nothing visible, and one that is applied again changes nothing. Totals are the sums of the committed
deltas, one small row per batch and group; documents are never recounted.

Only entries of the keys in a batch are looked up. Sums are partial before each shuffle, so a
source with a third of all rows does no harm.

Cases: an insert of a known key revises it and a revision of an unknown one inserts it; deleting an unknown key changes
nothing; of several changes of a key in a batch the last by ``at`` counts, then the largest by
values; null keys, sources and languages are values of their own; a null count is 0; an unknown change is an
error; an empty batch is committed and changes nothing; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import q

GROUP = ["source", "lang", "tokenizer"]
ENTRY = "key string, source string, lang string, tokenizer string, n_tokens long, sign int"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
COMMIT = "batch string, folder string"


def create_store(spark: SparkSession, store: str) -> str:
    """An empty store in a new folder of the shared file system."""
    spark.createDataFrame([], COMMIT).write.parquet(f"{store}/commits")
    return store


def commits(spark: SparkSession, store: str) -> list[tuple[str, str]]:
    """(batch, folder) of all committed batches: one small row each."""
    return sorted({(r["batch"], r["folder"]) for r in spark.read.schema(COMMIT).parquet(f"{store}/commits").collect()})


def _all(spark: SparkSession, store: str, what: str, schema: str) -> DataFrame:
    first: dict[str, str] = {}
    for batch, folder in commits(spark, store):  # a batch counts once, whatever happened
        first.setdefault(batch, folder)
    if not first:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{store}/{folder}/{what}" for folder in first.values()])


def apply_batch(spark: SparkSession, store: str, batch: str, changes: DataFrame) -> bool:
    """Apply and commit a batch; False if it had been committed before.

    ``changes``: key, change (insert, delete or revise), source, lang, tokenizer, n_tokens, and
    optionally ``at``, the order of changes of one key.
    """
    if any(b == batch for b, _ in commits(spark, store)):
        return False
    at = q("at") if "at" in changes.columns else F.lit(0)
    known = F.when(F.col("change").isin("insert", "delete", "revise"), F.col("change"))
    checked = F.coalesce(known, F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(F.col("change"), F.lit("null")))))
    value = F.struct(at.alias("at"), checked.alias("change"), *[q(c).cast("string").alias(c) for c in GROUP], F.coalesce(q("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"))
    last = changes.select(q("key").cast("string").alias("key"), value.alias("v")).groupBy("key").agg(F.max("v").alias("v")).select("key", "v.*")
    new = last.filter("change <> 'delete'").select("key", *GROUP, "n_tokens", F.lit(1).alias("sign"))
    touched = last.select(F.col("key").alias("touched"))
    held = _all(spark, store, "entries", ENTRY).join(touched, F.col("key").eqNullSafe(F.col("touched")), "left_semi")
    held = held.groupBy("key", *GROUP, "n_tokens").agg(F.sum("sign").cast("int").alias("sign")).filter("sign <> 0")
    old = held.select("key", *GROUP, "n_tokens", (-F.col("sign")).cast("int").alias("sign"))
    folder = f"batches/{uuid.uuid4().hex}"
    new.unionByName(old).write.parquet(f"{store}/{folder}/entries")
    entries = spark.read.schema(ENTRY).parquet(f"{store}/{folder}/entries")
    sums = entries.groupBy(*GROUP).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
    sums.filter("n_docs <> 0 or n_tokens <> 0").write.parquet(f"{store}/{folder}/deltas")
    spark.createDataFrame([(batch, folder)], COMMIT).coalesce(1).write.mode("append").parquet(f"{store}/commits")
    return True


def totals(spark: SparkSession, store: str) -> DataFrame:
    """source, lang, tokenizer, n_docs, n_tokens of all groups that hold documents."""
    sums = _all(spark, store, "deltas", DELTA).groupBy(*GROUP).agg(F.sum("n_docs").cast("long").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens"))
    return sums.filter("n_docs <> 0 or n_tokens <> 0")


def recount(spark: SparkSession, store: str) -> DataFrame:
    """The same totals from the entries, to audit the deltas."""
    entries = _all(spark, store, "entries", ENTRY)
    sums = entries.groupBy(*GROUP).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
    return sums.filter("n_docs <> 0 or n_tokens <> 0")


def change_rows(docs: DataFrame, key: str, change: str, tokenizer: str, n_tokens: Column) -> DataFrame:
    """Changes that say the same of every document."""
    return docs.select(q(key).cast("string").alias("key"), F.lit(change).alias("change"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), n_tokens.cast("long").alias("n_tokens"))


#: Letters and digits in runs, other signs one by one.
PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"


def n_pieces(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PIECES)), F.lit(0)).cast("long")


def n_vocabulary_tokens(text: Column, vocabulary: str) -> Column:
    """Tokens under a tokenizer file (its path on the executors is a parameter); 0 for null."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        from tokenizers import Tokenizer

        reader = Tokenizer.from_file(vocabulary)
        reader.encode_special_tokens = True
        values, out = texts.to_pylist(), []
        for a in range(0, len(values), 256):
            out.extend(len(e.ids) for e in reader.encode_batch(values[a : a + 256], add_special_tokens=False))
        return pa.array(out, pa.int64())

    return count(F.coalesce(text, F.lit("")))


def apply_all(spark: SparkSession, store: str, batches: list[tuple[str, DataFrame]]) -> int:
    """Apply batches in order; how many were new."""
    return reduce(lambda n, b: n + apply_batch(spark, store, *b), batches, 0)
