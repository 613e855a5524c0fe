"""Reading the given tables for the queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Hash that decides held-out rows, as unsigned 32-bit number of the id's text.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    blanks = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.regexp_count(blanks, F.lit("[^ ]+")), F.lit(0)).cast("long")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with no column of ``df`` (compared without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def q(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
