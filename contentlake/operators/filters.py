"""Row filters of the survey and document pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import col, computed, strip_ws
from ..functions.text import coerce_date
from .skew import lookup_join

# Names a response id column may have (any case).
RESPONSE_ID_NAMES = ["responseid", "response_id", "response id"]


def drop_missing(df: DataFrame, name: str) -> DataFrame:
    """Drop NULLs only; empty text stays. A missing column changes nothing."""
    return df.filter(F.col(name).isNotNull()) if name in df.columns else df


def mentions(text: Column | str, word: str) -> Column:
    """Case-insensitive substring test that is false, not NULL, for NULL."""
    return F.coalesce(F.lower(col(text)).contains(word.lower()), F.lit(False))


def drop_keyword(df: DataFrame, name: str, word: str) -> DataFrame:
    return df.filter(~mentions(name, word)) if name in df.columns else df


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail while planning when columns are missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing required column(s): {missing}")
    return df


def keep_rated(df: DataFrame, date: str, rating: str) -> DataFrame:
    """Rows with a date and a rating; the date is parsed once, where the row is, and not pushed below an exchange into fewer tasks."""
    dated = df.withColumn("_dated", computed(coerce_date(date).isNotNull()))
    return dated.filter(F.col("_dated") & F.col(rating).isNotNull()).drop("_dated")


def not_index(path: Column | str) -> Column:
    """False for ``index.md`` in any case; ``_index.md`` passes."""
    return ~col(path).rlike(r"(?i)(?:\A|/)index\.md\z")


def changed(before: Column | str, after: Column | str) -> Column:
    before, after = col(before), col(after)
    return before.isNotNull() & after.isNotNull() & (before != after)


def alias_column(df: DataFrame, aliases: list[str], name: str) -> DataFrame:
    """Rename the first column whose name matches an alias in any case."""
    for candidate in df.columns:
        if candidate.lower() in aliases:
            return df.withColumnRenamed(candidate, name)
    return df


def clean_ids(ids: DataFrame, name: str = "id") -> DataFrame:
    """Trimmed, non-blank, distinct ids."""
    trimmed = strip_ws(name)
    return ids.select(trimmed.alias(name)).filter(F.col(name) != "").distinct()


def exclude_ids(df: DataFrame, ids: DataFrame, name: str, id_name: str = "id") -> DataFrame:
    """Rows whose trimmed id is not listed; a NULL id never matches."""
    if name not in df.columns:
        return df
    listed = clean_ids(ids, id_name).withColumnRenamed(id_name, name)
    return lookup_join(df.withColumn(name, strip_ws(name)), listed, name, "left_anti")


def excluded_report(df: DataFrame, ids: DataFrame, name: str, id_name: str = "id") -> DataFrame:
    """Distinct listed ids that occur, sorted, with the rows each removes."""
    found = df.groupBy(strip_ws(name).alias(name)).agg(F.count("*").alias("n_rows"))
    listed = clean_ids(ids, id_name).withColumnRenamed(id_name, name)
    return found.join(listed, name, "left_semi").orderBy(name)
