"""Lookup, survey and configuration files, and report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.common import strip_ws
from ..operators.aggregates import first_rows_dropped, metadata_row_dropped
from ..operators.filters import clean_ids
from ..operators.skew import lookup_join
from .csv_split import read_split_csv

# Label of the comment column and the marker of the metadata row in exports.
COMMENT_LABEL = "Any suggestions for improvement?"
METADATA_MARKER = "ImportId"

ROW_ORDER = ("file", "split_start", "row_order", "ordinal")


def with_row_order(df: DataFrame) -> DataFrame:
    """Adds (file, row_order): a number that grows along each file, without a shuffle.

    A task reads whole splits one after another, so the low bits of the row id count rows within
    a task. A task never reads more bytes, hence rows, than a split is long; doubling the byte
    offset of the split therefore keeps the ranges of consecutive splits apart.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.col("_metadata.file_block_start")
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        start.alias("split_start"),
        (start * 2 + in_task).alias("row_order"),
    )


def _leading_ordinal(df: DataFrame) -> DataFrame:
    """Replaces row_order by the ordinal in the file for its first two rows, NULL for all others."""
    first = df.filter(F.col("split_start") == 0).groupBy("file").agg(F.min("row_order").alias("_first"))
    ordinal = F.col("row_order") - F.col("_first")
    return (
        lookup_join(df, first, "file")  # one row per file; a lookup too large to broadcast meets slices of large files
        .withColumn("ordinal", F.when((F.col("split_start") == 0) & (ordinal < 2), ordinal))
        .drop("_first")
    )


def _read_exported(spark: SparkSession, path: str, line_breaks: bool) -> DataFrame:
    """CSV with (file, split_start, row_order) and the ordinal of the first two rows of a file, -1 for others."""
    if line_breaks:
        return read_split_csv(spark, path).withColumn("ordinal", F.coalesce("ordinal", F.lit(-1)))
    raw = with_row_order(spark.read.csv(path, header=True, escape='"'))
    return _leading_ordinal(raw).withColumn("ordinal", F.coalesce("ordinal", F.lit(-1)))


def read_survey(spark: SparkSession, path: str, label: str = COMMENT_LABEL, line_breaks: bool = True) -> DataFrame:
    """Survey CSV, all text, without a repeated header or label row; keeps row order columns.

    A large file is read in splits, also with line breaks inside cells (:mod:`.csv_split`); ``line_breaks=False`` promises that no
    cell holds one and saves the pass that looks for them.
    """
    marked = _read_exported(spark, path, line_breaks)
    names = [c for c in marked.columns if c not in ROW_ORDER]
    return first_rows_dropped(marked, "ordinal", names, label).drop("ordinal")


def read_survey_export(spark: SparkSession, path: str, marker: str = METADATA_MARKER, line_breaks: bool = True) -> DataFrame:
    """Raw export CSV without its metadata row (the second data row); ``line_breaks`` as in :func:`read_survey`."""
    marked = _read_exported(spark, path, line_breaks)
    names = [c for c in marked.columns if c not in ROW_ORDER]
    return metadata_row_dropped(marked, "ordinal", names, marker).drop("ordinal")


def read_lookup_csv(spark: SparkSession, path: str, key: str = "filepath", value: str = "url") -> DataFrame:
    """(ord, prefix, target) from a header CSV with loose spacing around names and values.

    Rows without key or value are dropped and trailing slashes leave the value. A repeated key
    keeps its first position and takes the last value.
    """
    raw = with_row_order(spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True))
    named = {c.strip(): c for c in raw.columns}
    order = F.struct("file", "row_order")
    rows = raw.select(
        order.alias("ord"),
        strip_ws(F.col(f"`{named[key]}`")).alias("prefix"),
        F.regexp_replace(strip_ws(F.col(f"`{named[value]}`")), r"/+\z", "").alias("target"),
    ).filter((F.length("prefix") > 0) & F.col("target").isNotNull())
    return rows.groupBy("prefix").agg(F.min("ord").alias("ord"), F.max_by("target", "ord").alias("target")).select(
        "ord", "prefix", "target"
    )


def read_bases(spark: SparkSession, path: str, doc_set: str = "Title", base: str = "URL") -> DataFrame:
    """(doc_set, base) from a header CSV with loose spacing; bases stay as written, rows without either are dropped."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    named = {c.strip(): c for c in raw.columns}
    both = [strip_ws(F.col(f"`{named[n]}`")).alias(out) for n, out in ((doc_set, "doc_set"), (base, "base"))]
    return raw.select(*both).filter((F.length("doc_set") > 0) & (F.length("base") > 0))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line: trimmed, blank lines dropped, distinct."""
    return clean_ids(spark.read.text(path).withColumnRenamed("value", "id"))


def read_config_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_id, line_no, line) of configuration files; nothing for a path that does not exist.

    Line numbers grow along a file but need not be consecutive. Large files are read in splits.
    """
    from pyspark.errors import AnalysisException

    try:
        lines = with_row_order(spark.read.text(path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file_id string, line_no bigint, line string")
    return lines.select(F.col("file").alias("file_id"), F.col("row_order").alias("line_no"), F.col("value").alias("line"))


def write_report(df: DataFrame, path: str, columns: list[str], order: list[str], fmt: str = "csv") -> None:
    """A report with a fixed column order, sorted by range partitioning over many files."""
    report = df.select(*[F.col(f"`{c}`") for c in columns]).orderBy(*order)
    writer = report.write.mode("errorifexists")
    if fmt == "csv":
        # NULL and '' stay apart; quotes are doubled, so any text survives
        writer.option("header", True).option("nullValue", "\\N").option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_report_header(spark: SparkSession, path: str, about: str) -> None:
    """The lines above a report, what it is about and its date, as a small text table of their own."""
    lines = spark.createDataFrame([(0, f"Repo path: {about}")], "no int, value string").unionByName(
        spark.range(1).select(F.lit(1).alias("no"), F.concat(F.lit("Date: "), F.date_format(F.current_date(), "yyyy-MM-dd")).alias("value"))
    )
    lines.coalesce(1).sortWithinPartitions("no").select("value").write.mode("errorifexists").text(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(
        path, header=True, nullValue="\\N", escape='"', multiLine=True
    )


def section_label(name: Column) -> Column:
    """Sheet-style label: the first 31 characters."""
    return F.substring(name, 1, 31)


def write_partitioned(df: DataFrame, path: str, by: str, max_rows_per_file: int = 5_000_000) -> None:
    """One folder per section; a large section is written by many tasks into many files."""
    df.write.option("maxRecordsPerFile", max_rows_per_file).partitionBy(by).mode("errorifexists").parquet(path)

