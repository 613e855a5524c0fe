"""CSV whose cells hold line breaks, read by many tasks per file.

Whether a line starts inside a quoted cell depends on everything before it. A block of lines (one split of a file) is
therefore a function of one bit: for both possible states at its start, each line learns whether it starts and ends
inside a cell, and where its record began. Of such functions there are four (keep, flip, always in, always out), so the
state at the start of every block is a running combination over the few blocks of a file, and no task has to read what lies before its split.
Lines that are records by themselves stay where they are; only the lines of longer records meet by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.skew import lookup_join, stored
from ..session import materialize

LINE_STATES = "value string, file string, split_start long, row_order long, in0 boolean, in1 boolean, out0 boolean, out1 boolean, head0 long, head1 long"


def ends_inside(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether a quoted cell is open after ``line``, given whether one is open before it.

    A quote opens a cell only at the cell's start; two quotes inside a quoted cell are one character.
    """
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside, at = False, line.find(separator, at + 1) + 1  # text between the closing quote and the separator is no quote
            if not at:
                return False
        elif line.startswith('"', at):
            inside, at = True, at + 1
        else:
            at = line.find(separator + '"', at) + 1
            if not at:
                return False


def _line_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line with its states for both states at the start of its block; the lines of a block arrive in order."""
    block, state, head = None, [False, True], [None, None]
    for batch in batches:
        values, files, starts, orders = (batch.column(c).to_pylist() for c in ("value", "file", "split_start", "row_order"))
        told: list[list] = [[] for _ in range(6)]
        for value, file, start, order in zip(values, files, starts, orders, strict=True):
            if block != (file, start):
                block, state, head = (file, start), [False, True], [None, None]
            before = state
            head = [h if b else order for h, b in zip(head, before, strict=True)]
            after = [ends_inside(value, before[0])]
            after.append(after[0] if before[1] == before[0] else ends_inside(value, before[1]))
            for column, item in zip(told, (*before, *after, *head), strict=True):
                column.append(item)
            state = after
        kinds = [pa.bool_()] * 4 + [pa.int64()] * 2
        names = ["value", "file", "split_start", "row_order", "in0", "in1", "out0", "out1", "head0", "head1"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:4]), *(pa.array(c, k) for c, k in zip(told, kinds, strict=True))], names)


def _block_starts(lines: DataFrame) -> DataFrame:
    """(file, split_start, state, carried): the state before each block, and where the record that is open there began."""
    last = [F.max_by(c, "row_order").alias(c) for c in ("out0", "out1", "head0", "head1")]
    blocks = stored(lines.groupBy("file", "split_start").agg(*last), "csv-blocks")
    order = Window.partitionBy("file").orderBy("split_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # a block that forgets its start fixes the state; the others keep or flip it
    flips = F.when(F.col("out0") & ~F.col("out1"), 1).otherwise(0)
    fixed = F.when(F.col("out0") == F.col("out1"), F.struct("out0", F.sum(flips).over(order).alias("flips")))
    told = blocks.withColumn("fixed", fixed).withColumn("flips", flips)
    latest = F.last("fixed", ignorenulls=True).over(before)
    seen = F.coalesce(F.sum("flips").over(before), F.lit(0))
    told = told.withColumn("latest", latest).withColumn("seen", seen)
    odd = (F.col("seen") - F.coalesce(F.col("latest.flips"), F.lit(0))) % 2 == 1
    told = told.withColumn("state", F.coalesce(F.col("latest.out0"), F.lit(False)) != odd)
    head = F.when(F.col("state"), F.col("head1")).otherwise(F.col("head0"))
    told = told.withColumn("head", head)
    return told.select("file", "split_start", "state", F.last("head", ignorenulls=True).over(before).alias("carried"))


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split_start, row_order, record): the records of CSV files, blank lines left out.

    row_order grows along a file; a carriage return before the line feed is still there. A quote that is never closed makes the rest of its file one record.
    """
    text = spark.read.text(path, lineSep="\n")
    start = F.col("_metadata.file_block_start")
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), start.alias("split_start"), (start * 2 + in_task).alias("row_order"))
    lines = lines.mapInArrow(_line_states, LINE_STATES)
    known = lookup_join(lines, stored(_block_starts(lines), "csv-starts"), ["file", "split_start"], "inner")
    pick = lambda name: F.when(F.col("state"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    known = known.select("file", "split_start", "row_order", "value", pick("in").alias("inside"), pick("out").alias("open"), F.coalesce(pick("head"), "carried").alias("head"))
    names = ["file", "split_start", "row_order", "record"]
    whole = known.filter(~F.col("inside") & ~F.col("open")).withColumnRenamed("value", "record").select(names)
    parts = known.filter(F.col("inside") | F.col("open")).groupBy("file", "head")
    entry = F.struct("row_order", "value", "split_start")
    longer = parts.agg(F.array_sort(F.collect_list(entry)).alias("l")).select(
        "file", F.col("l")[0]["split_start"].alias("split_start"), F.col("head").alias("row_order"), F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("record")
    )
    return whole.unionByName(longer).filter(~F.col("record").isin("", "\r"))


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table with header, all text, plus (file, split_start, row_order, ordinal); cells may hold line breaks.

    Column names are those of the first file, as Spark's reader has them. ``ordinal`` is 0 and 1 for the first two
    data rows of a file and NULL for the others.
    """
    names = spark.read.csv(path, header=True, multiLine=True, escape='"').columns
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    records = materialize(read_csv_records(spark, path), "csv-records")  # the files are read twice, for states and for records
    # the first three records of a file: header and two rows
    edges = records.groupBy("file").agg(F.min(F.struct("row_order", F.col("record").endswith("\r").alias("crlf"))).alias("h"))
    edges = stored(edges.select("file", F.col("h.row_order").alias("at0"), F.col("h.crlf").alias("crlf")), "csv-heads")
    for i in (1, 2):
        later = lookup_join(records.select("file", "row_order"), edges, "file", "inner").filter(F.col("row_order") > F.col(f"at{i - 1}"))
        edges = stored(edges.join(later.groupBy("file").agg(F.min("row_order").alias(f"at{i}")), "file", "left"), "csv-heads")
    rows = lookup_join(records, edges, "file", "inner").filter(F.col("row_order") > F.col("at0"))
    # in a file of CRLF lines, those inside cells become LF as well, as Spark's reader does it
    record = F.regexp_replace(F.when(F.col("crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record")), r"\r\z", "")
    parsed = F.from_csv(record, schema, {"escape": '"', "multiLine": "true"})
    ordinal = F.when(F.col("row_order") == F.col("at1"), 0).when(F.col("row_order") == F.col("at2"), 1)
    rows = rows.select(parsed.alias("cells"), "file", "split_start", "row_order", ordinal.alias("ordinal"))
    return rows.select("cells.*", "file", "split_start", "row_order", "ordinal")
