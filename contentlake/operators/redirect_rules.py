"""Redirect rules out of server configuration lines.

A ``location`` line opens a block that waits for the next ``return``; a line that starts the
next ``location``, or any ``return``, ends the wait. Between two such ending lines only the
first opening location counts, and two-column lines after it are not rules. So the lines fall
into segments that each start at an ending line, and a rule pairs a segment's location with
the return that starts the following segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import strip_ws
from ..functions.urls import absolute_url, clean_target
from ..session import known_bytes, materialize
from .prefix import dedup_rules
from .skew import lookup_join, running_sum

# Patterns of the configuration lines.
LOCATION = r"(?iU)\Alocation\b(?:\s+[^\s]+)?\s+(/[^\s{]*)"
RETURN = r"(?iU)return\s+\d{3}\s+([^;]+);"
TWO_COLUMNS = r"(?U)\A(/\S+)\s+(/\S+)"


def _match(line: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))


def parse_redirects(lines: DataFrame, origin: str, *, file: str = "file_id", line_no: str = "line_no", line: str = "line",
                    block_rows: int = 1_000_000) -> DataFrame:
    """(file, line_no, prefix, target) in the order the rules are found, both normalised."""
    text = strip_ws(line)
    comment = F.col("text").startswith("#")
    marked = (
        lines.select(F.col(file).alias("file_id"), F.col(line_no).cast("bigint").alias("line_no"), text.alias("text"))
        .filter(F.col("text") != "")
        .select(
            "file_id",
            "line_no",
            F.col("text").startswith("location ").alias("starts"),
            F.when(~comment, _match(F.col("text"), LOCATION)).alias("location"),
            _match(F.col("text"), RETURN).alias("goes_to"),
            _match(F.col("text"), TWO_COLUMNS, 1).alias("old"),
            _match(F.col("text"), TWO_COLUMNS, 2).alias("new"),
        )
        .filter("starts or location is not null or goes_to is not null or old is not null")
    )
    ends = F.col("starts") | F.col("goes_to").isNotNull()
    # both tables are read several times below; lines that are no rule are gone by now
    numbered = materialize(running_sum(marked, ["file_id"], "line_no", ends, "segment", block_rows), "config-lines")
    opens = F.col("location").isNotNull() & F.col("goes_to").isNull()
    # one row per segment: where a block opens, and the return on the line that starts the segment
    segments = numbered.groupBy("file_id", "segment").agg(
        F.min(F.when(opens, F.col("line_no"))).alias("open_line"),
        F.min_by("location", F.when(opens, F.col("line_no"))).alias("open_old"),
        F.max(F.when(~F.col("starts"), F.col("goes_to"))).alias("closing"),
    )
    segments = materialize(segments, "config-segments")
    closing = segments.select("file_id", (F.col("segment") - 1).alias("segment"), F.col("closing").alias("target"))
    blocks = (
        segments.filter(F.col("open_line").isNotNull())
        .join(closing.filter("target is not null"), ["file_id", "segment"])
        .select("file_id", F.col("open_line").alias("line_no"), F.col("open_old").alias("old"), "target")
    )
    same_line = numbered.filter(F.col("location").isNotNull() & F.col("goes_to").isNotNull()).select(
        "file_id", "line_no", F.col("location").alias("old"), F.col("goes_to").alias("target")
    )
    # a file of two-column lines only is one single segment, hence the join that tolerates hot keys
    opened = segments.filter(F.col("open_line").isNotNull()).select("file_id", "segment", "open_line")
    paired = numbered.filter(F.col("old").isNotNull()).select("file_id", "segment", "line_no", "old", "new")
    columns = (
        lookup_join(paired, opened, ["file_id", "segment"], right_bytes=known_bytes(segments))
        .filter(F.col("open_line").isNull() | (F.col("line_no") < F.col("open_line")))
        .select("file_id", "line_no", "old", F.col("new").alias("target"))
    )
    rules = blocks.unionByName(same_line).unionByName(columns)
    prefix = absolute_url("old", origin)
    target = absolute_url(clean_target("target"), origin)
    return rules.select("file_id", "line_no", prefix.alias("prefix"), target.alias("target")).dropna()


def redirect_table(rules: DataFrame) -> DataFrame:
    """(ord, prefix, target): the first rule of each old path; ``ord`` keeps file and line order."""
    ordered = rules.select(F.struct("file_id", "line_no").alias("ord"), "prefix", "target")
    return dedup_rules(ordered)
