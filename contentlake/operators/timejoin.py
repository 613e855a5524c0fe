"""Joins by time: the latest row before a point, and the intervals that hold a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import known_bytes, materialize, row_count
from .skew import hot_keys, lookup_join, stored

#: Rows of a block of the time order.
BLOCK_ROWS = 1_000_000
#: A key with more intervals than this is crowded: its intervals meet their points by cells.
FEW_INTERVALS = 64
#: Points of one key that one task joins by the key alone.
HOT_POINTS = 250_000


def asof_join(
    left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], strictly: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every left row with ``values`` of the newest right row of its key at or before (``strictly``: before) its time.

    Both sides are united and dealt into blocks by ranges of (key, time), so a key of any size is spread over many tasks. Inside
    a block the last right row is carried forward; what a block's key starts with comes from the earlier blocks of that key, of
    which only the last right row each is looked at. Of right rows of one key and time the largest by ``values`` counts.
    Rows of null key or time match nothing; left rows without a match get nulls.
    """
    value = F.struct(*[F.col(v) for v in values])
    news = right.filter(F.col(right_time).isNotNull()).dropna(subset=on).groupBy(*on, F.col(right_time).alias("_time")).agg(F.max(value).alias("_value"))
    rows = left.select(*on, F.col(left_time).alias("_time"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    both = news.select(*on, "_time", F.lit(int(strictly)).alias("_side"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), "_value")
    both = both.unionByName(rows.select(*on, "_time", F.lit(1 - int(strictly)).alias("_side"), "_row", F.lit(None).cast(news.schema["_value"].dataType).alias("_value")))
    # rows of one key and time stay apart by their content: many of them need not meet in one block
    both = stored(both.withColumn("_salt", F.xxhash64(F.to_json("_row"))), "asof-rows")
    order = [*on, "_time", "_side", "_salt"]
    blocks = max(1, -(-row_count(both) // block_rows))
    dealt = both.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id())
    dealt = materialize(dealt, "asof-blocks")
    place = F.struct("_time", "_side", "_salt")
    last = dealt.groupBy(*on, "_block").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), place)).alias("_last"))
    earlier = Window.partitionBy(*on).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*on, "_block", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")).filter("_carried is not null")
    carried = stored(carried, "asof-carried")
    inside = Window.partitionBy("_block", *on).orderBy("_time", "_side", "_salt").rowsBetween(Window.unboundedPreceding, 0)
    filled = dealt.withColumn("_value", F.last("_value", ignorenulls=True).over(inside)).filter("_row is not null")
    filled = lookup_join(filled, carried, [*on, "_block"], "left", right_bytes=known_bytes(carried))
    found = F.coalesce("_value", "_carried")
    timed = F.col("_time").isNotNull()
    return filled.select("_row.*", *[F.when(timed, found[v]).alias(v) for v in values])


def _cover(start: Column, end: Column, levels: int) -> Column:
    """The fewest dyadic cells (level, cell) that fill [start, end); cell c of level k is [c 2^k, (c + 1) 2^k)."""
    long = lambda c: c.cast("bigint")
    empty = F.expr("cast(array() as array<struct<level:int,cell:bigint>>)")
    first = F.struct(long(start).alias("l"), long(end).alias("r"), empty.alias("cells"))

    def step(acc: Column, level: Column) -> Column:
        left, right = acc["l"], acc["r"]
        take_left = (left < right) & (left % 2 == 1)
        next_left = left + F.when(take_left, 1).otherwise(0)
        take_right = (next_left < right) & (right % 2 == 1)
        next_right = right - F.when(take_right, 1).otherwise(0)
        cell = lambda number: F.struct(level.cast("int").alias("level"), long(number).alias("cell"))
        found = F.concat(acc["cells"], F.when(take_left, F.array(cell(left))).otherwise(empty), F.when(take_right, F.array(cell(next_right))).otherwise(empty))
        return F.struct(long(F.shiftright(next_left, 1)).alias("l"), long(F.shiftright(next_right, 1)).alias("r"), found.alias("cells"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), first, step, lambda acc: acc["cells"])


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, few: int = FEW_INTERVALS) -> DataFrame:
    """All pairs of a point and an interval of its key with start <= at < end; the numbers are integers, a null end is open.

    Keys of at most ``few`` intervals are joined by the key alone, so that each point and each interval is sent once and a point
    is compared with ``few`` intervals at most. Only crowded keys take the way over cells (:func:`_cell_join`), whose work does not grow with
    the intervals of a key. Both sides are stored, as they are read several times; of the intervals, those that reach into the range of the points.
    Points without key or number, and empty intervals, match nothing. Column names of the two sides must differ, but for ``on``.
    """
    columns = [F.col(f"`{c}`") for c in [*points.columns, *[c for c in intervals.columns if c not in on]]]
    number = lambda c: F.col(c).cast("bigint")
    points = stored(points.filter(F.col(at).isNotNull()).dropna(subset=on), "interval-points")
    ends = points.agg(F.min(at).cast("bigint").alias("low"), F.max(at).cast("bigint").alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    a = F.greatest(number(start), F.lit(low)) - low
    b = F.least(F.coalesce(number(end), F.lit(high + 1)), F.lit(high + 1)) - low
    spans = stored(intervals.filter(F.col(start).isNotNull() & (a < b)).dropna(subset=on), "intervals")
    crowded = hot_keys(spans, on, few).select(*[F.col(f"_hot_{k}").alias(k) for k in on])
    crowded = stored(crowded, "crowded-keys")
    near_points, near_spans, far = points, spans, None
    if row_count(crowded):
        of = lambda df, how: lookup_join(df, crowded, on, how, right_bytes=known_bytes(crowded))
        near_points, near_spans = of(points, "left_anti"), of(spans, "left_anti")
        far = _cell_join(of(points, "left_semi"), of(spans, "left_semi"), on, at, a, b, low, int(high - low + 1).bit_length())
    met = lookup_join(near_points, near_spans, on, "inner", hot_rows=HOT_POINTS, right_bytes=known_bytes(spans), left_rows=row_count(points))
    near = met.filter((number(start) <= number(at)) & F.coalesce(number(at) < number(end), F.lit(True))).select(*columns)
    return near if far is None else near.unionByName(far.select(*columns))


def _cell_join(points: DataFrame, spans: DataFrame, on: list[str], at: str, a: Column, b: Column, low: int, levels: int) -> DataFrame:
    """Points with the spans [a, b) that hold them, both counted from ``low``.

    A span is dealt to the fewest dyadic cells that fill it, two per level at most, and a point offers its cell of each
    level that spans use: an equi join that meets every pair once. A crowded cell is sliced by the join.
    """
    cells = spans.withColumn("_cover", F.explode(_cover(a, b, levels)))
    cells = stored(cells.select("*", "_cover.level", "_cover.cell").drop("_cover").withColumnsRenamed({"level": "_level", "cell": "_cell"}), "interval-cells")
    used = sorted(r["_level"] for r in cells.select("_level").distinct().collect())  # at most 64 numbers
    offered = points.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in used]).cast("array<int>")))
    offered = offered.withColumn("_cell", F.expr(f"shiftright(cast(`{at}` as bigint) - {low}L, _level)"))
    return lookup_join(offered, cells, [*on, "_level", "_cell"], "inner", right_bytes=known_bytes(cells))
