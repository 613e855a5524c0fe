"""Joins and running sums that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import known_bytes, materialize

#: A lookup side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 32 * 1024 * 1024
#: A key with more rows than this is split over several tasks.
HOT_ROWS = 2_000_000


def stored(df: DataFrame, label: str = "lookup") -> DataFrame:
    """``df`` as a table whose size is known; it is computed once, however often it is read."""
    return df if hasattr(df, "observed") else materialize(df, label)


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys above ``hot_rows`` with the number of slices each needs.

    At most ``rows / hot_rows`` keys can qualify, which bounds the size of the result.
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("_rows"))
    return counts.filter(F.col("_rows") > hot_rows).select(
        *[F.col(k).alias(f"_hot_{k}") for k in on], F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_slices")
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    right_bytes: int | None = None,
    left_rows: int | None = None,
) -> DataFrame:
    """Equi join of a large side with a lookup side (``how``: inner, left, left_semi, left_anti).

    A lookup that fits is broadcast and nothing is shuffled. Beyond that size both sides are
    shuffled, and rows of hot keys (NULL included) are spread over slices that each meet a
    copy of the matching lookup rows, so no single task receives a hot key. ``right_bytes`` is
    the size of the lookup side when it is known; otherwise the lookup is written once (:func:`stored`).
    ``left_rows`` are the rows of the large side when known: unless they exceed ``hot_rows``, no key has to be counted.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if right_bytes is None:
        right = stored(right)
        right_bytes = known_bytes(right)
    if right_bytes <= broadcast_bytes:
        return left.join(F.broadcast(right), keys, how)
    if left_rows is not None and left_rows <= hot_rows:
        return left.join(right, keys, how)
    # at most rows / hot_rows keys; sent to all tasks only when that is little
    hot = stored(hot_keys(left, keys, hot_rows), "hot-keys")
    hot = F.broadcast(hot) if known_bytes(hot) <= broadcast_bytes else hot

    def with_slices(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & df[k].eqNullSafe(hot[f"_hot_{k}"])
        joined = df.join(hot, same, "left").drop(*[f"_hot_{k}" for k in keys])
        return joined.withColumn("_slices", F.coalesce("_slices", F.lit(1)))

    # The slice follows from the row and its partition number: a recomputed task puts each row in
    # the same place again, and identical copies still spread, as they sit in many partitions.
    parts = [F.col(f"`{c}`").cast("string") if _is_map(left, c) else F.col(f"`{c}`") for c in left.columns]
    row_hash = F.xxhash64(*parts, F.spark_partition_id())
    sliced_left = with_slices(left.withColumn("_hash", row_hash)).withColumn(
        "_slice", F.pmod("_hash", F.col("_slices").cast("bigint")).cast("int")
    )
    sliced_right = with_slices(right).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    joined = sliced_left.drop("_hash", "_slices").join(sliced_right.drop("_slices"), [*keys, "_slice"], how)
    return joined.drop("_slice")


def _is_map(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.simpleString().startswith("map")


def running_sum(
    df: DataFrame, group: list[str], order: str | list[str], value: Column, name: str, block_rows: int = 1_000_000
) -> DataFrame:
    """Inclusive running sum of ``value`` per group, see :func:`running_sums`."""
    return running_sums(df, group, order, {name: value}, block_rows)


def running_sums(
    df: DataFrame, group: list[str], order: str | list[str], values: dict[str, Column], block_rows: int = 1_000_000
) -> DataFrame:
    """Inclusive running sums of several values per group along an integer ordinal, the last of ``order``.

    Each group is cut into blocks of ordinals (and of the order columns before it, such as the file): blocks are summed
    first, the block totals are accumulated, and rows are only ever sorted inside one block. A
    group of any size is therefore spread over many tasks. NULL groups are groups too. ``df`` is read twice, once
    for the totals: pass a stored table.
    """
    outer, ordinal = ([], order) if isinstance(order, str) else (list(order[:-1]), order[-1])
    names = list(values)
    rows = df.withColumns({f"_value_{i}": values[n].cast("bigint") for i, n in enumerate(names)})
    rows = rows.withColumn("_block", F.expr(f"`{ordinal}` div {block_rows}"))
    at = [*outer, "_block"]
    before = Window.partitionBy(*group).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, *at]
    totals = rows.groupBy(*keys).agg(*[F.sum(f"_value_{i}").alias(f"_total_{i}") for i in range(len(names))])
    offsets = totals.select(
        *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"_total_{i}").over(before), F.lit(0)).alias(f"_offset_{i}") for i in range(len(names))],
    )
    inside = Window.partitionBy(*keys).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, 0)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(offsets[f"_of_{i}"])
    summed = {n: F.col(f"_offset_{i}") + F.sum(f"_value_{i}").over(inside) for i, n in enumerate(names)}
    helpers = [f"_{kind}_{i}" for kind in ("value", "offset") for i in range(len(names))]
    return rows.join(offsets, same).withColumns(summed).drop("_block", *helpers, *[f"_of_{i}" for i in range(len(keys))])
