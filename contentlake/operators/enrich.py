"""Lookups by rounded coordinate, nearest place and latest commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import known_bytes, materialize, row_count
from .aggregates import latest_per_key
from .skew import lookup_join

# Coordinates are rounded to five decimals.
DECIMALS = 5

#: A cell of the place tree is split above so many places, down to cells of 2 / 2**FINEST on the unit sphere.
LEAF_PLACES, FINEST = 32, 24
#: Levels from a cell to its children (8 ** STEP of them at most), and how many such steps are counted together.
STEP, TOGETHER = 2, 4
#: Distances are compared at 12 digits; cells this near to a bound still count.
ROUNDING = 1e-11


def coordinate_key(value: str) -> Column:
    """Rounded coordinate as an integer, so equality does not depend on float formatting."""
    return F.round(F.col(value).try_cast("double") * 10**DECIMALS).try_cast("bigint")


def with_coordinate_keys(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds (lat_key, lon_key); both NULL when either coordinate is missing or off the globe."""
    numbers = [F.col(c).try_cast("double") for c in (lat, lon)]
    usable = F.coalesce((F.abs(numbers[0]) <= 90) & (F.abs(numbers[1]) <= 180), F.lit(False))
    return df.withColumn("lat_key", F.when(usable, coordinate_key(lat))).withColumn(
        "lon_key", F.when(usable, coordinate_key(lon))
    )


def missing_keys(df: DataFrame, cache: DataFrame, lat: str, lon: str) -> DataFrame:
    """Distinct coordinates the cache does not hold yet."""
    keys = with_coordinate_keys(df, lat, lon).select("lat_key", "lon_key").dropna().distinct()
    return keys.join(cache.select("lat_key", "lon_key"), ["lat_key", "lon_key"], "left_anti")


def upsert_cache(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Known entries stay as they are, unknown keys are added. Write it to a new folder, or use :func:`append_cache`."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches a cache folder holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def append_cache(new: DataFrame, path: str, keys: list[str], batch: int) -> None:
    """Add the keys of ``new`` that earlier batches of the cache in ``path`` do not hold; nothing that is stored is written again.

    Only the keys of the cache are read. A batch goes to a folder of its own, which it replaces, so a batch that is repeated
    leaves the same cache; batches have growing numbers and one writer. Of rows with equal keys the smallest counts; null keys are left out.
    """
    spark = new.sparkSession
    rest = F.struct(*[F.col(c) for c in new.columns if c not in keys])
    once = new.dropna(subset=keys).groupBy(*keys).agg(F.min(rest).alias("_rest")).select(*keys, "_rest.*")
    earlier = [f"{path}/batch={b}" for b in _batches(spark, path) if b < batch]
    if earlier:
        once = once.join(spark.read.option("basePath", path).parquet(*earlier).select(*keys), keys, "left_anti")
    once.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the cache, and the batch they came with."""
    return spark.read.parquet(path)


def attach_country(df: DataFrame, cache: DataFrame, lat: str, lon: str, out: str = "country") -> DataFrame:
    """Map the cache back onto all rows; unusable coordinates get NULL."""
    keyed = with_coordinate_keys(df, lat, lon)
    entries = cache.select("lat_key", "lon_key", F.col("country").alias(out))
    return lookup_join(keyed, entries, ["lat_key", "lon_key"]).select(*df.columns, out)


def _on_sphere(lat: Column, lon: Column) -> list[Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def _cell(level: Column | int, *xyz: Column) -> Column:
    """Cell of a point on the unit sphere at a level: its cube of edge 2 / 2**level, as one struct."""
    size = F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)
    top = (size - 1).cast("bigint")
    return F.struct(*[F.least(top, F.floor((c + 1) / 2 * size)).alias(n) for n, c in zip("ijk", xyz)])


def _parent(cell: str) -> Column:
    """The cell one step of levels above."""
    return F.struct(*[F.floor(F.col(f"{cell}.{i}") / 2**STEP).alias(i) for i in "ijk"])


def place_tree(places: DataFrame, leaf: int = LEAF_PLACES) -> DataFrame:
    """Tree of cells over places (id, country, px, py, pz): (level, cell, n, and a place of it: rx, ry, rz), stored.

    A cell is split until it holds ``leaf`` places or the finest level is reached, so cells adapt to the
    density. ``TOGETHER`` levels are counted in one grouping, with partial sums; only places of cells that are still full go on.
    Cells below one that is not full are left out.
    """
    levels = list(range(0, FINEST + 1, STEP))
    counts, rest = None, places
    for at in range(0, len(levels), TOGETHER):
        some = levels[at : at + TOGETHER]
        located = rest.withColumn("level", F.explode(F.array(*[F.lit(x) for x in some])))
        located = located.withColumn("cell", _cell(F.col("level"), F.col("px"), F.col("py"), F.col("pz")))
        one = F.min(F.struct("place_id", "px", "py", "pz")).alias("r")
        counted = materialize(located.groupBy("level", "cell").agg(F.count("*").alias("n"), one), "place-cells")
        counts = counted if counts is None else counts.unionByName(counted)
        full = counted.filter((F.col("level") == some[-1]) & (F.col("n") > leaf)).select("cell")
        if some[-1] == levels[-1] or full.isEmpty():
            break
        rest = materialize(located.filter(F.col("level") == some[-1]).join(full, "cell", "left_semi").drop("cell", "level"), "places")
    full = counts.filter(F.col("n") > leaf).select((F.col("level") + STEP).alias("level"), F.col("cell").alias("above"))
    split = counts.filter("level > 0").withColumn("above", _parent("cell")).join(full, ["level", "above"], "left_semi")
    nodes = counts.filter("level = 0").unionByName(split.drop("above"))
    nodes = nodes.select("level", "cell", "n", F.col("r.px").alias("rx"), F.col("r.py").alias("ry"), F.col("r.pz").alias("rz"))
    return materialize(nodes, "place-tree")


def nearest_place(points: DataFrame, places: DataFrame, leaf: int = LEAF_PLACES) -> DataFrame:
    """(lat_key, lon_key, country) of the closest place by great circle, for distinct points.

    ``points`` holds (lat_key, lon_key); ``places`` (place_id, lat, lon, country). Both are put on
    the unit sphere, where no pole or date line interferes. Points descend the tree of the places, a step of levels in
    one round: of the cells that a point still considers, one place each gives an upper bound of its
    distance, and cells that lie beyond the least bound are left. In the leaves that remain, of all levels at once, every
    place is compared, so the answer is exact. Ties go to the lowest place_id. Places at one spot count as one.
    """
    scale = float(10**DECIMALS)
    keys = ["lat_key", "lon_key"]
    x, y, z = _on_sphere(F.col("lat_key") / scale, F.col("lon_key") / scale)
    todo = points.select(*keys, x.alias("x"), y.alias("y"), z.alias("z"))
    x, y, z = _on_sphere(F.col("lat"), F.col("lon"))
    spots = places.select("place_id", "country", x.alias("px"), y.alias("py"), z.alias("pz"))
    spots = spots.groupBy("px", "py", "pz").agg(F.min(F.struct("place_id", "country")).alias("p")).select("p.*", "px", "py", "pz")
    spots = materialize(spots, "places")
    nodes = place_tree(spots, leaf)
    square = lambda a, b: (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
    edge = F.lit(2.0) / F.pow(F.lit(2.0), F.col("level"))

    def gap(axis: str, index: str) -> Column:
        """Distance of the point to the cell along one axis."""
        low = F.col(f"cell.{index}") * edge - 1
        return F.greatest(F.lit(0.0), low - F.col(axis), F.col(axis) - low - edge)

    near = sum((gap(a, i) * gap(a, i) for a, i in zip("xyz", "ijk")), F.lit(0.0))
    bound = square("x", "rx") + square("y", "ry") + square("z", "rz")
    root = nodes.filter("level = 0")  # one cell
    at = todo.withColumn("cell", _cell(0, F.col("x"), F.col("y"), F.col("z"))).join(F.broadcast(root), "cell")
    at = at.withColumn("d_best", F.lit(4.0))
    found, level = [], 0
    own = Window.partitionBy(*keys)  # the cells of one point: at most some dozens
    while True:
        judged = at.withColumn("d_near", near).withColumn("d_least", F.min(F.least(bound, F.col("d_best"))).over(own))
        kept = judged.filter(F.col("d_near") <= F.col("d_least") + ROUNDING)
        kept = kept.withColumn("d_best", F.col("d_least")).drop("d_near", "d_least", "rx", "ry", "rz")
        kept = materialize(kept, "cells-at-points")
        if not row_count(kept):
            break
        open_ = (F.col("n") > leaf) & (F.lit(level) < FINEST)
        found.append(kept.filter(~open_).select(*keys, "x", "y", "z", "level", "cell"))
        level += STEP
        children = nodes.filter(F.col("level") == level).select("level", _parent("cell").alias("above"), F.col("cell").alias("child"), "n", "rx", "ry", "rz")
        waiting = kept.filter(open_).drop("level", "n").withColumnRenamed("cell", "above")
        at = lookup_join(waiting, children, "above", "inner", right_bytes=known_bytes(nodes))
        at = at.select(*keys, "x", "y", "z", "d_best", "level", F.col("child").alias("cell"), "n", "rx", "ry", "rz")
    if not found:
        return points.select(*keys, F.lit(None).cast("string").alias("country")).limit(0)
    met = found[0]
    for part in found[1:]:
        met = met.unionByName(part)
    # every place under the leaf that houses it
    leaves = nodes.filter((F.col("n") <= leaf) | (F.col("level") == FINEST)).select("level", "cell")
    levels = F.explode(F.array(*[F.lit(x) for x in range(0, level, STEP)]))
    housed = spots.withColumn("level", levels).withColumn("cell", _cell(F.col("level"), F.col("px"), F.col("py"), F.col("pz")))
    housed = housed.join(leaves, ["level", "cell"], "left_semi")
    met = lookup_join(met, housed, ["level", "cell"], "inner", right_bytes=2 * known_bytes(spots))
    chord = square("x", "px") + square("y", "py") + square("z", "pz")
    best = met.groupBy(*keys).agg(F.min(F.struct(F.round(chord, 12).alias("d2"), "place_id", "country")).alias("b"))
    return materialize(best.select(*keys, F.col("b.country").alias("country")), "nearest")


def country_names(located: DataFrame, names: DataFrame) -> DataFrame:
    """Replace country codes by names; a code without a name stands for itself."""
    named = lookup_join(located, names.select(F.col("code").alias("country"), "name"), "country")
    return named.withColumn("country", F.coalesce("name", "country")).drop("name")


def last_commit(files: DataFrame, commits: DataFrame, key: str, ts: str) -> DataFrame:
    """ISO time of the newest commit of each file, with the session's offset, '' when there is none."""
    newest = latest_per_key(commits, key, ts, "_last")
    iso = F.date_format("_last", "yyyy-MM-dd'T'HH:mm:ssxxx")
    return files.join(newest, key, "left").withColumn("last_commit", F.coalesce(iso, F.lit(""))).drop("_last")
