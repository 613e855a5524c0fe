"""Prefix matching as equi joins.

A theta join on ``startswith`` compares every row with every rule. Here each *distinct*
value offers its possible prefixes, which meet the rules in a hash join; the result is
joined back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import bind, col
from ..functions.urls import absolute_url, bare_url, strip_vars
from ..session import known_bytes, materialize, row_count
from .skew import lookup_join, stored


def slash_prefixes(value: Column) -> Column:
    """All prefixes that end in ``/``, from the host (or root) on."""

    def prefixes(parts: Column) -> Column:
        # 'scheme:', '', host, ... or '', '', host, ...
        first = F.when((F.get(parts, F.lit(1)) == "") & (F.size(parts) > 2), F.lit(3)).otherwise(F.lit(1))
        last = F.size(parts) - 1
        upto = F.when(last >= first, F.sequence(first, F.greatest(last, first))).otherwise(F.array().cast("array<int>"))
        return F.transform(upto, lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))

    return bind(F.split(value, "/", -1), prefixes)


def length_prefixes() -> Column:
    """Prefixes of a column ``value`` at every length the rules use; the lengths come along as ``_lengths``."""
    wanted = F.filter("_lengths", lambda n: n <= F.length("value"))
    return F.transform(wanted, lambda n: F.col("value").substr(F.lit(1), n))


def best_prefix(values: DataFrame, rules: DataFrame, *, pick: str, slash_terminated: bool = False) -> DataFrame:
    """(value, matched, target) for the distinct column ``value`` where a rule applies.

    ``rules`` holds (ord, prefix, target). ``pick`` is ``longest`` or ``first`` (lowest ord).
    ``slash_terminated`` says that values and prefixes all end in ``/``, which needs far
    fewer candidate prefixes.
    """
    rules = stored(rules)
    if slash_terminated:
        offered = values.select("value", F.explode(slash_prefixes(F.col("value"))).alias("prefix"))
    else:
        # one array, read by the plan itself: no more lengths than the longest rule has characters
        lengths = rules.agg(F.collect_set(F.length("prefix")).alias("_lengths"))
        offered = values.withColumn("_lengths", lengths.scalar()).select("value", F.explode(length_prefixes()).alias("prefix"))
    hits = lookup_join(offered, rules.select("ord", "prefix", "target"), "prefix", "inner", right_bytes=known_bytes(rules))
    chosen = F.struct(F.col("prefix").alias("matched"), "target")
    if pick == "longest":
        best = F.min_by(chosen, F.struct(-F.length("prefix"), F.col("ord")))
    elif pick == "first":
        best = F.min_by(chosen, F.struct("ord", "prefix"))
    else:
        raise ValueError(f"unknown pick {pick!r}")
    return hits.groupBy("value").agg(best.alias("_best")).select("value", "_best.matched", "_best.target")


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    # NULL stays in: a filter would be pushed down and evaluate a computed column twice
    return df.select(F.col(name).alias("value")).distinct()


def match_prefix(
    df: DataFrame, name: str, rules: DataFrame, *, pick: str, slash_terminated: bool = False
) -> DataFrame:
    """Add ``matched`` (rule prefix) and ``target`` to every row; NULL where no rule applies."""
    best = best_prefix(distinct_values(df, name), rules, pick=pick, slash_terminated=slash_terminated)
    mapping = materialize(best.withColumnRenamed("value", name), "prefix-matches")
    joined = lookup_join(df, mapping, name, right_bytes=known_bytes(mapping))
    return joined.select(*df.columns, "matched", "target")


def first_prefix_case(value: Column | str, rules: list[tuple[str, object]], default: Column | None = None) -> Column:
    """Target of the first listed prefix; meant for short, literal lists (no join at all)."""
    value = col(value)
    if not rules:
        return default if default is not None else F.lit(None)
    out = None
    for prefix, target in rules:
        test, hit = value.startswith(prefix), target if isinstance(target, Column) else F.lit(target)
        out = F.when(test, hit) if out is None else out.when(test, hit)
    return out.otherwise(default) if default is not None else out


def dedup_rules(rules: DataFrame) -> DataFrame:
    """The first target of each prefix."""
    return (
        rules.groupBy("prefix")
        .agg(F.min("ord").alias("ord"), F.min_by("target", "ord").alias("target"))
        .select("ord", "prefix", "target")
    )


def longest_first(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.length("prefix").desc(), "ord")


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rules of the longest-first order, for a log."""
    return longest_first(rules).limit(n)


def apply_redirects(df: DataFrame, name: str, rules: DataFrame, origin: str, out: str) -> DataFrame:
    """Canonical URL by the longest matching rule, one hop; unmatched URLs stay.

    ``name`` must hold cleaned URLs (:func:`strip_vars`), and rules must come from
    :func:`dedup_rules`. The rewritten URL is computed once per distinct URL. Rows are read twice, for
    their distinct URLs and to be joined, so they are stored: their URLs are cleaned once.
    """
    df = stored(df, "link-rows")
    mapping = _redirected(distinct_values(df, name), rules, origin).withColumnsRenamed({"value": name, "canonical": "_moved"})
    mapping = materialize(mapping, "redirected")
    joined = lookup_join(df, mapping, name, right_bytes=known_bytes(mapping))
    return joined.select(*[F.col(c) for c in df.columns if c != out], F.coalesce("_moved", name).alias(out))


def chain_targets(rules: DataFrame) -> DataFrame:
    """(prefix, target, hops, cyclic): where each rule ends when the rules are applied again and again.

    ``rules`` holds (prefix, target) with unique prefixes; a target that is a prefix itself leads on. Pointer doubling: in every
    round each open rule takes over where its target's rule has come to, so n rules end in log2(n) + 1 rounds; what is
    open then runs into a cycle. A cyclic rule keeps its own target and has no hops. Rules that have ended are not read again but as targets.
    """
    spark = rules.sparkSession
    known = materialize(rules.select("prefix", "target", F.lit(1).cast("bigint").alias("hops")), "chains")
    n, done = row_count(known), []
    state = known
    for _ in range(n.bit_length() + 1):
        ahead = state.select(F.col("prefix").alias("target"), F.col("target").alias("_far"), F.col("hops").alias("_more"))
        met = lookup_join(open_ if done else state, ahead, "target", "left", right_bytes=known_bytes(known))
        met = materialize(met.select("prefix", F.coalesce("_far", "target").alias("target"), (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops"), F.col("_more").isNotNull().alias("_open")), "chains")
        done.append(met.filter("not _open").drop("_open"))
        open_ = met.filter("_open").drop("_open")
        state = _union([*done, open_])
        if open_.isEmpty():
            break
    ended = _union(done) if done else spark.createDataFrame([], known.schema)
    ended = ended.withColumn("cyclic", F.lit(False))
    if not n:
        return ended
    rounds = open_.select("prefix").join(rules.select("prefix", "target"), "prefix")
    return ended.unionByName(rounds.select("prefix", "target", F.lit(None).cast("bigint").alias("hops"), F.lit(True).alias("cyclic")))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _redirected(values: DataFrame, rules: DataFrame, origin: str) -> DataFrame:
    """(value, canonical) of the cleaned URLs that a rule rewrites."""
    best = best_prefix(values, rules, pick="longest", slash_terminated=True)
    value = F.col("value")
    moved = best.withColumn("moved", F.concat("target", value.substr(F.length("matched") + 1, F.length(value))))
    return moved.select("value", strip_vars("moved", origin).alias("canonical"))


def canonical_links(df: DataFrame, name: str, rules: DataFrame, origin: str, out: str) -> DataFrame:
    """Clean the raw URLs of ``name`` in place and add their canonical form ``out``.

    Rows only compute a cheap key, the URL without its query; the cleaning chains and the
    redirects run once per distinct key, of which there are about as many as pages.
    """
    rules = stored(rules)
    keyed = df.withColumn("_bare", bare_url(name))
    keys = keyed.select("_bare").distinct().withColumn("_absolute", absolute_url("_bare", origin))
    keys = keys.select("_bare", strip_vars("_absolute", origin).alias("_clean"))
    offered = keys.select("_bare", "_clean", F.explode_outer(slash_prefixes(F.col("_clean"))).alias("prefix"))
    hits = lookup_join(offered, rules.select("ord", "prefix", "target"), "prefix", right_bytes=known_bytes(rules))
    hit = F.when(F.col("target").isNotNull(), F.struct(-F.length("prefix"), F.col("ord")))
    best = hits.groupBy("_bare", "_clean").agg(F.min_by(F.struct("prefix", "target"), hit).alias("_best"))
    rest = F.col("_clean").substr(F.length("_best.prefix") + 1, F.length("_clean"))
    moved = F.when(F.col("_best.target").isNotNull(), strip_vars(F.concat("_best.target", rest), origin))
    mapping = materialize(best.select("_bare", "_clean", F.coalesce(moved, "_clean").alias("_canonical")), "canonical-links")
    linked = lookup_join(keyed, mapping, "_bare", right_bytes=known_bytes(mapping))
    kept = [F.col("_clean").alias(name) if c == name else F.col(c) for c in df.columns if c != out]
    return linked.select(*kept, F.col("_canonical").alias(out))
