"""Secret scan over a trigram inverted index, in DataFrame functions only.

Each rule's regular expression yields a Boolean query over lower-cased trigrams: a set of clauses,
of which a matching text satisfies at least one by holding all its trigrams. The postings of these
trigrams are built from the table, intersected per clause by counting, and the surviving (text,
rule) candidates are verified with the expression itself. A rule whose query is empty, for want of
a mandatory trigram, runs on every text.

Matches are leftmost and non-overlapping per rule; a match whose checked group is too short is
dropped (it still uses up its text). Positions are code points, ends exclusive.

Cases: a null text counts as empty and has no spans; rows are matched to candidates by a 128-bit
hash of id and text, so repeated rows and null ids work; an empty table gives no rows; other columns
are kept, one named like an output column is replaced.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as regex_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import bind
from .tables import free_names, q

MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``kind`` names the rule; the text of ``group`` must have at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base rules. A run of 24 or more hexadecimal digits is matched as such: the same spans as of
#: ``[0-9a-f]+`` with the shorter ones dropped, since a match never begins inside a run.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further kinds of published credential formats.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

Query = frozenset  # of clauses, each a frozenset of trigrams; a query with an empty clause is always true
ALWAYS: Query = frozenset([frozenset()])


def _least(clauses) -> Query:
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _both(a: Query, b: Query) -> Query:
    made = _least({x | y for x in a for y in b})
    return made if len(made) <= MAX_STRINGS else min(a, b, key=len)  # one of two conditions is still necessary


def _strings(seq) -> set[str] | None:
    """All strings that a part of an expression stands for, if they are few."""
    out = {""}
    for op, arg in seq:
        if op in (rc.LITERAL, rc.NOT_LITERAL, rc.ANY, rc.IN):
            if op is rc.LITERAL:
                some = {chr(arg).lower()}
            elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len(arg) <= 8:
                some = {chr(a).lower() for _, a in arg}
            else:
                return None
        elif op in (rc.AT, rc.ASSERT, rc.ASSERT_NOT):
            some = {""}
        elif op is rc.SUBPATTERN:
            some = _strings(arg[3])
        elif op is rc.BRANCH:
            parts = [_strings(p) for p in arg[1]]
            some = None if None in parts else set().union(*parts)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] <= 5:
            once = _strings(arg[2])
            some = None
            if once is not None and len(once) ** arg[1] <= MAX_STRINGS:
                power, some = {""}, set()
                for n in range(arg[1] + 1):
                    if n >= arg[0]:
                        some |= power
                    power = {a + b for a in power for b in once}
        else:
            return None
        if some is None or len(out) * len(some) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in some}
    return out


def _all_of(strings: set[str]) -> Query:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _query(seq) -> Query:
    result, run = ALWAYS, {""}
    for node in seq:
        some = _strings([node])
        if some is not None and len(run) * len(some) <= MAX_STRINGS:
            run = {a + b for a in run for b in some}
            continue
        result, run = _both(result, _all_of(run)), some if some is not None else {""}
        op, arg = node
        if some is not None:
            continue
        if op is rc.SUBPATTERN:
            result = _both(result, _query(arg[3]))
        elif op is rc.BRANCH:
            result = _both(result, _least(frozenset().union(*[_query(p) for p in arg[1]])))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] > 0:
            result = _both(result, _query(arg[2]))
    return _both(result, _all_of(run))


def trigram_query(pattern: str) -> Query:
    """Clauses of lower-cased trigrams, one of which any matching text holds whole."""
    return _query(regex_parser.parse(pattern))


def postings(docs: DataFrame, text: str, keys: list[str], trigrams: list[str]) -> DataFrame:
    """The inverted index of these trigrams: (trigram, keys), without texts."""
    low = F.lower(q(text))
    present = F.filter(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    return docs.select(*keys, low.alias("_low")).select(*keys, F.explode(present).alias("trigram"))


def candidates(index: DataFrame, keys: list[str], queries: dict[str, Query]) -> DataFrame:
    """(keys, kinds): rules whose Boolean query holds, by intersecting postings clause by clause."""
    spark = index.sparkSession
    clauses = [(t, kind, k, len(c)) for kind, query in queries.items() for k, c in enumerate(sorted(query, key=sorted)) for t in sorted(c)]
    wanted = spark.createDataFrame(clauses, "trigram string, kind string, clause int, need int")  # fixed by the rules
    met = index.join(F.broadcast(wanted), "trigram").groupBy(*keys, "kind", "clause", "need").agg(F.count_distinct("trigram").alias("have"))
    return met.filter("have = need").groupBy(*keys).agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of a rule's matches in a text."""

    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def place(steps: Column) -> Column:
        """steps: gap and match length of each match; running sums by blocks of 256."""
        each = F.transform(steps, lambda s: s["gap"] + s["found"])
        blocks = F.sequence(F.lit(0), F.floor(F.size(steps) / 256).cast("int"))
        return bind(
            F.struct(steps.alias("s"), each.alias("each")),
            lambda v: bind(
                F.struct(v["s"].alias("s"), v["each"].alias("each"), F.transform(blocks, lambda b: total(F.slice(v["each"], b * 256 + 1, 256))).alias("sums")),
                lambda w: F.transform(
                    w["s"],
                    lambda s, i: F.struct(
                        (total(F.slice(w["sums"], F.lit(1), F.floor(i / 256).cast("int"))) + total(F.slice(w["each"], F.floor(i / 256).cast("int") * 256 + 1, i % 256)) + s["gap"]).alias("start"),
                        s["found"].alias("found"),
                        s["checked"].alias("checked"),
                    ),
                ),
            ),
        )

    zipped = F.zip_with(F.arrays_zip(found.alias("found"), checked.alias("checked")), gaps, lambda m, g: F.struct(g.alias("gap"), m["found"].alias("found"), m["checked"].alias("checked")))
    steps = F.filter(zipped, lambda s: s["found"].isNotNull())
    placed = bind(steps, place)
    kept = F.filter(placed, lambda s: s["checked"] >= rule.least)
    out = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["found"]).alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(text.rlike(rule.pattern), out).otherwise(none)


def _named(no: int, rule: Rule):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), F.lit(rule.kind).alias("kind"), s["end"].alias("end"))


def scan_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """``docs`` with ``found``: array of (start, kind_no, kind, end), by start, then by rule order."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "found" and c != text])
    k1, k2, kinds, body = free_names(docs, "k1", "k2", "kinds", "body")
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: c for k, c in queries.items() if frozenset() not in c}
    values = [F.coalesce(F.to_json(F.struct(q(c))) if docs.schema[c].dataType.typeName() in ("map", "struct", "array", "variant") else q(c).cast("string"), F.lit("\0")) for c in docs.columns]
    rows = docs.withColumn(k1, F.xxhash64(*values)).withColumn(k2, F.xxhash64(F.lit(1), *reversed(values)))
    rows = rows.withColumn(body, F.coalesce(q(text), F.lit("")))
    if indexed:
        trigrams = sorted(reduce(lambda a, b: a | b, [t for c in indexed.values() for t in c]))
        some = candidates(postings(rows, body, [k1, k2], trigrams), [k1, k2], indexed).withColumnRenamed("kinds", kinds)
        rows = rows.join(some, [k1, k2], "left")
    else:
        rows = rows.withColumn(kinds, F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,kind_no:int,kind:string,end:int>>")
    parts = []
    for no, rule in enumerate(rules):
        own = F.transform(spans(q(body), rule), _named(no, rule))
        parts.append(F.when(F.array_contains(q(kinds), rule.kind), own).otherwise(none) if rule.kind in indexed else own)
    return rows.withColumn("found", F.sort_array(F.concat(*parts))).drop(k1, k2, kinds, body)


def spelled(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
