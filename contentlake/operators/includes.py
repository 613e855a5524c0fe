"""Include fragments: usage audit and recursive expansion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import bind, col, computed, head_and_tail
from ..functions.markup import SHORTCODE_END, include_gaps, include_key, include_refs
from ..functions.text import VERSIONS_LINE, strip_front_matter
from ..session import known_bytes, materialize, row_count
from .filters import not_index
from .skew import lookup_join

# A noncharacter that stands for a line break inside an expanded fragment.
_INNER_BREAK = "\ufdd0"


def include_usage(docs: DataFrame, fragments: DataFrame) -> DataFrame:
    """Every fragment with the number of lines that reference it (0 kept).

    A reference names a fragment with or without a leading slash, or without ``.md``. Keys
    are deduplicated inside their line, so one counting shuffle with partial sums suffices.
    """
    lines = docs.select(F.explode(F.split("content", "\n")).alias("line")).filter(F.col("line").contains("{{<"))
    forms = F.flatten(
        F.transform(
            include_refs("line", double_quotes_only=True),
            lambda r: F.array(r, F.concat(r, F.lit(".md")), F.regexp_replace(r, r"\A/", "")),
        )
    )
    used = (
        lines.select(F.explode(F.array_distinct(forms)).alias("include_path"))
        .groupBy("include_path")
        .agg(F.count("*").alias("uses"))
    )
    return (
        fragments.filter(not_index("include_path"))
        .select("include_path")
        .distinct()
        .join(used, "include_path", "left")
        .select("include_path", F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses"))
    )


def unused_fragments(usage: DataFrame) -> DataFrame:
    return usage.filter(F.col("uses") == 0)


def used_once(usage: DataFrame) -> DataFrame:
    return usage.filter(F.col("uses") == 1)


def usage_totals(usage: DataFrame) -> DataFrame:
    return usage.agg(
        F.count("*").alias("fragments"),
        F.count_if(F.col("uses") == 0).alias("unused"),
        F.count_if(F.col("uses") == 1).alias("used_once"),
    )


def _interleave(gaps: Column, texts: Column) -> Column:
    """gap 0, text 0, gap 1, ... joined."""

    def join(p: Column) -> Column:
        pairs = F.transform(p["texts"], lambda t, i: F.concat(F.get(p["gaps"], i), t))
        return F.concat(F.array_join(pairs, ""), F.element_at(p["gaps"], -1))

    return bind(F.struct(gaps.alias("gaps"), texts.alias("texts")), join)


def _keys(text: Column | str) -> Column:
    """The fragments a text includes, in order."""
    return F.transform(include_refs(text), include_key)


def resolve_fragments(fragments: DataFrame) -> DataFrame:
    """Expand every fragment once, leaves first: ``(ref, text, n_missing, missing)``.

    Each round completes the fragments whose references are all done, so a fragment shared by
    many others is expanded a single time. What never completes is part of, or leads into, a
    cycle; it is returned with ``text`` NULL.
    """
    texts = fragments.select(
        F.regexp_replace("include_path", r"\A/+", "").alias("ref"), computed(strip_front_matter("content")).alias("text")
    )
    # stored, since four steps below read it: every fragment is stripped and searched once
    source = materialize(texts.select("ref", "text", _keys("text").alias("refs")), "sources")
    empty = F.array().cast("array<string>")
    no_refs = F.size("refs") == 0
    nothing = [F.lit(0).cast("bigint").alias("n_missing"), empty.alias("missing")]
    fresh = materialize(source.filter(no_refs).select("ref", "text", *nothing), "fragments")
    open_ = source.filter(~no_refs).select(F.col("ref").alias("owner"), "text", "refs")
    uses = open_.select("owner", F.posexplode("refs").alias("pos", "ref"))
    known = lookup_join(uses, source.select("ref", F.lit(True).alias("exists")), "ref")
    piece = "struct<pos:int,t:string,n_missing:bigint,missing:array<string>>"
    gone = F.struct(F.col("pos"), F.lit("").alias("t"), F.lit(1).cast("bigint").alias("n_missing"), F.array("ref").alias("missing"))
    # an owner carries the pieces it has and the references it waits for
    waiting = known.groupBy("owner").agg(
        F.collect_list(F.when(F.col("exists").isNull(), gone.cast(piece))).alias("pieces"),
        F.collect_list(F.when(F.col("exists").isNotNull(), F.struct("pos", "ref"))).alias("wanted"),
    )
    waiting = materialize(open_.drop("refs").join(waiting, "owner"), "open-fragments")
    rounds = [fresh]
    while row_count(waiting) and (row_count(fresh) or len(rounds) == 1):
        # only what is still open meets what the last round completed
        asked = waiting.select("owner", F.explode("wanted").alias("w")).select("owner", "w.pos", "w.ref")
        hits = lookup_join(asked, fresh, "ref", "inner", right_bytes=known_bytes(fresh)).groupBy("owner").agg(
            F.collect_list(F.struct("pos", F.col("text").alias("t"), "n_missing", "missing").cast(piece)).alias("got")
        )
        got = F.coalesce("got", F.array().cast(f"array<{piece}>"))
        moved = waiting.join(hits, "owner", "left").select(
            "owner", "text", F.concat("pieces", got).alias("pieces"),
            F.filter("wanted", lambda w: ~F.exists(got, lambda g: g["pos"] == w["pos"])).alias("wanted"),
        )
        moved = materialize(moved, "open-fragments")
        full = moved.filter(F.size("wanted") == 0)
        sorted_ = F.sort_array("pieces")
        done_text = _interleave(include_gaps("text"), F.transform(sorted_, lambda p: p["t"])).alias("text")
        fresh = materialize(
            full.select(
                F.col("owner").alias("ref"), done_text,
                F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, p: n + p["n_missing"]).alias("n_missing"),
                F.array_sort(F.array_distinct(F.flatten(F.transform("pieces", lambda p: p["missing"])))).alias("missing"),
            ),
            "fragments",
        )
        rounds.append(fresh)
        waiting = materialize(moved.filter(F.size("wanted") > 0), "open-fragments")
        if not row_count(fresh):
            break
    done = reduce(DataFrame.unionByName, rounds)
    return done.unionByName(waiting.select(F.col("owner").alias("ref"), F.lit(None).cast("string").alias("text"), *nothing))


def expand_includes(
    docs: DataFrame, fragments: DataFrame, *, key: str = "path", text: str = "content", compat: bool = False
) -> DataFrame:
    """Replace include shortcodes of documents by fragment text.

    Adds ``expanded``, ``n_errors`` (missing fragments, or 1 for a cycle) and ``error``. A missing
    fragment leaves nothing behind; a document that reaches a cycle has ``expanded`` NULL.
    ``compat`` drops a whole line when an expansion inside it holds a ``versions`` shortcode.
    Patterns only search the lines up to the last shortcode.
    """
    resolved = materialize(resolve_fragments(fragments), "fragments")
    # documents without a reference need no join, so their text is never shuffled
    cut = docs.select(*docs.columns, computed(head_and_tail(col(text), [SHORTCODE_END])).alias("_cut"))
    head, tail = F.col("_cut.head"), F.col("_cut.tail")
    has_refs = head.contains("{{<") & (F.size(include_refs(head)) > 0)
    has_refs = F.coalesce(has_refs, F.lit(False))
    with_refs = cut.filter(has_refs)
    untouched = cut.filter(~has_refs).select(
        *docs.columns, col(text).alias("expanded"), F.lit(0).cast("bigint").alias("n_errors"), F.lit(None).cast("string").alias("error")
    )
    # stored: the join reads them twice when the fragments are no broadcast, and texts are searched once
    refs = materialize(cut.select(key, F.posexplode(_keys(head)).alias("pos", "ref")), "references")
    joined = lookup_join(refs, resolved.withColumn("found", F.lit(True)), "ref", right_bytes=known_bytes(resolved))
    found = F.coalesce("found", F.lit(False))
    piece = F.coalesce("text", F.lit(""))
    empty = F.array().cast("array<string>")
    per_doc = joined.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", piece.alias("t")))).alias("_parts"),
        F.count_if(~found).alias("_gone"),
        F.sum(F.coalesce("n_missing", F.lit(0))).alias("_nested"),
        F.bool_or(found & F.col("text").isNull()).alias("_cycle"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(
            F.when(~found, F.array("ref")).otherwise(F.coalesce("missing", empty)))))).alias("_missing"),
    )
    cycle = F.coalesce("_cycle", F.lit(False))
    pieces = F.col("_parts.t")
    if compat:
        pieces = F.transform(pieces, lambda t: F.replace(t, F.lit("\n"), F.lit(_INNER_BREAK)))
    filled = _interleave(include_gaps(head), pieces)
    if compat:
        kept = F.filter(
            F.split(filled, "\n", -1), lambda line: ~F.replace(line, F.lit(_INNER_BREAK), F.lit("\n")).rlike(VERSIONS_LINE)
        )
        filled = F.replace(F.array_join(kept, "\n"), F.lit(_INNER_BREAK), F.lit("\n"))
    missing = F.concat(F.lit("missing include: "), F.array_join("_missing", ", "))
    expanded = (
        with_refs.join(per_doc, key)
        .withColumn("expanded", F.when(~cycle, F.concat(filled, tail)))
        .withColumn(
            "n_errors",
            F.when(cycle, 1).otherwise(F.coalesce(F.col("_gone") + F.col("_nested"), F.lit(0))).cast("bigint"),
        )
        .withColumn("error", F.when(cycle, "include cycle").when(F.col("n_errors") > 0, missing))
        .drop("_cut", "_parts", "_gone", "_nested", "_cycle", "_missing")
    )
    return expanded.unionByName(untouched)
