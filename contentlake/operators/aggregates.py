"""Grouped and global reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.common import strip_ws
from ..session import materialize
from .filters import keep_rated, require_columns
from .skew import running_sums

# Separator of joined comments and the text of an unmapped product.
COMMENT_SEPARATOR = "|||"
UNKNOWN_PRODUCT = "Unknown"

#: A part of a page's joined comments ends at either of these.
MAX_COMMENTS = 100_000
MAX_BYTES = 32 << 20


def page_statistics(rated: DataFrame, keys: list[str], rating: str, comment: str) -> DataFrame:
    """Mergeable sums per page; partial aggregation absorbs hot pages before the shuffle."""
    return rated.groupBy(*keys).agg(
        F.sum(rating).alias("sum_q1"),
        F.count(rating).alias("n"),
        F.count(comment).alias("n_comments"),
    )


def join_comments(
    rated: DataFrame, keys: list[str], comment: str, order: list[str], max_comments: int = MAX_COMMENTS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Comments per page in row order, as ``(keys, part, q2_comments)``, parts 1, 2, ... of every page.

    The comments of a page are numbered along ``order``, and a part ends after ``max_comments``
    comments or about ``max_bytes`` of text. Numbers and bytes are running sums over blocks, so
    a hot page is spread over many tasks and no task assembles an unbounded text. ``rated`` is read twice; the
    numbered comments are stored, as the texts and the list of cuts both need them.
    """
    said = rated.filter(F.col(comment).isNotNull()).select(*keys, *order, F.col(comment).alias("_comment"))
    numbered = running_sums(said, keys, order, {"_no": F.lit(1), "_bytes": F.octet_length("_comment")})
    before = F.col("_bytes") - F.octet_length("_comment")
    cut = F.expr(f"(_no - 1) div {max_comments}") + F.floor(before / max_bytes)
    numbered = materialize(numbered.select(*keys, *order, "_comment", cut.alias("_cut")), "numbered-comments")
    joined = (
        numbered.groupBy(*keys, "_cut")
        .agg(F.sort_array(F.collect_list(F.struct(*order, F.col("_comment").alias("c")))).alias("_list"))
        .select(*keys, "_cut", F.array_join(F.col("_list.c"), COMMENT_SEPARATOR).alias("q2_comments"))
    )
    # cuts may skip a number; the list of cuts is small, the texts stay where they are
    cuts = numbered.select(*keys, "_cut").distinct()
    dense = cuts.withColumn("part", F.row_number().over(Window.partitionBy(*keys).orderBy("_cut")).cast("bigint"))
    dense = dense.select(*[F.col(k).alias(f"_d_{k}") for k in keys], F.col("_cut").alias("_d_cut"), "part")
    same = F.col("_cut") == F.col("_d_cut")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_d_{k}"))
    return joined.join(dense, same).select(*keys, "part", "q2_comments")


def rated_pages(df: DataFrame, *, url: str, rating: str, comment: str, date: str, order: str | list[str], product: Column) -> DataFrame:
    """canonical_url, product, q1, q2 and the order columns of the answers that have a date and a rating."""
    require_columns(df, [url, rating, comment, date])
    order = [order] if isinstance(order, str) else order
    return keep_rated(df, date, rating).select(
        strip_ws(url).alias("canonical_url"),
        F.coalesce(product, F.lit(UNKNOWN_PRODUCT)).alias("product"),
        F.col(rating).try_cast("double").alias("q1"),  # files hold text
        F.col(comment).alias("q2"),
        *order,
    ).filter("q1 is not null")


def feedback_by_page(
    df: DataFrame,
    *,
    url: str,
    rating: str,
    comment: str,
    date: str,
    order: str | list[str],
    product: Column,
    max_comments: int = MAX_COMMENTS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Average rating, number of ratings and joined comments per page and product.

    A page has a row per part of its comments, see :func:`join_comments`; average and number stand in
    part 1 only, so sums over rows count once. Pages without a URL form a group of their own.
    """
    rated = rated_pages(df, url=url, rating=rating, comment=comment, date=date, order=order, product=product)
    rated = materialize(rated, "rated-answers")  # statistics, block totals and comments read it
    keys = ["canonical_url", "product"]
    order = [order] if isinstance(order, str) else order
    comments = join_comments(rated, keys, "q2", order, max_comments, max_bytes)
    return finish_feedback(page_statistics(rated, keys, "q1", "q2"), comments, keys)


def finish_feedback(statistics: DataFrame, comments: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides are unique per page (and part), so this join cannot be skewed by hot pages."""
    same = F.lit(True)
    for k in keys:
        same = same & statistics[k].eqNullSafe(comments[k])
    first = F.coalesce(F.col("part"), F.lit(1)) == 1
    return statistics.join(comments, same, "left").select(
        *[statistics[k] for k in keys],
        F.coalesce("part", F.lit(1).cast("bigint")).alias("part"),
        F.when(first, F.bround(F.col("sum_q1") / F.col("n"), 2)).alias("avg_q1"),
        F.when(first, F.col("n")).alias("n"),
        F.coalesce("q2_comments", F.lit("")).alias("q2_comments"),
    )


def page_totals(feedback: DataFrame, keys: list[str]) -> DataFrame:
    """One row per page of a feedback table: average, number, and characters of its joined comments, however they are cut into parts."""
    between = len(COMMENT_SEPARATOR) * (F.count("*") - 1)  # separators that the cuts took out
    return feedback.groupBy(*keys).agg(
        F.max("avg_q1").alias("avg_q1"), F.sum("n").alias("n"), (F.sum(F.length("q2_comments")) + between).alias("comment_chars")
    )


def status_summary(df: DataFrame, status: str) -> DataFrame:
    """Totals of an audit: valid is what has neither flag."""
    from ..functions.metadata import BAD_METADATA, NO_METADATA

    none, error = F.count_if(F.col(status) == NO_METADATA), F.count_if(F.col(status) == BAD_METADATA)
    return df.agg(
        F.count("*").alias("total"),
        (F.count("*") - none - error).alias("valid"),
        none.alias("no_metadata"),
        error.alias("errors"),
    )


def run_stats(df: DataFrame, errors: str) -> DataFrame:
    """Processed documents, documents without errors, and errors in total."""
    return df.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col(errors) == 0).alias("success"),
        F.coalesce(F.sum(errors), F.lit(0)).cast("bigint").alias("errors"),
    )


def column_widths(df: DataFrame, by: str, columns: list[str], padding: int = 2) -> DataFrame:
    """Longest header or value per column and section, plus padding."""
    widest = [
        (F.greatest(F.max(F.length(F.coalesce(F.col(c).cast("string"), F.lit("")))), F.lit(len(c))) + padding)
        .cast("bigint")
        .alias(f"w_{c}")
        for c in columns
    ]
    return df.groupBy(by).agg(*widest)


def stage_counts(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each successive filter, all in one pass; long form (stage_no, stage, rows)."""
    kept = F.lit(True)
    counts = [F.count("*").alias("input")]
    for name, keep in stages:
        kept = kept & F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(kept).alias(name))
    names = ["input"] + [name for name, _ in stages]
    entries = F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(n).alias("stage"), F.col(n).alias("rows")) for i, n in enumerate(names)])
    return df.agg(*counts).select(F.inline(entries))


def metadata_keys(df: DataFrame, data: str) -> DataFrame:
    """Distinct keys over all documents with the number of documents that use each."""
    return df.select(F.explode(F.map_keys(data)).alias("key")).groupBy("key").agg(F.count("*").alias("n_docs"))


def metadata_long(df: DataFrame, key: str, data: str) -> DataFrame:
    """One row per document and metadata key: the form that scales to any number of keys."""
    return df.select(key, F.explode(data).alias("key", "value"))


def metadata_flagged(audited: DataFrame) -> DataFrame:
    """(file, key, value) of audited documents (file, status, message, data), flags included."""
    flag = F.when(F.col("status") != "ok", F.create_map(F.col("status"), F.coalesce("message", F.lit("True"))))
    from ..functions.metadata import json_text

    texts = F.transform_values("data", lambda _, v: json_text(v))
    return audited.select("file", F.explode(F.map_concat(texts, F.coalesce(flag, F.create_map().cast("map<string,string>")))).alias("key", "value"))


def metadata_wide(df: DataFrame, key: str, data: str, value: object, flags: list[str], keys: list[str]) -> DataFrame:
    """One column per key of ``keys``: fixed columns first, the rest in alphabetical order.

    The caller names the keys (:func:`metadata_keys` counts them); none is looked up here. Column names that
    differ from an earlier one in case only get a trailing ``_``, since Spark cannot store both.
    """
    fixed = ["title", "Title"]
    rest = sorted(set(keys) - set(fixed) - set(flags) | set(flags))
    columns, taken = [], {key.lower()}
    for k in [*fixed, *rest]:
        if k != key:
            name = k
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            columns.append((F.col(f"`{k}`") if k in flags else value(F.col(data), k)).alias(name))
    return df.select(key, *columns).orderBy(key)


def first_rows_dropped(df: DataFrame, order: str, header: list[str], label: str) -> DataFrame:
    """Drop the first data row if it repeats the header, or else holds the label text."""
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in header])
    repeats = F.lit(True)
    for c in header:
        repeats = repeats & F.coalesce(F.col(f"`{c}`").cast("string") == F.lit(c), F.lit(False))
    labelled = F.coalesce(F.array_contains(F.filter(cells, lambda c: c.isNotNull()), label), F.lit(False))
    return df.filter(~((F.col(order) == 0) & (repeats | labelled)))


def metadata_row_dropped(df: DataFrame, order: str, columns: list[str], marker: str) -> DataFrame:
    """Drop the second data row if any cell contains the marker."""
    cells = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    return df.filter(~((F.col(order) == 1) & F.exists(cells, lambda c: c.contains(marker))))


def audit_changes(df: DataFrame, key: str, stage: str, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """(stage, row_key, rule, before, after) for every changed value; both values sit in the same row."""
    from .filters import changed

    entries = F.array(
        *[F.struct(F.lit(rule).alias("rule"), before.alias("before"), after.alias("after")) for rule, before, after in rules]
    )
    exploded = df.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("row_key"), F.inline(entries))
    return exploded.filter(changed("before", "after"))


def audit_removals(df: DataFrame, key: str, stage: str, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """(stage, row_key, rule, before, after) for every row a rule removes; the first rule that applies counts.

    A rule is (name, condition, the value it judged).
    """
    hit = None
    for name, removes, value in rules:
        entry = F.struct(F.lit(name).alias("rule"), value.cast("string").alias("before"))
        hit = F.when(removes, entry) if hit is None else hit.when(removes, entry)
    judged = df.select(F.col(key).cast("string").alias("row_key"), hit.alias("_hit")).filter(F.col("_hit").isNotNull())
    none = F.lit(None).cast("string").alias("after")
    return judged.select(F.lit(stage).alias("stage"), "row_key", "_hit.rule", "_hit.before", none)


def latest_per_key(df: DataFrame, key: str, ts: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(ts).alias(out))
