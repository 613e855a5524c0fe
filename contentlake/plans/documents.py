"""Document inventory, metadata audit and clean-up, archive, readability."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import metadata as M
from ..functions.common import computed, head_and_tail
from ..functions.markdown import markdown_rendered
from ..functions.markup import SHORTCODE_END, relref_to_relative
from ..functions.text import (
    drop_version_lines,
    outside_front_matter,
    reading_counts,
    reading_grade,
    remove_html_comments,
    spans_to_bold,
)
from ..functions.urls import content_path, in_includes, page_url, relative_path, repo_content_path
from ..operators.aggregates import metadata_flagged, metadata_wide
from ..operators.includes import expand_includes
from ..session import PAGE_BYTES, limit_batches
from .survey import with_first_prefix


def production_urls(docs: DataFrame, lookup: DataFrame, segments: bool = False) -> DataFrame:
    """Adds ``url``; documents of the includes area are dropped, unmapped ones get ``null``.

    Lookup keys lose their trailing slash, so a key also matches longer folder names that start
    with it. ``segments`` matches whole folder names instead.
    """
    prefix = F.regexp_replace("prefix", r"/+\z", "")
    rules = lookup.select("ord", (F.concat(prefix, F.lit("/")) if segments else prefix).alias("prefix"), "target")
    located = docs.withColumn("_below", content_path("path")).filter(~F.coalesce(in_includes("_below"), F.lit(False)))
    matched = with_first_prefix(located, "_below", rules)
    leftover = F.col("_below").substr(F.length("matched") + 1, F.length("_below"))
    url = F.coalesce(page_url(F.col("target"), leftover), F.lit("null"))
    return matched.withColumn("url", url).drop("_below", "matched", "target")


def doc_inventory(docs: DataFrame, lookup: DataFrame, root: str, segments: bool = False) -> DataFrame:
    """(filename, docsID, url) of every document outside the includes area."""
    limit_batches(docs.sparkSession, PAGE_BYTES)
    block = M.split_front_matter("content", "lines")["yaml"]
    blocks = production_urls(docs, lookup, segments).select("path", "url", computed(block).alias("_block"))
    parsed = blocks.select("path", "url", M.parse_front_matter("_block").alias("_fm"))
    return parsed.select(
        relative_path("path", root).alias("filename"), M.doc_id(F.col("_fm.data")).alias("docsID"), "url"
    )


def read_error(docs: DataFrame) -> Column:
    """Why a document could not be read; NULL for one that could, or when the table tells nothing."""
    return F.col("error") if "error" in docs.columns else F.lit(None).cast("string")


def classified(docs: DataFrame, content_dir: str) -> DataFrame:
    """(file, status, message, data) per document; data is an empty map unless status is ok.

    ``message`` is the text of an error other than a malformed block.
    """
    limit_batches(docs.sparkSession, PAGE_BYTES)
    blocks = docs.select("path", read_error(docs).alias("_unread"), computed(M.audited_block("content")).alias("_block"))
    parsed = blocks.select("path", "_unread", M.parse_front_matter("_block").alias("_fm"))
    none = F.create_map().cast("map<string,string>")
    unread = F.col("_unread").isNotNull()
    return parsed.select(
        repo_content_path("path", content_dir).alias("file"),
        M.audit_status(F.col("_fm.kind"), unread).alias("status"),
        F.coalesce("_unread", "_fm.error").alias("message"),
        F.when(unread, none).otherwise(F.coalesce("_fm.data", none)).alias("data"),
    )


def metadata_audit(docs: DataFrame, content_dir: str) -> DataFrame:
    """(file, key, value): every metadata value of every document, and one row for a flag.

    A flag's value is ``True``, or the error text when there is one. This form has no limit on the number of keys.
    """
    return metadata_flagged(classified(docs, content_dir))


def metadata_table(docs: DataFrame, content_dir: str, keys: list[str]) -> DataFrame:
    """One row per document, one column per key of ``keys``, and the two audit flags."""
    flags = [M.NO_METADATA, M.BAD_METADATA]
    audited = classified(docs, content_dir).withColumns(
        {flag: F.when(F.col("status") == flag, F.coalesce("message", F.lit("True"))) for flag in flags}
    )
    return metadata_wide(audited, "file", "data", M.text_value, flags, keys)


def rewritten(docs: DataFrame) -> DataFrame:
    """Documents with the new content, what was removed, and whether anything counts as a change.

    Documents without a block, or whose block is no mapping, pass unchanged. A description that
    only gained its period does not count as a change; ``description_fixed`` tells.
    """
    limit_batches(docs.sparkSession, PAGE_BYTES)
    parts = M.split_front_matter("content", "loose")
    staged = docs.withColumns({f"_{k}": v for k, v in parts.items()}).withColumn("_fm", M.parse_front_matter("_yaml"))
    data = F.col("_fm.data")
    staged = staged.withColumn("_merged", M.merge_types(data)).withColumn(
        "_types",
        F.coalesce("_merged", F.when(F.map_contains_key(data, "type"), M.list_value(data, "type"))),
    )
    kept, invalid = M.filter_types(F.col("_types"))
    had_merged = F.map_contains_key(data, M.MERGED_KEYS[0]) | F.map_contains_key(data, M.MERGED_KEYS[1])
    staged = staged.withColumns(
        {
            "_kept": kept,
            "invalid_types": F.coalesce(invalid, F.array().cast("array<string>")),
            "removed_keys": F.coalesce(M.drop_keys(data)[1], F.array().cast("array<string>")),
            "_description": M.description_with_period(data),
        }
    )
    changed = F.coalesce((F.col("_fm.kind") == "map") & ((F.size("removed_keys") > 0) | had_merged), F.lit(False))
    fixed = F.coalesce(F.col("_description") != M.text_value(data, "description"), F.lit(False))
    staged = staged.withColumn("changed", changed).withColumn("description_fixed", fixed)
    new_yaml = M.render_front_matter(F.when(F.col("changed"), F.col("_yaml")), F.col("_kept"), F.col("_description"))
    staged = staged.withColumn("_new", new_yaml)
    content = F.when(F.col("changed"), M.assemble_document(F.col("_before"), F.col("_new"), F.col("_body")))
    return staged.withColumn("new_content", F.coalesce(content, F.col("content"))).select(
        *docs.columns, "new_content", "changed", "description_fixed", "removed_keys", "invalid_types"
    )


def metadata_cleanup(docs: DataFrame) -> DataFrame:
    """Only the documents that change."""
    return rewritten(docs).filter("changed")


def archive(docs: DataFrame, fragments: DataFrame, root: str, compat: bool = False) -> DataFrame:
    """Self-contained text per document: (path, doc_set, archived, n_errors, error).

    ``root`` holds the doc sets; folder indexes are left out. The order of the steps matters:
    front matter, includes, version lines, comments, links. A document that could not be read has
    no text and one error.
    """
    below = relative_path("path", root)
    picked = docs.filter(~F.col("path").rlike(r"(?:\A|/)_index\.md\z") & F.col("path").endswith(".md"))
    # delimiters, shortcodes and comments end with one of two marks: no step finds anything after the line of the last one
    cut = picked.select(
        "path",
        F.regexp_extract(below, r"\A([^/]*)/", 1).alias("doc_set"),
        F.regexp_extract(below, r"\A[^/]*/(?:(.*)/)?[^/]*\z", 1).alias("folder"),
        computed(head_and_tail(F.col("content"), ["--", SHORTCODE_END])).alias("cut"),
        read_error(docs).alias("unread"),
    )
    plain = cut.select("path", "doc_set", "folder", "unread", computed(outside_front_matter(F.col("cut"))).alias("cut"))
    heads = plain.select("path", "doc_set", "folder", "unread", "cut.head", "cut.tail")
    expanded = expand_includes(heads, fragments, text="head", compat=compat)
    text = F.col("expanded") if compat else drop_version_lines("expanded")
    bare = expanded.select(
        "path", "doc_set", "folder", "unread", "n_errors", "error", "tail", computed(remove_html_comments(text)).alias("text")
    )
    linked = F.concat(relref_to_relative("text", "folder", "doc_set"), F.col("tail"))
    unread = F.col("unread").isNotNull()
    return bare.select(
        "path", "doc_set", F.when(~unread, linked).alias("archived"),
        F.when(unread, F.lit(1).cast("bigint")).otherwise(F.col("n_errors")).alias("n_errors"),
        F.when(unread, F.concat(F.lit("ERROR while reading "), F.col("path"), F.lit(": "), F.col("unread"))).otherwise(F.col("error")).alias("error"),
    )


def reading_levels(docs: DataFrame, key: str = "path", text: str = "content", plain: Callable[[str], Column] = markdown_rendered) -> DataFrame:
    """(key, reading_level, error) of every document; the text is scanned once per count.

    A document that could not be read keeps the reason as its error. ``plain`` makes readable text of Markdown;
    ``markdown_to_text`` is the rough one that needs no Python.
    """
    limit_batches(docs.sparkSession, PAGE_BYTES)
    counted = docs.select(key, read_error(docs).alias("_unread"), computed(plain(text)).alias("_plain")).select(
        key, "_unread", *[c.alias(name) for name, c in reading_counts("_plain").items()]
    )
    level, error = reading_grade(F.col("words"), F.col("sentences"), F.col("syllables"))
    level = F.when(F.col("_unread").isNull(), level)
    return counted.select(
        key, "words", "sentences", "syllables", level.alias("reading_level"), F.coalesce("_unread", error).alias("error")
    )


def span_rewrite(docs: DataFrame, key: str = "path", text: str = "content") -> DataFrame:
    """(key, new_content) of the documents whose styled spans were rewritten."""
    return (
        docs.filter(F.lower(text).contains("<span"))
        .select(key, text, computed(spans_to_bold(text)).alias("new_content"))
        .filter(F.col("new_content") != F.col(text))
        .select(key, "new_content")
    )
