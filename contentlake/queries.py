"""Named queries over a folder of tables; every one reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .fixtures import ORIGIN, table, view
from .functions import markup, metadata as M, text as T, urls as U
from .functions.common import strip_ws
from .functions.markdown import markdown_rendered
from .operators import aggregates as A, enrich, filters, graph, includes, prefix, timejoin
from .operators.redirect_rules import parse_redirects, redirect_table
from .plans import documents as D, sites, survey as S
from .session import scratch_path
from .sources import doctree, tables as src
from .streaming.corrections import read_corrected, run_corrected_stream
from .streaming.feedback import read_feedback, run_feedback_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SITE = "https://www.example.org"
ROOT = "/repo/content"
REPLACED = ("https://docs.example.com/h0/", "https://docs.example.com/home/")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(array) -> F.Column:
    return F.array_join(array, ",")


# --- survey ---------------------------------------------------------------------------------


@query
def feedback_by_page(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey")
    cleaned = rows.withColumn("link_url", U.normalize_url("link_url"))
    return S.feedback_dataset(cleaned, view(spark, sf_dir, "v_product"))


@query
def feedback_parts(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey").withColumn("link_url", U.normalize_url("link_url"))
    return S.feedback_dataset(rows, view(spark, sf_dir, "v_product"), max_comments=500)


@query
def normalize_url(spark, sf_dir):
    return view(spark, sf_dir, "v_survey").select("row_id", U.normalize_url("link_url").alias("url"))


@query
def resolve_url(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey")
    absolute = U.absolute_url("current_url", ORIGIN)
    return rows.select("row_id", absolute.alias("url"), U.resolve_url("link_url", "current_url").alias("resolved"))


@query
def strip_vars(spark, sf_dir):
    return view(spark, sf_dir, "v_survey").select("row_id", U.strip_vars("link_url", ORIGIN).alias("url"))


@query
def replace_literal(spark, sf_dir):
    url = U.replace_literal("link_url", "/en/", "/english/")
    return view(spark, sf_dir, "v_survey").select(
        "row_id", url.alias("url"), F.coalesce(filters.changed("link_url", url), F.lit(False)).alias("was_changed")
    )


@query
def drop_missing_link(spark, sf_dir):
    return filters.drop_missing(view(spark, sf_dir, "v_survey"), "link_url").select("row_id", "link_url")


@query
def drop_keyword(spark, sf_dir):
    return filters.drop_keyword(view(spark, sf_dir, "v_survey"), "q2", S.TRIAL_WORD).select("row_id", "q2")


@query
def keep_rated(spark, sf_dir):
    kept = filters.keep_rated(view(spark, sf_dir, "v_survey"), "start_date", "q1")
    return kept.select("row_id", F.date_format(T.coerce_date("start_date"), "yyyy-MM-dd").alias("day"), "q1")


@query
def survey_header_cleanup(spark, sf_dir):
    raw = view(spark, sf_dir, "v_survey_raw")
    return A.first_rows_dropped(raw, "ord", ["response_id", "q2"], src.COMMENT_LABEL)


@query
def survey_metadata_row(spark, sf_dir):
    return A.metadata_row_dropped(view(spark, sf_dir, "v_survey_raw"), "ord", ["response_id", "q2"], src.METADATA_MARKER)


@query
def survey_export_cleanup(spark, sf_dir):
    raw = view(spark, sf_dir, "v_survey_raw")
    kept = S.survey_export_cleanup(raw, "ord", ["response_id", "q2"], src.METADATA_MARKER)
    path = scratch_path(spark, "report")
    src.write_report(kept, path, ["ord", "response_id", "q2"], ["ord"])
    return src.read_report(spark, path, "ord bigint, response_id string, q2 string")


@query
def exclude_ids(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey").select("row_id", "response_id")
    return filters.exclude_ids(rows, view(spark, sf_dir, "v_exclude"), "response_id")


@query
def excluded_report(spark, sf_dir):
    return filters.excluded_report(view(spark, sf_dir, "v_survey"), view(spark, sf_dir, "v_exclude"), "response_id")


@query
def scrub_emails(spark, sf_dir):
    cleaned, hits = T.scrub_emails("text")
    return table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("text"), hits.cast("bigint").alias("n_removed"))


@query
def stage_counts(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey").select("link_url", "q2", strip_ws("response_id").alias("id"))
    listed = filters.clean_ids(view(spark, sf_dir, "v_exclude")).withColumn("listed", F.lit(True))
    from .operators.skew import lookup_join

    marked = lookup_join(rows, listed, "id")
    counts = A.stage_counts(
        marked,
        [
            ("with_link", F.col("link_url").isNotNull()),
            ("no_trials", ~filters.mentions("q2", S.TRIAL_WORD)),
            ("not_excluded", F.col("listed").isNull()),
        ],
    )
    return counts.select(F.col("stage_no").cast("bigint").alias("stage_no"), "stage", "rows")


@query
def audit_changes(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey")
    return A.audit_changes(
        rows,
        "row_id",
        "clean",
        [
            ("normalize", F.col("link_url"), U.normalize_url("link_url")),
            ("scrub", F.col("q2"), T.scrub_emails("q2")[0]),
        ],
    )


@query
def audit_removals(spark, sf_dir):
    rules = [
        ("missing link", F.col("link_url").isNull(), F.col("link_url")),
        ("trial answer", filters.mentions("q2", S.TRIAL_WORD), F.col("q2")),
        ("no date", T.coerce_date("start_date").isNull(), F.col("start_date")),
    ]
    return A.audit_removals(view(spark, sf_dir, "v_survey"), "row_id", "clean", rules)


@query
def clean_survey(spark, sf_dir):
    cleaned = S.clean_survey(
        view(spark, sf_dir, "v_survey"),
        origin=ORIGIN,
        rules=view(spark, sf_dir, "v_redirect"),
        exclude=view(spark, sf_dir, "v_exclude"),
        replacements=[REPLACED],
        cache=view(spark, sf_dir, "v_geo_cache"),
    )
    return cleaned.select(
        "row_id", "response_id", "original_link_url", "link_url", "canonical_url", "current_url", "q2", "country"
    )


@query
def clean_survey_places(spark, sf_dir):
    """Countries of all answers: from the cache, else from the nearest place."""
    cleaned = S.clean_survey(
        view(spark, sf_dir, "v_survey"), origin=ORIGIN, cache=view(spark, sf_dir, "v_geo_cache"), places=view(spark, sf_dir, "v_place")
    )
    return cleaned.select("row_id", "country")


@query
def survey_file_pipeline(spark, sf_dir):
    """A survey file under its own headers, redirects from configuration lines, exclusion, cleaning, feedback per page."""
    path = scratch_path(spark, "survey-file")
    headers = {"response_id": "ResponseId", "link_url": "Link URL", "current_url": "Current URL", "q1": "Q1", "q2": "Q2", "start_date": "StartDate", "lat": "LocationLatitude", "lon": "LocationLongitude"}
    rows = view(spark, sf_dir, "v_survey").select(*[F.col(c).alias(h) for c, h in headers.items()])
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rules = redirect_table(parse_redirects(view(spark, sf_dir, "v_config_lines"), ORIGIN, block_rows=1000))
    cleaned = S.clean_survey(src.read_survey(spark, path), origin=ORIGIN, rules=rules, exclude=view(spark, sf_dir, "v_exclude"))
    feedback = S.feedback_dataset(cleaned, view(spark, sf_dir, "v_product"), url="canonical_url", order=["file", "row_order"])
    # the order of comments follows the files; their total length does not
    return A.page_totals(feedback, ["canonical_url", "product"])


@query
def survey_line_breaks(spark, sf_dir):
    """Answers with line breaks, quotes and separators in their comments, through a CSV file and back."""
    path = scratch_path(spark, "survey-lines")
    odd = F.expr("CASE row_id % 4 WHEN 0 THEN concat(q2, chr(10), 'and \"so\", on', chr(10)) WHEN 1 THEN concat('\"', q2, chr(13), chr(10), ',') WHEN 2 THEN concat(chr(10), q2, '\"') ELSE q2 END")
    rows = view(spark, sf_dir, "v_survey").select(F.col("row_id").alias("ResponseId"), odd.alias("Q2"), F.col("q1").alias("Q1"))
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return src.read_survey(spark, path).select(F.col("ResponseId").cast("bigint").alias("row_id"), F.col("Q2").alias("q2"), F.col("Q1").cast("double").alias("q1"))


@query
def bad_coordinates(spark, sf_dir):
    odd = F.expr("CASE row_id % 4 WHEN 0 THEN 'Infinity' WHEN 1 THEN '1e300' WHEN 2 THEN '90.5' ELSE CAST(lat AS STRING) END")
    rows = view(spark, sf_dir, "v_survey").select("row_id", odd.alias("lat"), "lon")
    return enrich.attach_country(rows, view(spark, sf_dir, "v_geo_cache"), "lat", "lon").select("row_id", "country")


# --- redirects and prefixes -----------------------------------------------------------------


@query
def redirect_dedup(spark, sf_dir):
    return prefix.longest_first(prefix.dedup_rules(view(spark, sf_dir, "v_redirect")))


@query
def top_redirects(spark, sf_dir):
    return prefix.top_rules(prefix.dedup_rules(view(spark, sf_dir, "v_redirect")))


@query
def canonical_links(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey").select("row_id", "link_url")
    return prefix.canonical_links(rows, "link_url", prefix.dedup_rules(view(spark, sf_dir, "v_redirect")), ORIGIN, "canonical_url")


@query
def redirect_longest_prefix(spark, sf_dir):
    rows = S.clean_link_urls(view(spark, sf_dir, "v_survey"), ["link_url"], ORIGIN)
    rules = prefix.dedup_rules(view(spark, sf_dir, "v_redirect"))
    return prefix.apply_redirects(rows.select("row_id", "link_url"), "link_url", rules, ORIGIN, "canonical_url")


@query
def redirect_rules(spark, sf_dir):
    lines = view(spark, sf_dir, "v_config_lines")
    # small blocks, so that the hot file really is cut into several
    return parse_redirects(lines, ORIGIN, block_rows=1000)


@query
def redirect_rules_table(spark, sf_dir):
    rules = redirect_table(parse_redirects(view(spark, sf_dir, "v_config_lines"), ORIGIN, block_rows=1000))
    return rules.select(F.col("ord.file_id").alias("file_id"), F.col("ord.line_no").alias("line_no"), "prefix", "target")


@query
def product_map(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey").select("row_id", U.normalize_url("link_url").alias("url"))
    return S.map_product(rows, "url", view(spark, sf_dir, "v_product"))


@query
def product_map_join(spark, sf_dir):
    """The same mapping by the equi join that serves long prefix lists."""
    rows = view(spark, sf_dir, "v_survey").select("row_id", U.normalize_url("link_url").alias("url"))
    hit = prefix.match_prefix(rows, "url", view(spark, sf_dir, "v_product"), pick="first")
    return hit.select("row_id", "url", F.coalesce("target", F.lit(A.UNKNOWN_PRODUCT)).alias("product"))


# --- document scalars -----------------------------------------------------------------------


@query
def production_url(spark, sf_dir):
    return D.production_urls(view(spark, sf_dir, "v_md"), view(spark, sf_dir, "v_lookup")).select("doc_id", "url")


@query
def production_url_segments(spark, sf_dir):
    located = D.production_urls(view(spark, sf_dir, "v_md"), view(spark, sf_dir, "v_lookup"), segments=True)
    return located.select("doc_id", "url")


@query
def repo_path(spark, sf_dir):
    docs = view(spark, sf_dir, "v_md")
    return docs.select(
        "doc_id", U.repo_content_path("path", "/home/me" + ROOT).alias("shifted"),
        U.repo_content_path("path", ROOT).alias("file"), U.relative_path("path", ROOT).alias("rel_path"),
    )


@query
def relref_links(spark, sf_dir):
    folder = F.regexp_extract("path", r"\A/repo/content/[^/]*/(.*)/[^/]*\z", 1)
    doc_set = F.regexp_extract("path", r"\A/repo/content/([^/]*)/", 1)
    docs = view(spark, sf_dir, "v_md")
    return docs.select("doc_id", markup.relref_to_relative("content", folder, doc_set).alias("content"))


@query
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_text("text").alias("text"))


@query
def clean_page_text(spark, sf_dir):
    """Whole pages; ``&copy;`` and ``&middot;`` take the route through the Python worker."""
    return table(spark, sf_dir, "pages").select("page_id", T.clean_text("html").alias("html"))


@query
def strip_front_matter(spark, sf_dir):
    return view(spark, sf_dir, "v_md").select("doc_id", T.strip_front_matter("content").alias("content"))


@query
def strip_comments(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.remove_html_comments("html").alias("html"))


@query
def drop_shortcode_lines(spark, sf_dir):
    return view(spark, sf_dir, "v_md").select("doc_id", T.drop_version_lines("content").alias("content"))


@query
def spans_to_bold(spark, sf_dir):
    return view(spark, sf_dir, "v_md").select("doc_id", T.spans_to_bold("content").alias("content"))


@query
def span_rewrite(spark, sf_dir):
    return D.span_rewrite(view(spark, sf_dir, "v_md"))


@query
def markdown_to_text(spark, sf_dir):
    return view(spark, sf_dir, "v_md").select("doc_id", T.markdown_to_text("content").alias("plain"))


@query
def reading_level(spark, sf_dir):
    return D.reading_levels(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        "doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("words", "sentences", "syllables")], "reading_level", "error"
    )


@query
def reading_levels(spark, sf_dir):
    docs = view(spark, sf_dir, "v_md").filter(~F.col("path").rlike(r"(?i)(?:\A|/)_index\.md\z"))
    return D.reading_levels(docs).select("path", "reading_level", "error")


@query
def known_texts(spark, sf_dir):
    """Texts with known answers: readable Markdown, bold spans, index pages, web pages."""
    return view(spark, sf_dir, "v_known").select(
        "doc_id", T.markdown_to_text("markdown").alias("plain"), T.spans_to_bold("spans").alias("bold"),
        filters.not_index("path").alias("is_page"), U.is_webpage("link").alias("is_web"),
    )


@query
def rendered_markdown(spark, sf_dir):
    """Text of Markdown with titles, lists, references, escapes, code, tables and tags; answers by construction."""
    return view(spark, sf_dir, "v_marked").select("doc_id", markdown_rendered("content").alias("shown"))


@query
def rendered_reading_levels(spark, sf_dir):
    return D.reading_levels(view(spark, sf_dir, "v_marked"), "doc_id").select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("words", "sentences")])


@query
def known_reading_levels(spark, sf_dir):
    return D.reading_levels(view(spark, sf_dir, "v_known"), "doc_id", "simple").select(
        "doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("words", "sentences", "syllables")], "reading_level"
    )


@query
def drop_timezone(spark, sf_dir):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("user_id") % 2 == 0, "+05:00").otherwise("Z"))
    stamp = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(stamp)
    wall = T.drop_timezone(stamp)
    return table(spark, sf_dir, "events").select("event_id", F.date_format(wall, "yyyy-MM-dd HH:mm:ss").alias("wall_clock"))


@query
def ensure_period(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.ensure_period("text").alias("text"))


# --- front matter ---------------------------------------------------------------------------


@query
def split_front_matter(spark, sf_dir):
    modes = {m: M.split_front_matter("content", m) for m in ("lines", "strict", "loose")}
    return view(spark, sf_dir, "v_md").select(
        "doc_id", *[parts["yaml"].alias(f"yaml_{m}") for m, parts in modes.items()], modes["loose"]["body"].alias("body")
    )


def _parsed(spark, sf_dir, mode="strict"):
    docs = view(spark, sf_dir, "v_md")
    return docs.withColumn("fm", M.parse_front_matter(M.split_front_matter("content", mode)["yaml"]))


@query
def front_matter_map(spark, sf_dir):
    return _parsed(spark, sf_dir).select("doc_id", F.explode("fm.data").alias("key", "value"))


@query
def front_matter_flat(spark, sf_dir):
    """The native map, for blocks of plain ``key: text`` lines."""
    flat = M.flat_front_matter(M.split_front_matter("content", "strict")["yaml"])
    return view(spark, sf_dir, "v_md").select("doc_id", F.explode(flat).alias("key", "value"))


@query
def merge_types(spark, sf_dir):
    return _parsed(spark, sf_dir).select("doc_id", _joined(M.merge_types(F.col("fm.data"))).alias("types"))


@query
def filter_types(spark, sf_dir):
    kept, removed = M.filter_types(M.merge_types(F.col("fm.data")))
    return _parsed(spark, sf_dir).select("doc_id", _joined(kept).alias("kept"), _joined(removed).alias("removed"))


@query
def drop_keys(spark, sf_dir):
    kept, removed = M.drop_keys(F.col("fm.data"))
    return _parsed(spark, sf_dir).select(
        "doc_id", _joined(F.array_sort(F.map_keys(kept))).alias("kept"), _joined(removed).alias("removed")
    )


@query
def rewrite_front_matter(spark, sf_dir):
    return D.rewritten(view(spark, sf_dir, "v_md")).select(
        "doc_id", "new_content", "changed", "description_fixed",
        _joined("removed_keys").alias("removed_keys"), _joined("invalid_types").alias("invalid_types"),
    )


@query
def metadata_cleanup(spark, sf_dir):
    return D.metadata_cleanup(view(spark, sf_dir, "v_md")).select("path", _joined("removed_keys").alias("removed_keys"))


@query
def doc_inventory(spark, sf_dir):
    return D.doc_inventory(view(spark, sf_dir, "v_md"), view(spark, sf_dir, "v_lookup"), ROOT)


@query
def metadata_audit(spark, sf_dir):
    """The table for keys that are known beforehand."""
    keys = ["title", "categories", "date", "description", "docs", "doctypes", "tags", "weight"]
    return D.metadata_table(view(spark, sf_dir, "v_md"), ROOT, keys)


@query
def metadata_audit_long(spark, sf_dir):
    return D.metadata_audit(view(spark, sf_dir, "v_md"), ROOT)


@query
def metadata_summary(spark, sf_dir):
    return A.status_summary(D.classified(view(spark, sf_dir, "v_md"), ROOT), "status")


@query
def metadata_keys(spark, sf_dir):
    return A.metadata_keys(D.classified(view(spark, sf_dir, "v_md"), ROOT), "data")


@query
def metadata_long(spark, sf_dir):
    return A.metadata_long(D.classified(view(spark, sf_dir, "v_md"), ROOT), "file", "data")


@query
def bad_docs_audit(spark, sf_dir):
    return D.metadata_audit(view(spark, sf_dir, "v_bad"), ROOT)


@query
def bad_docs_archive(spark, sf_dir):
    archived = D.archive(view(spark, sf_dir, "v_bad"), view(spark, sf_dir, "v_include"), ROOT)
    return archived.select("path", F.col("archived").isNull().alias("failed"), "n_errors", "error")


@query
def bad_docs_stats(spark, sf_dir):
    return A.run_stats(bad_docs_archive(spark, sf_dir), "n_errors")


@query
def bad_docs_reading(spark, sf_dir):
    return D.reading_levels(view(spark, sf_dir, "v_bad")).select("path", "error")


# --- includes -------------------------------------------------------------------------------


@query
def include_refs(spark, sf_dir):
    docs = view(spark, sf_dir, "v_md")
    lines = docs.select("doc_id", F.posexplode(F.split("content", "\n")).alias("line_no", "line"))
    refs = lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.explode(markup.include_refs("line")).alias("ref"))
    return refs


def _all_text(spark, sf_dir):
    """The include audit searches documents and fragments alike."""
    docs = view(spark, sf_dir, "v_md").select("path", "content")
    return docs.unionByName(view(spark, sf_dir, "v_include").select(F.col("include_path").alias("path"), "content"))


@query
def include_usage(spark, sf_dir):
    return includes.include_usage(_all_text(spark, sf_dir), view(spark, sf_dir, "v_include"))


@query
def include_unused(spark, sf_dir):
    return includes.unused_fragments(include_usage(spark, sf_dir))


@query
def include_used_once(spark, sf_dir):
    return includes.used_once(include_usage(spark, sf_dir))


@query
def include_totals(spark, sf_dir):
    return includes.usage_totals(include_usage(spark, sf_dir))


@query
def expand_includes(spark, sf_dir):
    docs = view(spark, sf_dir, "v_md").select("path", "content")
    expanded = includes.expand_includes(docs, view(spark, sf_dir, "v_include"))
    return expanded.select("path", "expanded", "n_errors", "error")


def _archive(spark, sf_dir):
    return D.archive(view(spark, sf_dir, "v_md").select("path", "content"), view(spark, sf_dir, "v_include"), ROOT)


@query
def archive_docs(spark, sf_dir):
    return _archive(spark, sf_dir)


@query
def archive_stats(spark, sf_dir):
    return A.run_stats(_archive(spark, sf_dir), "n_errors")


# --- pages and sites ------------------------------------------------------------------------


@query
def extract_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(markup.extract_hrefs("html")).alias("pos", "href")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "href"
    )


@query
def page_links(spark, sf_dir):
    return graph.page_links(table(spark, sf_dir, "pages"))


@query
def webpage_filter(spark, sf_dir):
    links = graph.page_links(view(spark, sf_dir, "v_site"))
    return links.groupBy(U.is_webpage("dst").alias("is_page")).agg(F.count("*").alias("n_links"))


@query
def strict_subpath(spark, sf_dir):
    below = graph.links_below(graph.page_links(view(spark, sf_dir, "v_site")), view(spark, sf_dir, "v_base"))
    return below.filter(U.is_strict_subpath("base", "dst")).select("doc_set", "src", "dst")


@query
def odd_links(spark, sf_dir):
    """Links of pages with quoted brackets, bare values, comments, scripts and broken tags; answers by construction."""
    return view(spark, sf_dir, "v_odd_page").select("page_id", F.posexplode(markup.extract_hrefs("html")).alias("pos", "href"))


@query
def crawl_candidates(spark, sf_dir):
    return graph.crawl_candidates(graph.page_links(view(spark, sf_dir, "v_site")), view(spark, sf_dir, "v_base"))


@query
def crawl_reachable(spark, sf_dir):
    return sites.site_inventory(view(spark, sf_dir, "v_site"), view(spark, sf_dir, "v_base")).select("doc_set", "url").orderBy("url")


@query
def pages_per_set(spark, sf_dir):
    return graph.pages_per_set(sites.site_inventory(view(spark, sf_dir, "v_site"), view(spark, sf_dir, "v_base")))


@query
def site_inventory(spark, sf_dir):
    """The inventory written in one folder per doc set, and read back."""
    found = sites.site_inventory(view(spark, sf_dir, "v_site"), view(spark, sf_dir, "v_base"))
    path = scratch_path(spark, "sites")
    src.write_partitioned(found, path, "doc_set")
    return spark.read.schema("doc_set string, url string, section string").parquet(path)


# --- XML ------------------------------------------------------------------------------------


@query
def xml_title(spark, sf_dir):
    return view(spark, sf_dir, "v_xml").select("doc_id", markup.xml_title("xml").alias("title"))


@query
def xml_inventory(spark, sf_dir):
    docs = view(spark, sf_dir, "v_xml").select("path", "xml")
    return sites.xml_inventory(docs, view(spark, sf_dir, "v_commits"), SITE)


@query
def column_widths(spark, sf_dir):
    return A.column_widths(xml_inventory(spark, sf_dir), "lang", ["file", "title", "link", "last_commit"])


@query
def last_commit(spark, sf_dir):
    files = view(spark, sf_dir, "v_xml").select("path")
    return enrich.last_commit(files, view(spark, sf_dir, "v_commits"), "path", "commit_ts")


# --- enrichment -----------------------------------------------------------------------------


@query
def commit_before_read(spark, sf_dir):
    """For every reading of a document the newest commit at or before its day."""
    read = view(spark, sf_dir, "v_reading")
    return timejoin.asof_join(read, view(spark, sf_dir, "v_commits"), ["path"], "day", "commit_ts", ["commit_ts"]).select("event_id", F.date_format("commit_ts", "yyyy-MM-dd").alias("committed"))


@query
def dated_redirects(spark, sf_dir):
    """Redirects that are valid from one day to another, applied to the answers of the days between."""
    answers = view(spark, sf_dir, "v_dated_answer")
    found = timejoin.interval_join(answers, view(spark, sf_dir, "v_dated_rule"), ["prefix"], "day_no", "from_day", "to_day")
    return found.select("event_id", "target")


@query
def redirect_chains(spark, sf_dir):
    """Final targets of redirect chains of up to 400 rules; every third chain runs in a circle."""
    return prefix.chain_targets(view(spark, sf_dir, "v_chain")).select("prefix", "target", F.coalesce("hops", F.lit(0).cast("bigint")).alias("hops"), "cyclic")


@query
def geo_cache_join(spark, sf_dir):
    rows = view(spark, sf_dir, "v_survey").select("row_id", "lat", "lon")
    return enrich.attach_country(rows, view(spark, sf_dir, "v_geo_cache"), "lat", "lon").select("row_id", "country")


@query
def geo_missing_keys(spark, sf_dir):
    return enrich.missing_keys(view(spark, sf_dir, "v_survey"), view(spark, sf_dir, "v_geo_cache"), "lat", "lon")


@query
def nearest_place(spark, sf_dir):
    keys = enrich.with_coordinate_keys(view(spark, sf_dir, "v_survey"), "lat", "lon").select("lat_key", "lon_key")
    located = enrich.nearest_place(keys.dropna().distinct(), view(spark, sf_dir, "v_place"))
    return enrich.country_names(located, view(spark, sf_dir, "v_country")).select("lat_key", "lon_key", "country")


@query
def cache_upsert(spark, sf_dir):
    rows, cache = view(spark, sf_dir, "v_survey"), view(spark, sf_dir, "v_geo_cache")
    found = enrich.nearest_place(enrich.missing_keys(rows, cache, "lat", "lon"), view(spark, sf_dir, "v_place"))
    path = scratch_path(spark, "geo-cache")
    enrich.upsert_cache(cache, found, ["lat_key", "lon_key"]).write.parquet(path)
    return spark.read.parquet(path)


@query
def cache_append(spark, sf_dir):
    """The cache as a folder that two batches of new places are added to, the second one twice."""
    path = scratch_path(spark, "geo-cache")
    keys = ["lat_key", "lon_key"]
    cache = view(spark, sf_dir, "v_geo_cache")
    rows = enrich.with_coordinate_keys(view(spark, sf_dir, "v_survey"), "lat", "lon").filter("lat_key is not null")
    fresh = rows.groupBy(*keys).agg(F.concat(F.lit("N"), F.min(F.col("row_id") % 7).cast("string")).alias("country"))
    enrich.append_cache(cache, path, keys, 0)
    enrich.append_cache(fresh.filter("lat_key % 2 = 0"), path, keys, 1)
    for _ in range(2):
        enrich.append_cache(fresh, path, keys, 2)
    return enrich.read_cache(spark, path).select(*keys, "country")


@query
def bases_file(spark, sf_dir):
    """Site roots through a CSV file with loose spacing and incomplete rows."""
    path = scratch_path(spark, "bases")
    pages = table(spark, sf_dir, "pages")
    name = F.when(F.col("page_id") % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit("  Set "), F.col("page_id").cast("string"), F.lit(" ")))
    loose = pages.select(name.alias(" Title "), F.concat(F.lit(" "), F.when(F.col("page_id") % 5 > 0, F.col("url"))).alias("URL"))
    loose.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return src.read_bases(spark, path)


@query
def report_header(spark, sf_dir):
    """The lines above the inventory report: what it is about, and its date."""
    path = scratch_path(spark, "report-header")
    src.write_report_header(spark, path, f"{view(spark, sf_dir, 'v_md').count()} documents")
    return spark.read.text(path)


# --- sources, sinks, stream -----------------------------------------------------------------


@query
def scan_doc_tree(spark, sf_dir):
    """Documents written as a file tree and scanned again, folder indexes included."""
    root = scratch_path(spark, "tree")
    doctree.write_doc_tree(view(spark, sf_dir, "v_md").select("path", "content"), root)
    docs = doctree.read_doc_tree(spark, root)
    path = F.concat(F.lit("/"), doctree.below_root(F.col("path"), root))
    return docs.select(path.alias("path"), "content", "error")


@query
def xml_tree(spark, sf_dir):
    root = scratch_path(spark, "xml")
    doctree.write_doc_tree(view(spark, sf_dir, "v_xml").select("path", F.col("xml").alias("content")), root)
    return doctree.read_xml_docs(spark, root, sites.LANGUAGES).select("path", "xml", "lang")


@query
def doc_tree_sink(spark, sf_dir):
    """Rewritten documents stored as a result table, never in place."""
    path = scratch_path(spark, "rewritten")
    D.rewritten(view(spark, sf_dir, "v_md")).select("path", F.col("new_content").alias("content"), "changed").write.parquet(path)
    return spark.read.parquet(path)


@query
def lookup_csv(spark, sf_dir):
    """Rules as a loose CSV file, read back with the lookup reader."""
    path = scratch_path(spark, "lookup")
    rows = view(spark, sf_dir, "v_redirect").repartitionByRange(8, "ord").sortWithinPartitions("ord")
    loose = rows.select(F.col("prefix").alias("filepath"), F.concat(F.lit(" "), "target").alias(" url"))
    loose.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)  # files in order, each with a header
    return src.read_lookup_csv(spark, path).select("prefix", "target")


@query
def config_file_lines(spark, sf_dir):
    """Configuration lines written to text files and read back in order."""
    path = scratch_path(spark, "conf")
    lines = view(spark, sf_dir, "v_config_lines")
    # a large file goes to several text files, in the order of their names
    lines.repartitionByRange(16, "file_id", "line_no").sortWithinPartitions("file_id", "line_no").select("line").write.text(path)
    return src.read_config_lines(spark, path).filter("line <> ''").groupBy("line").agg(F.count("*").alias("n"))


@query
def id_list(spark, sf_dir):
    path = scratch_path(spark, "ids")
    view(spark, sf_dir, "v_exclude").write.text(path)
    return src.read_id_list(spark, path)


@query
def report_sink(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = doc_inventory(spark, sf_dir)
    src.write_report(report, path, ["filename", "docsID", "url"], ["filename"])
    return src.read_report(spark, path, "filename string, docsID string, url string")


@query
def partitioned_sink(spark, sf_dir):
    path = scratch_path(spark, "by-language")
    src.write_partitioned(xml_inventory(spark, sf_dir), path, "lang")
    return spark.read.schema("file string, title string, link string, last_commit string, lang string").parquet(path)


@query
def stream_feedback(spark, sf_dir):
    target = scratch_path(spark, "stream")
    landing = spark.readStream.schema(table(spark, sf_dir, "events").schema).option(
        "pathGlobFilter", "events.parquet"
    ).parquet(sf_dir)
    answers = landing.select(
        F.col("event_id").alias("row_id"),
        F.concat(F.lit("R_"), F.col("event_id").cast("string")).alias("response_id"),
        F.concat(F.lit("https://docs.example.com/"), "event_type").alias("link_url"),
        F.col("value").alias("q1"),
        F.concat_ws(" ", "event_type", "props").alias("q2"),
        F.col("ts").cast("string").alias("start_date"),
    )
    run_feedback_stream(answers, target, origin=ORIGIN, products=view(spark, sf_dir, "v_product"))
    return read_feedback(spark, target)


@query
def stream_corrections(spark, sf_dir):
    """Answers that arrive in four files, some of them corrected or late: the newest of each response counts."""
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "corrections")
    answers = view(spark, sf_dir, "v_correction")
    answers.repartitionByRange(4, "arrival").drop("arrival").sortWithinPartitions("row_id").write.parquet(landing)
    stream = spark.readStream.schema(answers.drop("arrival").schema).option("maxFilesPerTrigger", 1).parquet(landing)
    run_corrected_stream(stream, target, origin=ORIGIN, products=view(spark, sf_dir, "v_product"))
    return read_corrected(spark, target)
