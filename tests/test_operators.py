import random

import pytest
from pyspark.sql import Window, functions as F

from contentlake.operators import aggregates as A, enrich, filters, graph, includes, prefix
from contentlake.operators.redirect_rules import parse_redirects, redirect_table
from contentlake.operators.skew import lookup_join, running_sum
from contentlake.plans.survey import clean_survey, map_product, with_first_prefix

ORIGIN = "https://docs.example.com"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- joins and sums under skew ----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 50).cast("string")).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3), ("5", 4), (None, 5), ("gone", 6)], "k string, v int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_plain_join(skewed, how):
    left, right = skewed
    sliced = lookup_join(left, right, "k", how, broadcast_bytes=-1, hot_rows=100)
    assert rows(sliced.select(*sorted(sliced.columns))) == rows(left.join(right, "k", how).select(*sorted(sliced.columns)))


def test_sliced_join_spreads_the_hot_key(spark, skewed):
    left, right = skewed
    joined = lookup_join(left, right, "k", "inner", broadcast_bytes=-1, hot_rows=100)
    hot = joined.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = joined.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) > 1


def test_small_lookup_is_broadcast(skewed):
    left, right = skewed
    plan = lookup_join(left, right, "k")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_running_sum_in_blocks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("n"), (F.col("id") % 5 == 0).alias("flag"))
    plain = df.withColumn("s", F.sum(F.col("flag").cast("bigint")).over(Window.partitionBy("g").orderBy("n")))
    assert rows(running_sum(df, ["g"], "n", F.col("flag"), "s", block_rows=37)) == rows(plain)


# --- prefixes ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def urls(spark):
    rng = random.Random(11)
    make = lambda: "https://h/" + "".join(rng.choice(["a/", "b/", "ab/", "a/b/"]) for _ in range(rng.randint(0, 4)))
    values = [(i, None if i % 20 == 0 else make()) for i in range(400)]
    rules = [(i, make(), f"https://t/{i}/") for i in range(15)]
    return values, rules, spark.createDataFrame(values, "id int, url string"), spark.createDataFrame(rules, "ord int, prefix string, target string")


@pytest.mark.parametrize("pick, slashes", [("longest", True), ("longest", False), ("first", True), ("first", False)])
def test_prefix_match_equals_brute_force(urls, pick, slashes):
    values, rules, df, rule_df = urls
    key = (lambda r: (-len(r[1]), r[0])) if pick == "longest" else (lambda r: r[0])

    def best(url):
        hits = sorted((r for r in rules if url and url.startswith(r[1])), key=key)
        return (hits[0][1], hits[0][2]) if hits else (None, None)

    got = {r["id"]: (r["matched"], r["target"]) for r in prefix.match_prefix(df, "url", rule_df, pick=pick, slash_terminated=slashes).collect()}
    assert got == {i: best(u) for i, u in values}


def test_case_and_join_agree(urls):
    _, _, df, rule_df = urls
    assert rows(with_first_prefix(df, "url", rule_df)) == rows(prefix.match_prefix(df, "url", rule_df, pick="first"))


def test_redirects(spark):
    rules = spark.createDataFrame(
        [(0, "https://h/a/", "https://n/x/"), (1, "https://h/a/", "https://n/late/"), (2, "https://h/a/b/", "https://n/y$1/"), (3, "https://h/a/whole/", "https://n/w/")],
        "ord int, prefix string, target string",
    )
    df = spark.createDataFrame([(1, "https://h/a/c/"), (2, "https://h/a/b/c/"), (3, "https://h/ab/"), (4, "https://h/a/whole/"), (5, None)], "id int, url string")
    out = prefix.apply_redirects(df, "url", prefix.dedup_rules(rules), ORIGIN, "url2")
    assert {r["id"]: r["url2"] for r in out.collect()} == {1: "https://n/x/c/", 2: "https://n/y/c/", 3: "https://h/ab/", 4: "https://n/w/", 5: None}
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert [r["ord"] for r in prefix.top_rules(prefix.dedup_rules(rules), 2).collect()] == [3, 2]


def test_canonical_links_equal_row_wise_cleaning(spark):
    raw = [" https:///h/a/c?x#y ", "/p$is_args$args", "?q", "#f", "", "  ", None, "../a/./b?x", "https://h/a/b#z", "//h/a/q", "https:?x", "HTTP://h/a/$v?y", "?a?b", "https://h/a/c/"]
    df = spark.createDataFrame(list(enumerate(raw)), "id int, url string")
    rules = spark.createDataFrame([(0, "https://h/a/", "https://n/x/")], "ord int, prefix string, target string")
    from contentlake.plans.survey import clean_link_urls

    cleaned = clean_link_urls(df, ["url"], ORIGIN).drop("original_url")
    want = prefix.apply_redirects(cleaned, "url", rules, ORIGIN, "c")
    assert rows(prefix.canonical_links(df, "url", rules, ORIGIN, "c")) == rows(want)


def test_product_map(spark):
    rules = spark.createDataFrame([(2, "https://h/", "All"), (1, "https://h/a/", "A")], "ord int, prefix string, target string")
    df = spark.createDataFrame([("https://h/a/b/",), ("https://h/z/",), ("http://q/",), (None,)], "url string")
    assert [r["product"] for r in map_product(df, "url", rules).collect()] == ["A", "All", "Unknown", "Unknown"]


# --- filters and survey ---------------------------------------------------------------------------


def test_filters_skip_absent_columns(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "TESTing it")], "id int, q2 string")
    assert filters.drop_missing(df, "nope").count() == 3
    assert filters.drop_keyword(df, "nope", "x").count() == 3
    assert [r["id"] for r in filters.drop_missing(df, "q2").collect()] == [2, 3]
    assert [r["id"] for r in filters.drop_keyword(df, "q2", "testing").collect()] == [1, 2]
    with pytest.raises(ValueError, match="absent"):
        filters.require_columns(df, ["id", "absent"])
    assert "ResponseId" in filters.alias_column(spark.createDataFrame([(1,)], "`Response ID` int"), filters.RESPONSE_ID_NAMES, "ResponseId").columns


def test_not_index(apply):
    assert apply(["index.md", "a/INDEX.md", "a/_index.md", "aindex.md"], filters.not_index) == [False, False, True, True]


def test_exclude_ids(spark):
    df = spark.createDataFrame([(" a ",), ("b",), (None,), ("a",)], "rid string")
    ids = spark.createDataFrame([("a ",), ("",), ("a",), ("zz",)], "id string")
    assert rows(filters.exclude_ids(df, ids, "rid")) == [("b",), (None,)]
    assert rows(filters.excluded_report(df, ids, "rid")) == [("a", 2)]


def test_header_rows(spark):
    df = spark.createDataFrame([(0, "h1", "h2"), (1, "ImportId x", None), (2, "h1", "h2")], "o int, h1 string, h2 string")
    assert A.first_rows_dropped(df, "o", ["h1", "h2"], "label").count() == 2
    assert A.first_rows_dropped(df.filter("o > 0").withColumn("o", F.col("o") - 1), "o", ["h1", "h2"], "ImportId x").count() == 1
    assert [r["o"] for r in A.metadata_row_dropped(df, "o", ["h1", "h2"], "ImportId").collect()] == [0, 2]


def test_clean_survey_without_rules_keeps_canonical(spark):
    df = spark.createDataFrame([(1, "https://h/a?x", "see a@b.c  now"), (2, None, "x"), (3, " ", "y"), (4, "/p", "Testing")], "row_id int, link_url string, q2 string")
    out = {r["row_id"]: r for r in clean_survey(df, origin=ORIGIN).collect()}
    assert set(out) == {1, 3}
    assert out[1]["canonical_url"] == "https://h/a/" and out[1]["original_link_url"] == "https://h/a?x" and out[1]["q2"] == "see now"
    assert out[3]["link_url"] is None


def test_results_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i, f"https://h/{'ab'[i % 2]}/{i % 5}/", float(i % 4), f"c{i}") for i in range(200)], "row_id long, u string, q1 double, q2 string")
    df = df.withColumn("d", F.lit("2024-01-01"))
    run = lambda n: rows(A.feedback_by_page(df.repartition(n), url="u", rating="q1", comment="q2", date="d", order="row_id", product=F.lit("p")))
    assert run(1) == run(17)


def test_large_pages_are_cut_into_parts_and_stay_whole(spark):
    df = spark.createDataFrame([(i, "big" if i % 3 else "small", 1.0, None if i % 10 == 0 else f"c{i}", "2024-01-01") for i in range(300)], "row_id long, u string, q1 double, q2 string, d string")
    args = dict(url="u", rating="q1", comment="q2", date="d", order="row_id", product=F.lit("p"))
    whole = {r["canonical_url"]: r for r in A.feedback_by_page(df, **args).collect()}
    parts = A.feedback_by_page(df, **args, max_comments=100).orderBy("canonical_url", "part").collect()
    assert {r["part"] for r in parts if r["canonical_url"] == "small"} == {1}
    big = [r for r in parts if r["canonical_url"] == "big"]
    assert [r["part"] for r in big] == [1, 2]
    assert "|||".join(r["q2_comments"] for r in big) == whole["big"]["q2_comments"]
    assert [r["n"] for r in big] == [200, None] and len(big[0]["q2_comments"].split("|||")) == 100


def test_parts_are_counted_per_page_over_files_and_bytes(spark):
    data = [(f"f{k}", i, "u", 1.0, f"{k}:{i}", "2024-01-01") for k in range(3) for i in range(7)] + [("f0", 50, None, 1.0, "n", "2024-01-01")]
    df = spark.createDataFrame(data, "file string, row_id long, u string, q1 double, q2 string, d string")
    args = dict(url="u", rating="q1", comment="q2", date="d", order=["file", "row_id"], product=F.lit("p"))
    parts = A.feedback_by_page(df, **args, max_comments=5).filter("canonical_url = 'u'").orderBy("part").collect()
    assert [len(r["q2_comments"].split("|||")) for r in parts] == [5, 5, 5, 5, 1] and [r["part"] for r in parts] == [1, 2, 3, 4, 5]
    assert "|||".join(r["q2_comments"] for r in parts) == "|||".join(f"{k}:{i}" for k in range(3) for i in range(7))
    by_bytes = A.feedback_by_page(df, **args, max_bytes=9).orderBy("canonical_url", "part").collect()
    assert [r["part"] for r in by_bytes if r["canonical_url"] is None] == [1]
    cut = [r for r in by_bytes if r["canonical_url"] == "u"]
    assert [r["part"] for r in cut] == list(range(1, len(cut) + 1)) and all(r["q2_comments"].count("|||") <= 3 for r in cut)


def test_feedback_edge_groups(spark):
    df = spark.createDataFrame([(0, None, 2.0, None, "2024-01-01"), (1, "u", None, "x", "2024-01-01"), (2, "u", 1.0, "x", "bad"), (3, " v ", 2.0, "b", "2024-01-01"), (4, "v", 2.5, "a", "2024-01-01")], "row_id long, u string, q1 double, q2 string, d string")
    out = A.feedback_by_page(df, url="u", rating="q1", comment="q2", date="d", order="row_id", product=F.lit(None).cast("string"))
    assert rows(out) == sorted([(None, "Unknown", 1, 2.0, 1, ""), ("v", "Unknown", 1, 2.25, 2, "b|||a")], key=repr)


def test_reports(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "x", "x"), (3, None, "z")], "id int, old string, new string")
    assert rows(A.audit_changes(df, "id", "s", [("r", F.col("old"), F.col("new"))])) == [("s", "1", "r", "a", "b")]
    counts = A.stage_counts(df, [("has_old", F.col("old").isNotNull()), ("same", F.col("old") == F.col("new"))])
    assert rows(counts) == [(0, "input", 3), (1, "has_old", 2), (2, "same", 1)]
    assert rows(A.column_widths(df, "new", ["old"])) == [("b", 5), ("x", 5), ("z", 5)]
    assert rows(A.run_stats(spark.createDataFrame([(0,), (2,)], "e int"), "e")) == [(2, 1, 2)]


def test_wide_audit_columns(spark):
    df = spark.createDataFrame([("b", {"title": '"t"', "zeta": "1"}, None), ("a", {"Title": '"T"', "alpha": "[1]"}, True)], "file string, data map<string,string>, flag boolean")
    from contentlake.functions.metadata import text_value

    wide = A.metadata_wide(df, "file", "data", text_value, ["flag"], ["title", "Title", "alpha", "zeta"])
    assert wide.columns == ["file", "title", "Title_", "alpha", "flag", "zeta"]
    assert [r["file"] for r in wide.collect()] == ["a", "b"]


def test_audit_of_very_many_keys(spark):
    from contentlake.plans.documents import metadata_audit

    docs = spark.range(2100).select(F.concat(F.lit("/repo/content/d"), "id").alias("path"), F.concat(F.lit("---\nkey"), "id", F.lit(": 1\n---\n")).alias("content"))
    assert metadata_audit(docs, "/repo/content").select("key").distinct().count() == 2100


def test_unreadable_and_odd_documents_stay_single_errors(spark, tmp_path):
    from contentlake.plans.documents import archive, metadata_audit, metadata_cleanup, reading_levels

    docs = spark.createDataFrame(
        [("/r/c/a/1.md", None, "Error reading 1.md: gone"), ("/r/c/a/2.md", "---\nmenu: {2024-01-01: x}\n---\n", None), ("/r/c/a/3.md", "---\na: &x [*x]\n---\n", None), ("/r/c/a/4.md", "---\ntype: [1, tasks]\ntags: x\n---\nText here.", None)],
        "path string, content string, error string",
    )
    got = {(r["file"], r["key"]): r["value"] for r in metadata_audit(docs, "/r/c").collect()}
    assert got[("/r/c/a/1.md", "Error in frontmatter")] == "Error reading 1.md: gone"
    assert got[("/r/c/a/2.md", "menu")] == '{"2024-01-01": "x"}'
    assert got[("/r/c/a/3.md", "Error in frontmatter")] not in (None, "True")
    assert got[("/r/c/a/4.md", "type")] == '[1, "tasks"]'
    archived = {r["path"]: r for r in archive(docs, spark.createDataFrame([], "include_path string, content string"), "/r/c").collect()}
    bad = archived["/r/c/a/1.md"]
    assert bad["archived"] is None and bad["n_errors"] == 1 and bad["error"].startswith("ERROR while reading /r/c/a/1.md: ")
    assert rows(A.run_stats(spark.createDataFrame(list(archived.values())), "n_errors")) == [(4, 3, 1)]
    levels = {r["path"]: r for r in reading_levels(docs).collect()}
    assert levels["/r/c/a/1.md"]["reading_level"] is None and levels["/r/c/a/1.md"]["error"] == "Error reading 1.md: gone"
    changed = metadata_cleanup(docs).filter("path like '%4.md'").first()
    assert changed["invalid_types"] == ["tasks"] and "tags" not in changed["new_content"]


# --- includes ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library(spark):
    fragments = [
        ("leaf.md", "---\nt: x\n---\nleaf\n"),
        ("two.md", 'A {{< include "leaf.md" >}}B {{< include \'/leaf.md\' >}}C\n'),
        ("gone.md", 'G {{< include "none.md" >}}\n'),
        ("self.md", '{{< include "self.md" >}}\n'),
        ("p.md", '{{< include "q.md" >}}\n'),
        ("q.md", '{{< include "p.md" >}}\n'),
        ("deep.md", '1{{< include "two.md" >}}2{{< include "gone.md" >}}\n'),
        ("vers.md", 'v1\n{{< versions "1" >}}\nv2\n'),
        ("index.md", "x\n"),
    ]
    docs = [
        ("a", 'x {{< include "/two.md" >}} y {{< include "leaf.md" >}}\n'),
        ("b", 'none at all\n'),
        ("c", '{{< include "nope.md" >}}|{{< include "deep.md" >}}\n'),
        ("d", '{{< include "p.md" >}}\n'),
        ("e", 'k {{< include "vers.md" >}}z\nnext\n'),
        ("f", '{{< include "self.md" >}} {{< include "leaf" >}}\n'),
    ]
    return spark.createDataFrame(docs, "path string, content string"), spark.createDataFrame(fragments, "include_path string, content string")


def test_expand_includes(library):
    docs, fragments = library
    out = {r["path"]: r for r in includes.expand_includes(docs, fragments).collect()}
    two = "A leaf\nB leaf\nC\n"
    assert out["a"]["expanded"] == f"x {two} y leaf\n\n" and out["a"]["n_errors"] == 0
    assert out["b"]["expanded"] == "none at all\n" and out["b"]["error"] is None
    assert out["c"]["expanded"] == f"|1{two}2G \n\n\n" and out["c"]["n_errors"] == 2
    assert out["c"]["error"] == "missing include: none.md, nope.md"
    assert out["d"]["expanded"] is None and out["d"]["error"] == "include cycle"
    assert out["f"]["n_errors"] == 1


def test_expansion_leaves_no_resolvable_include(library):
    docs, fragments = library
    done = includes.expand_includes(docs, fragments).filter("expanded is not null")
    assert done.filter(F.col("expanded").contains("{{< include")).count() == 0


def test_compat_drops_the_whole_line(library):
    docs, fragments = library
    out = {r["path"]: r["expanded"] for r in includes.expand_includes(docs, fragments, compat=True).collect()}
    assert out["e"] == "next\n" and out["b"] == "none at all\n"


def test_include_usage(library):
    docs, fragments = library
    usage = {r["include_path"]: r["uses"] for r in includes.include_usage(docs, fragments).collect()}
    # 'leaf' without .md counts; single quotes and index files do not
    assert usage == {"leaf.md": 2, "two.md": 1, "gone.md": 0, "self.md": 1, "p.md": 1, "q.md": 0, "deep.md": 1, "vers.md": 1}


def test_cache_grows_by_what_is_new(spark, tmp_path):
    path, schema = str(tmp_path / "cache"), "k long, v string"
    frame = lambda *r: spark.createDataFrame(r, schema)
    enrich.append_cache(frame((1, "a"), (2, "b"), (None, "z")), path, ["k"], 0)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "cache" / "batch=0").glob("*.parquet")}
    for _ in range(2):  # a repeated batch replaces itself
        enrich.append_cache(frame((2, "x"), (3, "d"), (3, "c")), path, ["k"], 1)
    enrich.append_cache(frame((3, "q")), path, ["k"], 2)
    assert rows(enrich.read_cache(spark, path).select("k", "v")) == [(1, "a"), (2, "b"), (3, "c")]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "cache" / "batch=0").glob("*.parquet")} == before


# --- graph --------------------------------------------------------------------------------------------


def test_reachable(spark):
    pages = spark.createDataFrame(
        [
            ("https://h/d", '<a href="/d/a">1</a><a href="/d/b/">2</a><a href="/other/x">3</a>'),
            ("https://h/d/a", '<a href="b">b</a><a href="/d/">home</a><a href="/d/pic.png">p</a><a href="/d/c#x">c</a>'),
            ("https://h/d/b", '<a href="https://h/d/a">back</a><a href="/d/missing">m</a><a href="/d&amp;e">amp</a>'),
            ("https://h/d/island", '<a href="/d/never">n</a>'),
        ],
        "url string, html string",
    )
    bases = spark.createDataFrame([("D", "https://h/d"), ("Empty", "https://h/none")], "doc_set string, base string")
    found = graph.reachable(graph.crawl_candidates(graph.page_links(pages), bases), bases)
    assert rows(found) == [("D", "https://h/d/a"), ("D", "https://h/d/b"), ("D", "https://h/d/missing")]
    assert rows(graph.pages_per_set(found)) == [("D", 3)]


@pytest.mark.parametrize("bucket_bytes,merge", [(1, 4), (1 << 28, 3)])
def test_reachable_through_many_rounds(spark, monkeypatch, bucket_bytes, merge):
    """A chain, a hub and loops, over one folder and many, with merged rounds."""
    monkeypatch.setattr(graph, "MERGE_TURNS", merge)
    links = [("A", f"c{i}", f"c{i + 1}") for i in range(9)] + [("A", "c2", f"h{i}") for i in range(80)] + [("A", f"h{i}", "c1") for i in range(80)]
    links += [("B", "c0", "c1"), ("B", "c5", "c6"), ("B", "b", "b")]
    bases = spark.createDataFrame([("A", "c0"), ("B", "c0"), ("C", "c0")], "doc_set string, base string")
    found = graph.reachable(spark.createDataFrame(links, "doc_set string, src string, dst string"), bases, bucket_bytes)
    want = [("A", f"c{i}") for i in range(1, 10)] + [("A", f"h{i}") for i in range(80)] + [("B", "c1")]
    assert sorted(rows(found)) == sorted(want)


def test_reachable_from_nothing(spark):
    pages = spark.createDataFrame([("https://h/d", "<p>")], "url string, html string")
    bases = spark.createDataFrame([("D", "https://h/d")], "doc_set string, base string")
    assert graph.reachable(graph.crawl_candidates(graph.page_links(pages), bases), bases).count() == 0


# --- redirect rules -------------------------------------------------------------------------------------


CONFIG = """
# comment return 301 /no;
location = /a {
  return 301 /b$is_args$args;
}
/c   /d
/c /second
location /e { return 302 "https:/x//y"; }
location /f {
  /inside /skipped
location /g {
LOCATION /h {
  return 301 '/i';
/j /k trailing
location ~ \\.php$ {
/l /m
location /open {
/lost /lost2
"""


@pytest.mark.parametrize("block_rows", [2, 1000])
def test_redirect_rules(spark, block_rows):
    lines = [("f", i, line) for i, line in enumerate(CONFIG.split("\n"))]
    df = spark.createDataFrame(lines, "file_id string, line_no int, line string")
    got = [(r["prefix"], r["target"]) for r in parse_redirects(df, ORIGIN, block_rows=block_rows).orderBy("line_no").collect()]
    o = ORIGIN
    assert got == [
        (f"{o}/a/", f"{o}/b/"),
        (f"{o}/c/", f"{o}/d/"),
        (f"{o}/c/", f"{o}/second/"),
        (f"{o}/e/", "https://x/y/"),
        (f"{o}/g/", f"{o}/i/"),
        (f"{o}/j/", f"{o}/k/"),
        (f"{o}/l/", f"{o}/m/"),
    ]
    table = {r["prefix"]: r["target"] for r in redirect_table(parse_redirects(df, ORIGIN)).collect()}
    assert table[f"{o}/c/"] == f"{o}/d/" and len(table) == 6


# --- enrichment ------------------------------------------------------------------------------------------


def test_cache(spark):
    df = spark.createDataFrame([(1, 1.000004, 2.0), (2, None, 2.0), (3, float("nan"), 1.0), (4, 5.0, 6.0)], "id int, lat double, lon double")
    cache = spark.createDataFrame([(100000, 200000, "X")], "lat_key long, lon_key long, country string")
    assert rows(enrich.missing_keys(df, cache, "lat", "lon")) == [(500000, 600000)]
    assert {r["id"]: r["country"] for r in enrich.attach_country(df, cache, "lat", "lon").collect()} == {1: "X", 2: None, 3: None, 4: None}
    new = spark.createDataFrame([(100000, 200000, "other"), (500000, 600000, "Y")], "lat_key long, lon_key long, country string")
    assert rows(enrich.upsert_cache(cache, new, ["lat_key", "lon_key"])) == [(100000, 200000, "X"), (500000, 600000, "Y")]


@pytest.mark.parametrize("leaf", [1, 32])
def test_nearest_place_equals_brute_force(spark, leaf):
    import math

    rng = random.Random(7)
    places = [(i, rng.uniform(-89, 89), rng.uniform(-180, 180), f"P{i}") for i in range(40)]
    places += [(100 + i, 10 + rng.uniform(0, 1), 10 + rng.uniform(0, 1), f"C{i}") for i in range(150)]  # a dense city
    places += [(300 + i, 10.5, 10.5, f"S{i}") for i in range(40)]  # many places at one spot
    points = [(round(a * 1e5), round(b * 1e5)) for a, b in [(90, 0), (-90, 10), (10.5, 10.5), (10.4, 10.6), (9.9, 9.9), (0, 180), (0, -179.99), (12, 179.9)] + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]]

    def xyz(lat, lon):
        la, lo = math.radians(lat), math.radians(lon)
        return math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)

    def best(p):
        at = xyz(p[0] / 1e5, p[1] / 1e5)
        return min(places, key=lambda q: (round(sum((a - b) ** 2 for a, b in zip(at, xyz(q[1], q[2]))), 12), q[0]))[3]

    out = enrich.nearest_place(
        spark.createDataFrame(points, "lat_key long, lon_key long"),
        spark.createDataFrame(places, "place_id int, lat double, lon double, country string"),
        leaf,
    )
    assert {(r["lat_key"], r["lon_key"]): r["country"] for r in out.collect()} == {p: best(p) for p in points}


def test_country_names_fall_back_to_the_code(spark):
    located = spark.createDataFrame([(1, "DE"), (2, "XX")], "id int, country string")
    names = spark.createDataFrame([("DE", "Germany")], "code string, name string")
    assert {r["id"]: r["country"] for r in enrich.country_names(located, names).collect()} == {1: "Germany", 2: "XX"}


def test_last_commit(spark):
    import datetime as dt

    files = spark.createDataFrame([("a",), ("b",)], "f string")
    commits = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 3)), ("a", dt.datetime(2023, 1, 1))], "f string, ts timestamp_ntz")
    assert rows(enrich.last_commit(files, commits, "f", "ts")) == [("a", "2024-01-02T03:00:00+00:00"), ("b", "")]


def test_page_totals_do_not_depend_on_parts(spark):
    rows = [(i, "u", 3.0, f"comment {i}" if i % 3 else None, "2024-01-01") for i in range(40)] + [(99, "v", 2.0, None, "2024-01-01")]
    df = spark.createDataFrame(rows, "row_id long, url string, q1 double, q2 string, day string")
    args = dict(url="url", rating="q1", comment="q2", date="day", order="row_id", product=F.lit("P"))
    whole = {tuple(r) for r in A.page_totals(A.feedback_by_page(df, **args), ["canonical_url", "product"]).collect()}
    cut = A.feedback_by_page(df, **args, max_comments=4)
    assert cut.filter("canonical_url = 'u'").count() > 5
    assert {tuple(r) for r in A.page_totals(cut, ["canonical_url", "product"]).collect()} == whole
    assert whole == {("u", "P", 3.0, 40, len("|||".join(r[3] for r in rows[:40] if r[3]))), ("v", "P", 2.0, 1, 0)}


def test_redirected_rows_are_read_once(spark):
    """Null, blank and repeated URLs; the rows are computed for the distinct URLs and not again for the join."""
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda u: seen.add(1) or u, "string").asNondeterministic()
    urls = ["https://h/a/b/", "https://h/a/b/", "https://h/c/", "", None, None, "https://x/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, raw string").select("i", mark("raw").alias("url"))
    rules = spark.createDataFrame([(1, "https://h/", "https://n/"), (2, "https://h/a/", "https://m/")], "ord int, prefix string, target string")
    moved = prefix.apply_redirects(df, "url", prefix.dedup_rules(rules), "https://docs.example.com", "canonical")
    got = [tuple(r) for r in moved.orderBy("i").collect()]
    want = ["https://m/b/", "https://m/b/", "https://n/c/", "", None, None, "https://x/"]
    assert got == [(i, u, w) for i, (u, w) in enumerate(zip(urls, want))]
    assert seen.value == len(urls)
