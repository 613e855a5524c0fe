"""The physical plans the operators are meant to get."""

import re

import pytest
from pyspark.sql import functions as F

from contentlake.functions import text as T, urls as U
from contentlake.operators import aggregates as A, filters, includes, prefix
from contentlake.plans.documents import classified, reading_levels
from contentlake.session import materialize, row_count, known_bytes


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def survey(spark, tmp_path):
    rows = [(i, f"https://h/{i % 7}/?q", float(i % 5), f"c{i}", "2024-01-01", "pad") for i in range(100)]
    spark.createDataFrame(rows, "row_id long, link_url string, q1 double, q2 string, start_date string, unused string").write.parquet(str(tmp_path / "s"))
    return spark.read.parquet(str(tmp_path / "s"))


def test_filters_and_columns_reach_the_scan(survey):
    plan = plan_of(filters.keep_rated(filters.drop_missing(survey, "link_url"), "start_date", "q1").select("row_id"))
    assert "IsNotNull(link_url)" in plan and "IsNotNull(q1)" in plan
    assert "unused" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_url_cleaning_needs_no_shuffle_and_no_python(survey):
    plan = plan_of(survey.select(U.normalize_url("link_url"), T.scrub_emails("q2")[0]))
    assert "Exchange" not in plan and "Python" not in plan and "*(1) Project" in plan


def test_statistics_aggregate_before_the_shuffle(survey):
    plan = plan_of(A.page_statistics(survey, ["link_url"], "q1", "q2"))
    assert "partial_sum" in plan and plan.count("Exchange") == 1


def test_redirect_plan(spark, survey):
    rules = spark.createDataFrame([(0, "https://h/1/", "https://n/")], "ord int, prefix string, target string")
    plan = plan_of(prefix.canonical_links(survey, "link_url", rules, "https://o", "canonical"))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Exchange hash" not in plan


def test_usage_counts_with_one_shuffle_of_references(spark):
    docs = spark.createDataFrame([("a", '{{< include "x.md" >}}')], "path string, content string")
    fragments = spark.createDataFrame([("x.md", "")], "include_path string, content string")
    plan = plan_of(includes.include_usage(docs, fragments))
    assert "partial_count" in plan and "NestedLoop" not in plan


def test_audit_keeps_document_text_out_of_the_python_stage(spark, tmp_path):
    spark.createDataFrame([("/r/content/a.md", "---\na: 1\n---\nlong body")], "path string, content string").write.parquet(str(tmp_path / "d"))
    plan = plan_of(classified(spark.read.parquet(str(tmp_path / "d")), "/r/content"))
    below = plan[plan.index("ArrowEvalPython"):]
    assert re.search(r"Generate explode\(array\(.*\)\), \[path#\d+\], false, \[_block#", below)


def test_rough_reading_levels_stay_in_the_jvm(spark):
    docs = spark.createDataFrame([("a", "Some words here.")], "path string, content string")
    assert "Python" not in plan_of(reading_levels(docs, plain=T.markdown_to_text))


def test_materialize_knows_rows_and_bytes(spark):
    out = materialize(spark.range(10).select("id", F.lit("abc").alias("t"), F.array(F.lit(1)).alias("a")), "test")
    assert row_count(out) == 10 and out.count() == 10
    assert 10 * (8 + 3 + 8) <= known_bytes(out) < 10 * 100
    assert row_count(materialize(spark.range(0), "test")) == 0


def test_feedback_reads_its_answers_once(spark, survey, tmp_path, monkeypatch):
    """Over all jobs the survey is scanned once, the stored answers three times: statistics, block totals, comments."""
    from contentlake.plans import survey as S

    plans = []
    once = materialize

    def noted(df, label):
        plans.append(plan_of(df))
        return once(df, label)

    for module in ("contentlake.operators.aggregates", "contentlake.operators.prefix", "contentlake.operators.skew"):
        monkeypatch.setattr(f"{module}.materialize", noted)
    products = spark.createDataFrame([(1, "https://h/", "All")], "ord int, prefix string, target string")
    out = S.feedback_dataset(survey.withColumn("link_url", U.normalize_url("link_url")), products)
    plans.append(plan_of(out))
    scans = [re.findall(r"Location: InMemoryFileIndex.*?\[file:([^\],]+)", p) for p in plans]
    source = [s for plan in scans for s in plan if str(tmp_path) in s]
    assert 1 <= len(source) <= 2, source  # once for the distinct URLs, once for the rows
    assert 1 <= sum("rated-answers" in s for plan in scans for s in plan) <= 3
    assert out.count() == 7


def test_python_stages_of_pages_and_documents_take_small_batches(spark, tmp_path):
    from contentlake.operators import graph
    from contentlake.plans import documents as D
    from contentlake.session import PAGE_BYTES
    from contentlake.sources import doctree

    key, root = "spark.sql.execution.arrow.maxBytesPerBatch", str(tmp_path / "tree")
    docs = spark.createDataFrame([("/repo/content/a/p.md", "---\ntags: x\n---\nText")], "path string, content string")
    pages = spark.createDataFrame([("https://h/a", '<a href="/b">')], "url string, html string")
    kept = spark.conf.get(key)
    steps = {
        "links": lambda: graph.page_links(pages).count(),
        "cleanup": lambda: D.metadata_cleanup(docs).count(),
        "audit": lambda: D.classified(docs, "/repo/content").count(),
        "write": lambda: doctree.write_doc_tree(docs, root).count(),
        "read": lambda: doctree.read_doc_tree(spark, root).count(),
    }
    try:
        for name, step in steps.items():
            spark.conf.set(key, str(64 << 20))
            step()
            assert int(spark.conf.get(key)) <= PAGE_BYTES, name
    finally:
        spark.conf.set(key, kept)
