import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from contentlake.functions import urls as U

ORIGIN = "https://docs.example.com"

NORMAL = {
    " https:///h/a//b?x#y ": "https://h/a/b/",
    "": None,
    "   ": None,
    None: None,
    "a/b": "/a/b/",
    "https://h/a b": "https://h/a b/",
    "https://h": "https://h/",
    "https://h/foo.html": "https://h/foo.html/",
    "HTTP://H/x": "http://H/x/",
    "//host/p": "/p/",
    "mailto:a@b": "/a@b/",
    "?q": "/",
    "https://h/a#b?c": "https://h/a/",
    "\u00a0https://h/é\u3000": "https://h/é/",
    "https://h/a://b": "https://h/a:/b/",
}


def test_normalize_url(apply):
    assert dict(zip(NORMAL, apply(list(NORMAL), U.normalize_url))) == NORMAL


def test_normalize_url_is_idempotent(apply):
    rng = random.Random(3)
    urls = ["".join(rng.choices(["https:", "http:", "/", "//", "a", "b.c", "?", "#", " ", ".", "..", "$x"], k=rng.randint(1, 9))) for _ in range(500)]
    once = apply(urls, U.normalize_url)
    assert apply(once, U.normalize_url) == once


@pytest.mark.parametrize("origin", [ORIGIN, ORIGIN + "/"])
def test_absolute_url(apply, origin):
    cases = {
        "../z": ORIGIN + "/z/",
        "/a/../b": ORIGIN + "/b/",
        "x/./y": ORIGIN + "/x/y/",
        "//g/z": "https://g/z/",
        "https://h/a/../b": "https://h/a/../b/",
        "?q": ORIGIN + "/",
        "https:/h/a": "https://h/a/",
        "": None,
    }
    assert dict(zip(cases, apply(list(cases), lambda c: U.absolute_url(c, origin)))) == cases


def test_regular_urls_take_the_short_route_to_the_same_result(spark):
    """Null, blank, long, repeated and odd URLs: one pattern or all rules, the result is that of the rules."""
    rng = random.Random(5)
    parts = ["https:", "http:", "HTTP:", "ftp:", "/", "/", "//", "h", "b.c", "..", ".d", "?", "#", "$x", "$", " ", "\n", "\u00a0", "\u3000", "\ufdd1", "é"]
    regular = ["https://h/a/b?c//$d", "https://h", "/a", "/", "/a/b/", "http://h/a b/#"]
    odd = [None, "", "  ", " https://h/a", "/a\u00a0", "//h/a", "/.a/../b", "/a/.", "https://h/a$x", "a/b", "https://", "/a/b" * 20000, "https://h" + "/a" * 20000 + "/.."]
    mixed = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(2000)]
    df = spark.createDataFrame([(u,) for u in regular * 2 + odd * 2 + mixed], "u string")
    for origin in (ORIGIN, "HTTPS://Docs.example.com/x", "ftp://h$0"):
        slow = lambda v: U._absolute(v, origin)  # noqa: E731, B023
        left = F.coalesce(slow(U.remove_variables("u")), F.when(F.col("u").isNotNull(), F.lit("")))
        same = U.absolute_url("u", origin).eqNullSafe(slow(F.col("u"))) & U.strip_vars("u", origin).eqNullSafe(left) & U.strip_vars(F.concat("u"), origin).eqNullSafe(left)
        assert df.filter(~same).collect() == []
    assert df.filter(F.col("u").isin(regular) & ~F.col("u").rlike(U._REGULAR)).count() == 0
    assert df.filter(F.col("u").isin(odd[1:]) & F.col("u").rlike(U._REGULAR)).collect() == df.filter(F.col("u") == odd[11]).collect()
    plan = df.select(U.absolute_url("u", ORIGIN).alias("a"), U.strip_vars("u", ORIGIN).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count(U._REGULAR) == 2


def test_strip_vars(apply):
    cases = {
        "https://h/a$is_args$args": "https://h/a/",
        "/a/$var/b": ORIGIN + "/a/b/",
        "https://h//a": "https://h/a/",
        "$x": "",
        None: None,
    }
    assert dict(zip(cases, apply(list(cases), lambda c: U.strip_vars(c, ORIGIN)))) == cases


def test_clean_target(apply):
    assert apply(["  \"/new//x$is_args$args\" ", "'/y/$1'"], U.clean_target) == ["/new/x", "/y/"]


def test_resolve_url_agrees_with_the_standard_library(apply):
    bases = ["https://h/x/y", "https://h/x/y/", "https://h", "http://h/a/b?q=1#f", "https://h/x//y", "https://h/a/b/c/d.html"]
    refs = [
        "../z", "./z", "/z", "//g/z", "?q", "#f", "../../../z", "", "a", "a/b/../c", ".", "..", "/a/./b/..",
        "https:foo", "mailto:x", "http://o/p/../q", "g;x=1/../y", "a//b", "g?y/../x", "x.png#top", "../../a/",
    ]
    pairs = [(b, r) for b in bases for r in refs]
    assert apply(pairs, U.resolve_url) == [urljoin(*p) for p in pairs]


def test_webpage_and_subpath(apply):
    pages = {"https://h/a": True, "https://h/a.png": False, "https://h/a.PNG": True, "https://h/a.png/": True, "https://h/a.js?v=1": False, "https://h/a.md": True}
    assert dict(zip(pages, apply(list(pages), U.is_webpage))) == pages
    base = "https://h/docs/"
    below = {"https://h/docs/x": True, "https://h/docs": False, "https://h/docs-old/x": False, "http://h/docs/x": True, "https://h:1/docs/x": False}
    assert dict(zip(below, apply(list(below), lambda c: U.is_strict_subpath(F.lit(base), c)))) == below


def test_paths(apply):
    assert apply(["/home/me/repo/content/a/b.md"], lambda c: U.repo_content_path(c, "/home/me/repo/content/")) == ["/repo/content/a/b.md"]
    assert apply(["xml/en/docs/a.xml"], lambda c: U.xml_public_link(c, "https://s")) == ["https://s/en/docs/a.html"]
    assert apply(["/x/content/a", "/x/a"], U.content_path) == ["/content/a", None]
    assert apply(["/r/a", "/r/a/"], lambda c: U.strip_trailing_slash(c)) == ["/r/a", "/r/a"]
    assert apply(["/a/_index.md", "_index.MD", "/a/b.md"], lambda c: U.page_url(F.lit("https://s"), F.col(c))) == [
        "https://s/a/", "https://s/", "https://s/a/b/"
    ]


def test_long_and_upper_case_schemes(apply):
    long = "abcdefghijklmnopqrstuvwxyzabcdefghij"
    cases = {f"{long}://host/a//b": f"{long}://host/a/b/", "FTP://h/a": "ftp://h/a/", "HTTPS://H/A//b": "https://H/A/b/", "http://h/a://b": "http://h/a:/b/"}
    assert dict(zip(cases, apply(list(cases), U.normalize_url))) == cases


def test_paths_outside_the_root(apply):
    assert apply(["/repo/content/a/b.md", "/home/me/repo/content/x.md"], lambda c: U.relative_path(c, "/home/me/repo/content")) == ["../../../../repo/content/a/b.md", "x.md"]
    assert apply(["/home/me/repo/contents/x.md", "/home/you/x.md"], lambda c: U.relative_path(c, "/home/me/repo/content/")) == ["../contents/x.md", "../../../you/x.md"]
    assert apply(["/data/content/x.md"], lambda c: U.relative_path(c, "file:///data/content")) == ["x.md"]
