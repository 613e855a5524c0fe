import os.path

from contentlake.functions import markup as K


def test_hrefs(apply):
    html = [
        '<a href="x">', "<p><A class=k href='y&amp;z'>q</A>", "<a href=foo>t</a><!-- <a href='no'> --><a data-href='q'>",
        "<script>var a='<a href=\"s\">';</script><a\nhref = \"two\nlines\" >", "", None,
    ]
    assert apply(html, K.extract_hrefs) == [["x"], ["y&amp;z"], ["foo"], ["two\nlines"], [], None]


# pages and what a browser takes as their links, made by hand from the states of the HTML standard
ODD_PAGES = {
    "<a title='a > b' href='/gt'>x</a>": ["/gt"],
    '<a href="1" href="2"><a HREF=3 ><a href = 4>': ["1", "3", "4"],
    "<a href=/x/y/><a/href=5><a href='6'class=k>": ["/x/y/", "5", "6"],
    "<!-- <a href=no> --><a href=7><!--> <a href=8> --><!-- x --!><a href=9>": ["7", "8", "9"],
    "<!-- never closed <a href=no>": [],
    "<script>if (a<b) document.write('<a href=no>')</script ><a href=10>": ["10"],
    "<SCRIPT></scripty><a href=no></SCRIPT><a href=11>": ["11"],
    "<title><a href=no></title><textarea><a href=no></textarea><a href=12>": ["12"],
    "<style>a > b { }</style><a href=13><style><a href=no>": ["13"],
    "<a href=no": [], "<a href='no>": [], '<a href="no': [], "<a ": [], "<a": [], "<": [], "a < b <a href=14>": ["14"],
    "</a href=no><a href=15></><a href=16>": ["15", "16"],
    "<a href><a href=><a href=''>": ["", "", ""],
    "<a =href=no><a data-href=no><a xhref=no><abbr href=no><area href=no>": [],
    "<!DOCTYPE html><?php <a href=17> ?><a href=18>": ["18"],
    "<a\nhref\t=\n'two\nlines'\n>": ["two\nlines"],
    "<p title=\"<a href=no>\"><a alt='\"' href=\"it's\">": ["it's"],
    "<a href=a=b&amp;c=d>é</a><A hReF='ü'>": ["a=b&amp;c=d", "ü"],
    "<plaintext><a href=no>": [],
    "x" * 300_000 + "<a " + "k=v " * 20_000 + "href=long>": ["long"],
}


def test_hrefs_of_odd_pages(apply):
    assert dict(zip(ODD_PAGES, apply(list(ODD_PAGES), K.extract_hrefs))) == ODD_PAGES


def test_long_broken_xml_is_searched_without_deep_recursion(apply):
    broken = ["<module " + "word " * 200_000, "<article title='a > b' name=\"kept\"", "<module '" + "x " * 200_000 + "<article name='late'"]
    assert apply(broken, K.xml_title) == ["", "kept", "late"]


def test_xml_title(apply):
    docs = {
        '<article name=" "><module name="m  &amp;  n"/></article>': "m & n",
        '<x:article xmlns:x="u" name="ns"/>': "ns",
        '<!DOCTYPE a SYSTEM "x.dtd"><article name="d"/>': "d",
        '<module name="broken"': "broken",
        "<doc/>": "",
        '<?xml version="1.0" encoding="UTF-8"?><doc><article id="1" name="é"/></doc>': "é",
        '<!-- <article name="no"> --><module  name=\'yes\'/>': "yes",
        "not xml": "",
    }
    assert dict(zip(docs, apply(list(docs), K.xml_title))) == docs


def test_include_refs(apply):
    line = ["a {{< include \"x/y.md\" >}} {{<include '/z.md'>}}", '{{< include "a\nb" >}}', "none"]
    assert apply(line, K.include_refs) == [["x/y.md", "/z.md"], [], []]
    assert apply(line, lambda c: K.include_refs(c, double_quotes_only=True)) == [["x/y.md"], [], []]


def test_relative_link_agrees_with_the_standard_library(apply):
    targets = ["a/b/c.md", "c.md", "a", "../q", "a/../b.md#z", "a/b", "x//y/./z"]
    folders = ["", "a", "a/b", "a/b/c", "x/y"]
    pairs = [(t, f) for t in targets for f in folders]
    assert apply(pairs, lambda t, f: K.relative_link(_c(t), _c(f))) == [os.path.relpath(t, f or ".") for t, f in pairs]


def test_relref(apply):
    rows = [("See {{< relref \"/set/a/b.md\" >}} and {{<relref 'x.md#q'>}}.", "a", "set"), ("none", "", "set"), ("{{< relref \"/other/k.md\" >}}", "", "set")]
    assert apply(rows, lambda t, f, d: K.relref_to_relative(t, f, d)) == ["See b.md and ../x.md#q.", "none", "other/k.md"]


def _c(name):
    from pyspark.sql import functions as F

    return F.col(name)
