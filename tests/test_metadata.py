import pytest
import yaml
from pyspark.sql import functions as F

from contentlake.functions import metadata as M
from contentlake.plans.documents import rewritten

DOCS = ["---\na: 1\n---\nbody", "x---\nb: 2\n---\nc", "---\nopen\nx", "---\na: b---c\n---\nz", "---\n---\n", "plain"]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("lines", ["a: 1\n", None, "open\nx", "a: b---c\n", "", None]),
        ("strict", ["\na: 1\n", None, None, "\na: b", "\n", None]),
        ("loose", ["\na: 1\n", "\nb: 2\n", None, "\na: b", "\n", None]),
    ],
)
def test_split_front_matter(apply, mode, expected):
    assert apply(DOCS, lambda c: M.split_front_matter(c, mode)["yaml"]) == expected


def test_split_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        M.split_front_matter("c", "other")


def test_parse_isolates_errors(apply):
    blocks = ["a: 1\nb: [x, 2]\nd: hello\ne:\n", "a: [", "- x", "", "d: 2024-01-02T03:00:00+05:00", None]
    got = apply(blocks, M.parse_front_matter)
    assert [g["kind"] for g in got] == ["map", "error", "other", "empty", "map", None]
    assert got[0]["data"] == {"a": "1", "b": '["x", 2]', "d": '"hello"', "e": "null"}
    assert got[4]["data"] == {"d": '"2024-01-02 03:00:00"'}


def test_flat_front_matter(apply):
    assert apply(["a: 1\nb: x: y\na: 3\n# c: d\ne:"], M.flat_front_matter) == [{"a": "3", "b": "x: y", "e": ""}]


def _types(apply, blocks, pick):
    return apply(blocks, lambda c: pick(M.parse_front_matter(c)["data"]))


def test_merge_and_filter_types(apply):
    blocks = ["categories: task\ndoctypes: [concepts, reference, zzz]", "doctypes: 5", "title: x", "categories: null", "type: how-to"]
    assert _types(apply, blocks, M.merge_types) == [["how-to", "concept", "reference", "zzz"], [], None, None, None]
    assert _types(apply, blocks[:1], lambda d: M.filter_types(M.merge_types(d))[0]) == [["how-to", "concept", "reference"]]
    assert _types(apply, blocks[:1], lambda d: M.filter_types(M.merge_types(d))[1]) == [["zzz"]]


def test_drop_keys_reports_in_list_order(apply):
    blocks = ["versions: 1\naliases: x\ntitle: t\ndate: 2024-01-01"]
    assert _types(apply, blocks, lambda d: M.drop_keys(d)[1]) == [["aliases", "date", "versions"]]
    assert _types(apply, blocks, lambda d: F.map_keys(M.drop_keys(d)[0])) == [["title"]]


def test_values(apply):
    block = ['docs: DOCS-1\nn: 12\nl: [a, b]\ns: "q \\" x"\nz: null']
    for key, text in [("docs", "DOCS-1"), ("n", "12"), ("l", '["a", "b"]'), ("s", 'q " x'), ("z", None), ("no", None)]:
        assert _types(apply, block, lambda d, key=key: M.text_value(d, key)) == [text]
    assert _types(apply, ["docs: ' '", "docs: null", "docs: 7", "x: 1"], M.doc_id) == ["null", "null", "7", "null"]


def test_status(apply):
    docs = ["plain", "---\n---\n", "---\na: 1\n---\n", "---\na: [\n---\n", "---\n- x\n---\n", "---\nopen"]
    got = apply(docs, lambda c: M.audit_status(M.parse_front_matter(M.audited_block(c))["kind"]))
    assert got == [M.NO_METADATA, M.NO_METADATA, "ok", M.BAD_METADATA, M.BAD_METADATA, M.BAD_METADATA]


def test_rewrite(spark):
    doc = "pre\n---\ntitle: T\ntype: concept\ndescription: About x\nwhen: 2024-01-02\ntags: [a]\ncategories: tasks\n---\n\n\n  body\n"
    period = "---\ndescription: no end\n---\nb"
    odd = "---\n- list\n---\nb"
    scalar = "---\ntype: how-to\ndate: 2024-01-01\n---\nb"
    emptied = "---\ntags: x\n---\nb"
    rows = spark.createDataFrame([(1, doc), (2, period), (3, odd), (4, scalar), (5, emptied), (6, "plain")], "id int, content string")
    out = {r["id"]: r for r in rewritten(rows).collect()}
    head, block, body = out[1]["new_content"].split("---\n", 2)
    assert head == "pre\n" and body == "\nbody\n"
    loaded = yaml.safe_load(block)
    assert list(loaded) == ["title", "type", "description", "when"]
    assert loaded["type"] == ["how-to"] and loaded["description"] == "About x." and str(loaded["when"]) == "2024-01-02"
    assert out[1]["changed"] and out[1]["removed_keys"] == ["tags"]
    # a period alone is no change
    assert not out[2]["changed"] and out[2]["description_fixed"] and out[2]["new_content"] == period
    assert not out[3]["changed"] and out[3]["new_content"] == odd
    assert yaml.safe_load(out[4]["new_content"].split("---")[1]) == {"type": ["how-to"]}
    assert out[5]["new_content"] == "---\n{}\n---\n\nb"
    assert not out[6]["changed"]
