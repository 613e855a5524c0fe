"""The archive searches the part of a document that can match, and reads documents no more often than needed."""

import random
import re

from contentlake.functions.common import head_and_tail
from contentlake.functions.text import strip_front_matter
from contentlake.operators import includes
from contentlake.plans.documents import archive
from contentlake.session import materialize
from pyspark.sql import functions as F

from .test_plans import plan_of

FRAGMENTS = {"f.md": "in <!-- open\n", "g.md": 'one\n{{< versions "2" >}}\ntwo >}}', "h.md": "h --> {{< rel"}
TOKENS = [
    "---", "---\n", "\n---\n", "\n", "\n", "--", "->", "-", ">", "}", ">}", "\r", "x", " ", "é ", "𝄞 y\n", "<!--", "-->", "<!-- c -->", "{{<", "{{< rel",
    'ref "/s/b.md" >}}', '{{< relref\n"/s/b.md" >}}', '{{< versions "1" >}}', *[f'{{{{< include "/{name}" >}}}}' for name in [*FRAGMENTS, "gone.md"]],
]
INCLUDE = r"""\{\{<[^\S\n]*include[^\S\n]*["']/([^"'\n]+)["'][^\S\n]*>\}\}"""
VERSIONS = r"(?m)^[^\n]*?\{\{<[^\S\n]*versions[^\S\n]+[^\n]*?>\}\}[^\n]*(?:\n|\Z)"


def texts():
    draw = random.Random(11)
    return ["", "no mark\n", "last line >}}", "--", "---\nopen\n\nrest\n"] + ["".join(draw.choices(TOKENS, k=draw.randint(1, 14))) for _ in range(600)]


def stripped(text):
    return "".join(re.split(r"(?m)^[^\S\n]*---[^\S\n]*(?:\n|\Z)", text)[::2])


def archived(text, compat):
    """All steps over the whole text."""
    if compat:
        filled = re.sub(INCLUDE, lambda m: FRAGMENTS.get(m[1], "").replace("\n", "﷐"), stripped(text))
        kept = [line for line in filled.split("\n") if not re.search(VERSIONS, line.replace("﷐", "\n"))]
        # without an include nothing is expanded, and no line dropped
        text = "\n".join(kept).replace("﷐", "\n") if re.search(INCLUDE, stripped(text)) else filled
    else:
        text = re.sub(VERSIONS, "", re.sub(INCLUDE, lambda m: FRAGMENTS.get(m[1], ""), stripped(text)))
    text = re.sub(r"(?s)<!--.*?-->", "", text)
    return re.sub(r"""\{\{<\s*relref\s*["']([^"']+)["']\s*>\}\}""", "b.md", text)


def test_head_and_tail_are_the_text(apply):
    given = ["a\n---b\nc\nd", "a >}} b -- c", "é >}}\n𝄞\n", "--\n>}}\n", "x\n", "", None]
    out = apply(given, lambda c: head_and_tail(F.col(c), ["--", ">}}"]))
    assert [o and (o["head"], o["tail"]) for o in out] == [
        ("a\n---b\n", "c\nd"), ("a >}} b -- c", ""), ("é >}}\n", "𝄞\n"), ("--\n>}}\n", ""), ("", "x\n"), ("", ""), (None, None),
    ]


def test_front_matter_is_stripped_as_from_the_whole_text(apply):
    given = texts()
    assert apply(given + [None], strip_front_matter) == [stripped(t) for t in given] + [None]


def test_archive_equals_all_steps_over_the_whole_text(spark):
    given = texts()
    docs = spark.createDataFrame([(f"/r/s/{i}.md", t) for i, t in enumerate(given)], "path string, content string")
    fragments = spark.createDataFrame(list(FRAGMENTS.items()), "include_path string, content string")
    for compat in (False, True):
        got = {r["path"]: r["archived"] for r in archive(docs, fragments, "/r", compat=compat).collect()}
        wrong = [(t, got[f"/r/s/{i}.md"], archived(t, compat)) for i, t in enumerate(given) if got[f"/r/s/{i}.md"] != archived(t, compat)]
        assert not wrong, (compat, len(wrong), wrong[:3])


def test_documents_are_read_three_times_when_fragments_are_no_broadcast(spark, tmp_path, monkeypatch):
    """Once for the references, which are stored, once for the texts with and once for those without any."""
    docs_at, plans, key = str(tmp_path / "docs"), [], "spark.sql.maxMetadataStringLength"
    rows = [(f"/r/s/{i}.md", '{{< include "a.md" >}}\n' if i % 2 else "plain\n") for i in range(20)]
    spark.createDataFrame(rows, "path string, content string").write.parquet(docs_at)
    fragments_at = str(tmp_path / "fragments")
    spark.createDataFrame([("a.md", 'a {{< include "b.md" >}}'), ("b.md", "b")], "include_path string, content string").write.parquet(fragments_at)

    def noted(df, label):
        plans.append(plan_of(df))
        return materialize(df, label)

    for module in ("contentlake.operators.includes", "contentlake.operators.skew"):
        monkeypatch.setattr(f"{module}.materialize", noted)
    monkeypatch.setattr(includes, "known_bytes", lambda *parts: 1 << 40)
    shown = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        out = archive(spark.read.parquet(docs_at), spark.read.parquet(fragments_at), "/r")
        plans.append(plan_of(out))
    finally:
        spark.conf.set(key, shown)
    assert sum(plan.count(f"[file:{docs_at}]") for plan in plans) == 3
    assert sum(plan.count(f"[file:{fragments_at}]") for plan in plans) == 1
    assert sorted(r["archived"] for r in out.collect()) == ["a b\n"] * 10 + ["plain\n"] * 10
