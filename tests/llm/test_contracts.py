"""Contract columns of op1 and op4 by plain Python over the smallest tables."""

import re
import zlib
from collections import Counter

import pytest

from contentlake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_shards(spark, docs):
    got = queries.op1_shards(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        text = docs[r["doc_id"]]["text"]
        raw = None if text is None else text.encode()
        assert r["size"] == len(raw or b"") + 8 and r["text_crc32"] == (None if raw is None else zlib.crc32(raw))
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 24
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts[k] for k in range(24)) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def plain_targets(sizes):
    """Targets of sources in code point order, null last: weights 5, 2, 1, 150 % of all words, at most twice a source's words."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return {**target, **share}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix(spark, docs):
    got = queries.op4_mix(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for i, d in docs.items()}
    sizes = Counter()
    for i, d in docs.items():
        sizes[d["source"]] += words[i]
    target, taken = plain_targets(sizes), Counter()
    for r in got:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[source]
        assert abs(r["target"] - target[source]) <= 1e-6 * max(1, target[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for source, n in target.items():
        assert abs(taken[source] - n) <= max(1, 0.01 * n)
    again = {r["doc_id"]: r["taken"] for r in queries.op4_mix(spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
