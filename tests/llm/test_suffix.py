import hashlib
import random

import numpy as np
import pytest

from contentlake.llm import suffix_dedup
from contentlake.llm.suffix_dedup import LENGTH, digest, longest_previous_factor, remove_later, segments, with_spans

from .helpers import SCHEMA, awkward, prose


def brute(rows):
    """Spans of bytes covered by a window that occurs elsewhere."""
    seen = {}
    raws = [(r[1] or "").encode() for r in rows]
    for raw in raws:
        for i in range(len(raw) - LENGTH + 1):
            w = raw[i : i + LENGTH]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r, raw in zip(rows, raws):
        cover = np.zeros(len(raw) + 2, np.int8)
        for i in range(len(raw) - LENGTH + 1):
            if seen[raw[i : i + LENGTH]] > 1:
                cover[i + 1 : i + LENGTH + 1] = 1
        kept = bytes(b for b, c in zip(raw, cover[1:-1]) if not c)
        out.append((str(r[0]), len(raw), int(cover.sum()), int((np.diff(cover) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "spans")
    got = with_spans(df)
    got = got.select("doc_id", digest(got["text"], got["spans"]).alias("t")).select("doc_id", "t.*").collect()
    return sorted((str(r[0]), *r[1:]) for r in got)


def planted(seed, n=30):
    rng = random.Random(seed)
    passages = [prose(rng, k) for k in (30, 33, 60, 200)]
    line = "Some common line of a licence that is not two hundred bytes long at all, but long."
    rows = []
    for i in range(n):
        parts = [prose(rng, rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice([*passages, passages[3][: rng.randrange(150, 700)], line]), prose(rng, rng.randrange(0, 60))]
        rows.append((i, " ".join(parts), "en", "a", 1))
    return rows


def test_equals_all_windows(spark):
    rows = awkward() + [(5000 + r[0], *r[1:]) for r in planted(1)]
    rows += [(9000, "ab" * 400, "", "", 1), (9001, "x" * 199, "", "", 1), (9002, "y" * 200, "", "", 1), (9003, "z" * 201, "", "", 1), (9004, "ñ" * 150, "", "", 1)]
    assert found(spark, rows) == brute(rows)


def test_hot_anchors_are_split(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", 3)
    rows = planted(2, 40)
    assert found(spark, rows) == brute(rows)


def test_long_texts_are_cut_in_parts(spark):
    rng = random.Random(3)
    text = prose(rng, 150_000)
    at = 1 << 20
    rows = [(1, text, "", "", 1), (2, prose(rng, 50) + text[at - 150 : at + 150], "", "", 1)]
    assert found(spark, rows) == brute(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_remove_later_keeps_the_first(spark):
    rng = random.Random(4)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 20) + " " + passage + " " + prose(rng, 20), "", "", 1) for i in range(6)] + [(50, None, "", "", 1), (51, passage, "", "", 1), (51, passage, "", "", 1)]
    got = remove_later(spark.createDataFrame(rows, SCHEMA)).collect()
    holding = [r for r in got if passage in (r["text"] or "")]
    assert len(holding) == 1 or (len(holding) == 2 and {r["doc_id"] for r in holding} == {51})
    assert [r["text"] for r in got if r["doc_id"] == 50] == [None]


@pytest.mark.parametrize("length", [3, 8, 11, 20])
def test_longest_previous_factor(length):
    rng = np.random.default_rng(length)
    for _ in range(10):
        n = int(rng.integers(length, 90))
        data = rng.integers(97, 99, n).astype(np.uint8)
        starts = np.sort(rng.choice(n - length + 1, max(1, (n - length + 1) // 2), replace=False))

        def lcp(a, b):
            k = 0
            while k < length and data[a + k] == data[b + k]:
                k += 1
            return k

        before, after = longest_previous_factor(data, starts, length)
        assert before.tolist() == [max([lcp(s, t) for t in starts if t < s], default=0) for s in starts]
        assert after.tolist() == [max([lcp(s, t) for t in starts if t > s], default=0) for s in starts]


def test_each_window_lies_in_one_segment():
    rng = np.random.default_rng(9)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    bounds = np.array([0, 1000, 1100, 3050, 5000])
    _, _, _, start, end = segments(data, bounds)
    windows = [x for a, b in zip(start, end) for x in range(a, b - LENGTH + 1)]
    assert sorted(windows) == [x for i in range(4) for x in range(bounds[i], bounds[i + 1] - LENGTH + 1)]
