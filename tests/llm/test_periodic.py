"""Runs of words: the automaton against a plain search, and awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from contentlake.llm import periodic, queries

from .helpers import SCHEMA, awkward


def plain_runs(words, least=6, exponent=4):
    n, out = len(words), []
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            smaller = any(p % d == 0 and all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, p))
            if length >= max(least, exponent * p) and not smaller:
                out.append((i, length, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def noisy(rng):
    """Words of a small alphabet with repeated pieces."""
    words = [rng.randrange(rng.choice([1, 2, 3, 5, 40])) for _ in range(rng.randrange(0, 80))]
    for _ in range(rng.randrange(4)):
        a, times = rng.randrange(len(words) + 1), rng.randrange(2, 9)
        piece = words[a : a + rng.randrange(1, 7)]
        words[a : a + rng.choice([0, len(piece) * times])] = piece * times
    return words


def test_runs_equal_plain_search():
    rng = random.Random(5)
    for _ in range(4000):
        words = noisy(rng)
        assert periodic.periodic_runs(np.array(words, np.int64)) == plain_runs(words)
        assert periodic.periodic_runs(np.array(words, np.int64), 5, 3) == plain_runs(words, 5, 3)


def test_automaton_finds_all_squares():
    """Without the search for stretches, and down to two periods."""
    rng = random.Random(6)
    for _ in range(1500):
        words = noisy(rng)
        assert sorted(periodic.runs_in(words, 2, 2), key=lambda r: (r[0], r[2])) == plain_runs(words, 2, 2)


def test_long_runs():
    piece = list(range(5000))
    words = np.array([-1 + 10**6, *piece * 5, 10**6], np.int64)
    assert periodic.periodic_runs(words) == [(1, 25000, 5000)]
    assert periodic.periodic_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]


def test_two_copies_far_apart_hold_no_run():
    piece = list(range(100))
    assert list(periodic.stretches(np.array(piece + [200, 201] + piece, np.int64))) == []


def told(doc_id, text):
    """The contract's columns, spelled out."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    if doc_id is not None and h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_digests_of_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] != 1007]
    rows += [(2000 + i, "la " * i + "lo " + "ü x y " * (i % 7), None, None, None) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "told")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = periodic.run_digests(df, F.col("text"), crc, "found").select("doc_id", "found.*").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(told(r[0], r[1])) for r in rows)
    assert periodic.run_digests(spark.createDataFrame([], SCHEMA), F.col("text"), crc).count() == 0


def test_collapsed_texts(spark):
    rows = [(1, "a b a b a b a b c"), (2, None), (3, "x  y\tz"), (4, "no " * 50_000 + "end")]
    df = spark.createDataFrame(rows, "made long, text string").withColumn("Runs", F.lit(7))
    got = {r["made"]: r for r in periodic.with_runs(df).collect()}
    assert [got[k]["collapsed"] for k in (1, 2, 3, 4)] == ["a b c", "", "x y z", "no end"]
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 8, 2)] and got[4]["runs"][0]["length"] == 50_000
    with pytest.raises(ValueError):
        periodic.with_runs(df, least=4)


def test_query_equals_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = [told(r["doc_id"], r["text"]) for r in docs if len(r["text"] or "") < 15_000]
    got = {r["doc_id"]: tuple(r) for r in queries.op11_runs(spark, sf).collect()}
    assert len(got) == len(docs)
    assert all(got[w[0]] == w for w in want)
