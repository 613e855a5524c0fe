import random
import re

import pytest

from contentlake.llm import jaccard_join
from contentlake.llm.components import components
from contentlake.llm.jaccard_join import keep_one, similar_documents

from .helpers import SCHEMA, awkward, edited, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted((str(r[0]), len(sets[i]), str(least.get(root(i)) if sets[i] else r[0]), links[i]) for i, r in enumerate(rows))


def found(spark, rows):
    got = similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted((str(r["key"]), r["n_shingles"], str(r["component_id"]), r["n_links"]) for r in got)


def test_equals_all_pairs(spark):
    rows = awkward()
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("hot,block", [(2, 4), (512, 4), (3, 256)])
def test_hot_tokens_and_large_clusters(spark, monkeypatch, hot, block):
    """A passage in all documents, many near copies of one text, sets at exactly 80 %."""
    monkeypatch.setattr(jaccard_join, "HOT_GROUPS", hot)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(hot)
    passage, base = prose(rng, 30), prose(rng, 100)
    rows = [(i, prose(rng, rng.randrange(5, 60)) + " " + passage, "en", "a", 1) for i in range(25)]
    rows += [(100 + i, edited(rng, base, rng.randrange(0, 5)), "en", "a", 1) for i in range(40)]
    rows += [(200 + i, edited(rng, passage, rng.randrange(0, 2)), "en", "a", 1) for i in range(12)]
    tokens = [f"t{i}" for i in range(13)]
    rows += [(300, " ".join(tokens), "", "", 1), (301, " ".join(tokens[:-1]), "", "", 1), (302, " ".join(tokens[:9]), "", "", 1), (303, " ".join(tokens[1:-1] + ["z"]), "", "", 1)]
    assert found(spark, rows) == brute(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, None, "", "", 1), (4, " ", "", "", 1)]) == [("3", 0, "3", 0), ("4", 0, "4", 0)]


def test_keep_one_keeps_one_of_each_group(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "s1").withColumnRenamed("source", "k")
    got = keep_one(df)
    assert got.columns == df.columns
    want = brute(rows)
    first = {c for i, n, c, _ in want if n and c == i}
    assert sorted(str(r["doc_id"]) for r in got.collect() if shingles(r["text"])) == sorted(first)
    assert sum(not shingles(r["text"]) for r in got.collect()) == sum(not shingles(r[1]) for r in rows)


def test_keep_one_of_repeated_and_null_ids(spark):
    """The smallest id in two near copies; groups without any id; an id in two unlike groups; equal rows."""
    rng = random.Random(9)
    base = [prose(rng, 100) for _ in range(6)]
    near = [edited(rng, t, 1) for t in base]
    rows = [(1, base[0]), (1, near[0]), (2, base[0]), (None, base[1]), (None, near[1]), (None, base[2]), (None, near[2])]
    rows += [(7, base[3]), (7, near[3]), (7, base[4]), (None, base[5]), (9, near[5]), (9, near[5])]
    got = keep_one(spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)).collect()
    of = {t: i for i, pair in enumerate(zip(base, near)) for t in pair}
    assert sorted((of[r["text"]], str(r["doc_id"])) for r in got) == [(0, "1"), (1, "None"), (2, "None"), (3, "7"), (4, "7"), (5, "9")]


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    rng.shuffle(edges)
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["v"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root(v) for v in parent if any(v in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block,tokens", [(5, 1 << 20), (64, 600)])
def test_large_groups_of_all_kinds(spark, monkeypatch, block, tokens):
    """Blocks that are sure, blocks that are not, unlike sets of one group, a visitor of a large group."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(jaccard_join, "bands_of", lambda t: [1, 2, 3, 4] if len(t) < 700 else [5, 6, 7, 8])  # everything short is one group
    rng = random.Random(block)
    base, other = prose(rng, 300), prose(rng, 200)
    rows = [(i, edited(rng, base, 1 + i % 3), "en", "a", 1) for i in range(30)] + [(100 + i, edited(rng, other, rng.randrange(2, 9)), "en", "a", 1) for i in range(14)]
    rows += [(200 + i, prose(rng, rng.randrange(1, 250)), "en", "a", 1) for i in range(12)] + [(300 + i, base, "en", "a", 1) for i in range(3)]
    long = prose(rng, 720)
    rows += [(400 + i, " ".join(long.split()[: 690 + 5 * i]), "en", "a", 1) for i in range(7)]  # linked over the border of the two groups
    assert found(spark, rows) == brute(rows)


def test_differences_give_intersections():
    """Products of signed differences and whole sets, mixed, against sets."""
    import numpy as np

    rng = np.random.default_rng(1)
    center = set(range(100))
    sets = [center ^ set(rng.integers(0, 130, k).tolist()) for k in (0, 1, 5, 40)] + [set(rng.integers(90, 400, k).tolist()) for k in (3, 60)]
    gone = [len(center - s) for s in sets]
    told = [(sorted(center - s) + sorted(s - center), len(center - s)) if i % 2 == 0 else (sorted(s), -1) for i, s in enumerate(sets)]
    arrays = [np.array(t, np.uint64) for t, _ in told]
    kept = np.array([k for _, k in told])
    got = jaccard_join.shared(arrays, arrays, np.maximum(kept, 0), np.maximum(kept, 0))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            whole = int(kept[i] < 0) + int(kept[j] < 0)
            base = 100 - gone[i] - gone[j] if not whole else 0 if whole == 2 else 100 - (gone[i] if kept[i] < 0 else gone[j])
            assert got[i, j] + base == len(x & y)


def test_unlike_sets_of_a_large_group_are_not_compared(spark, monkeypatch, tmp_path):
    """Texts of a header and few own words fall into one group; the sets that are compared grow with the texts, not with their square."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "bands_of", lambda t: [1, 2, 3, 4])  # all are one group
    log, shared = str(tmp_path / "compared"), jaccard_join.shared

    def counted(left, right, *gone):
        with open(log, "a") as f:
            f.write(f"{len(left) + len(right)}\n")
        return shared(left, right, *gone)

    monkeypatch.setattr(jaccard_join, "shared", counted)
    rng = random.Random(4)
    header = prose(rng, 30)
    rows = [(i, header + " " + prose(rng, rng.randrange(20, 40)), "en", "a", 1) for i in range(80)]
    rows += [(100 + i, rows[i][1] + " end", "en", "a", 1) for i in range(6)] + [(200, rows[7][1], "en", "a", 1), (201, header, "en", "a", 1), (202, header + " end", "en", "a", 1)]
    assert found(spark, rows) == brute(rows)
    with open(log) as f:
        assert 0 < sum(map(int, f)) <= 4 * len(rows)
