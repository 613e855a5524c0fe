"""The conversation trie against plain dictionaries, over one and many shards, and awkward rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from contentlake.llm import prefix_trie as T

SCHEMA = "conv_id long, turn int, role string, text string"


def plain_nodes(paths):
    """paths: conv_id -> list of (number, words)."""
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    out = {}
    for key, members in nodes.items():
        below = {k: m for k, m in nodes.items() if k[: len(key)] == key}
        ends = sorted(c for c in members if len(paths[c]) == len(key))
        out[key] = (
            min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), sum(len(k) == len(key) + 1 for k in below),
            sum(not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below) for k in below),
            sum((len(m) - 1) * (k[-1][1] if k else 0) for k, m in below.items()), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(map(str, out.values()))


def texts_of(rows, heads=True):
    """The contract's rebuilt conversations, spelled out; each turn is ((role, text), words)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, mark), ((role, text), len(text.encode().split()))))
    own = {c: [t for _, t in sorted(x, key=lambda p: p[0])] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if heads else 0
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def nodes_of(spark, rows, shard_turns=T.SHARD_TURNS, heads=True):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("number", F.lit("x")).withColumn("path", F.lit(1))
    found = T.conversation_arrays(T.encoded_turns(df))
    if heads:
        c = F.col("conv_id")
        found = T.borrowed_heads(found, F.crc32(c.cast("string").cast("binary")) % 4, c - c % 20, 3)
    return sorted(str(tuple(r)) for r in T.prefix_nodes(T.distinct_sequences(found), shard_turns).collect())


def talk(seed, n=120, kinds=4, most=7):
    """Conversations that share heads, some equal, with nulls and repeated turns."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.randrange(1, most)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(["", None, *(f"say {k} " * k for k in range(kinds))])))
    rows += [(5000 + i, t, "system", f"you are {t}") for i in range(60) for t in range(1 + i % 3)]
    rows += rows[:5] + [(None, 1, "user", "lost")]
    return rows


@pytest.mark.parametrize("seed,shard_turns", [(1, T.SHARD_TURNS), (2, 20), (3, 5)])
def test_nodes_equal_plain_dictionaries(spark, seed, shard_turns):
    rows = talk(seed)
    assert nodes_of(spark, rows, shard_turns) == plain_nodes(texts_of(rows))


def test_long_conversations_and_popular_starts(spark):
    rows = [(c, t, "user", f"w{t}") for c in range(3) for t in range(700 + c)] + [(100 + c, 0, "user", "w0") for c in range(200)]
    rows += [(400 + c, t, "user", f"w{t if t < 2 else c}") for c in range(50) for t in range(3)]
    got = nodes_of(spark, rows, 300, heads=False)
    # all conversations are prefixes or near copies of one: count the nodes instead of comparing all pairs
    paths = texts_of(rows, heads=False)
    want = {tuple(p[:d]) for p in paths.values() for d in range(len(p) + 1)}
    assert len(got) == len(want)
    small = {c: p[:4] for c, p in paths.items()}
    again = nodes_of(spark, [(c, t, role, text) for c, p in small.items() for t, ((role, text), _) in enumerate(p)], 40, heads=False)
    assert again == plain_nodes(small)


def test_shards_of_any_cut_agree():
    """Partial nodes of every cut of a sorted list of sequences add up to the nodes of one shard."""
    rng = random.Random(9)
    for _ in range(150):
        some = sorted({tuple(rng.randrange(3) for _ in range(rng.randrange(0, 5))) for _ in range(rng.randrange(1, 14))})
        rows = [{"ids": list(s), "words": [x + 1 for x in s], "members": rng.randrange(1, 4), "least": rng.randrange(100), "ends": str(i)} for i, s in enumerate(some)]
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows) + 1) for _ in range(3))})
        parts = [rows[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]

        def merged(parts):
            out = {}
            for i, part in enumerate(parts):
                got = T.shard_nodes(part, parts[i - 1][-1] if i else None, parts[i + 1][0] if i + 1 < len(parts) else None)
                for k in range(len(got["depth"])):
                    r = {c: v[k] for c, v in got.items()}
                    # inner nodes are final: they must not meet another part
                    key = (r["key"] or (i, k), r["depth"])
                    old = out.get(key)
                    if old is None:
                        out[key] = r
                    else:
                        for c in ("n_convs", "n_children", "n_leaves", "n_words", "new_words"):
                            old[c] += r[c]
                        old["conv_id"] = min(old["conv_id"], r["conv_id"])
                        old["ends"] = old["ends"] or r["ends"]
            return sorted((r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["n_words"] - r["new_words"], str(r["ends"])) for r in out.values())

        assert merged(parts) == merged([rows])


def test_search_tree_is_balanced():
    tree, n = T.SearchTree(), 1000
    for i in T.median_order(n):
        tree.insert([i], [1])
    deepest, at = 0, [(tree.same[0], 1)]
    while at:
        node, depth = at.pop()
        deepest = max(deepest, depth)
        at += [(c, depth + 1) for c in (tree.low[node], tree.high[node]) if c >= 0]
    assert sorted(T.median_order(n)) == list(range(n)) and deepest == 10


def test_empty_and_turnless(spark):
    assert nodes_of(spark, []) == [] and nodes_of(spark, [(None, 1, "a", "b")]) == []
    # a conversation that loses its only turn to an absent base ends at the root
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    assert nodes_of(spark, [(c, 0, "user", "hi")]) == [str((c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest()))]


def test_many_members_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(T, "ID_BLOCK", 16)
    rows = [(c, 0, "user", "hello") for c in range(-40, 400)]
    got = nodes_of(spark, rows, heads=False)
    assert got == plain_nodes(texts_of(rows, heads=False))
