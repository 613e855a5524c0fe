import numpy as np
from pyspark.sql import functions as F

from contentlake.llm.mixing import mix_sources, mixed_documents, permute, plan_slots, targets, words_taken
from contentlake.llm.tables import n_words

from .helpers import SCHEMA, awkward


def test_permutation_is_one_to_one_and_invertible():
    for n in (1, 2, 3, 17, 64, 1000):
        there = permute(np.arange(n), n, 99)
        assert sorted(there) == list(range(n))
        assert (permute(there, n, 99, inverse=True) == np.arange(n)).all()


def test_targets_fill_up():
    assert targets([100, 100, 100], [5, 2, 1], 1.5, 2) == [200.0, 200 * 250 / 300, 250 / 3]
    assert targets([0, 10], [5, 2], 1.5, 2) == [0.0, 15.0]
    assert targets([], [], 1.5, 2) == [] and targets([0], [1], 1.5, 2) == [0.0]


def test_slots_reach_the_target_to_the_word():
    rng = np.random.default_rng(2)
    for _ in range(200):
        words, size = int(rng.integers(1, 400)), int(rng.integers(1, 40))
        target = float(rng.uniform(0, 2 * words))
        blocks, slots, last = plan_slots(words, target, size, 5)
        length = np.full(blocks, size)
        length[-1] = words - (blocks - 1) * size
        total = 0
        for j in range(slots):
            block = int(permute(np.array([j % blocks]), blocks, 5 + j // blocks)[0])
            total += last if j == slots - 1 else length[block]
            assert j < slots - 1 or last <= length[block]
        assert total == int(round(target))


def taken(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return words_taken(*mix_sources(df, F.col("size"), F.col("source"), **how)).select("doc.doc_id", "size", "source", "source_size", "target", "taken").toPandas()


def test_sources_meet_targets_and_documents_their_bound(spark):
    rows = awkward()
    got = taken(spark, rows, block_words=16)
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg(size=("size", "sum"), known=("source_size", "max"), target=("target", "max"), taken=("taken", "sum"))
    assert (per["size"] == per.known).all() and (abs(per.taken - per.target) <= 0.5).all()
    assert abs(got.taken.sum() - 1.5 * got["size"].sum()) <= 3
    again = taken(spark, rows[::-1], block_words=16)
    assert sorted(map(str, again.values.tolist())) == sorted(map(str, got.values.tolist()))


def test_empty_and_wordless(spark):
    assert len(taken(spark, [])) == 0
    got = taken(spark, [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, " ", None, None, 0)])
    assert got.taken.tolist() == [0, 0, 0]


def test_mixed_documents_hold_the_taken_words(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("clash"))
    got = mixed_documents(df, block_words=16).toPandas()
    assert list(got.columns) == df.columns
    words = sum(len((t or "").split()) for t in got.text)
    total = sum(len([w for w in (r[1] or "").replace(" ", "x").replace(" ", "x").split()]) for r in rows)
    assert abs(words - 1.5 * total) < 0.05 * total
    texts = {r[1] for r in rows}
    assert sum(t in texts for t in got.text) > 0
    for t in got.text[:40]:
        own = set(t.split())
        assert any(own <= set((x or "").split()) for x in texts)
