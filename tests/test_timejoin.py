"""As-of and interval joins and redirect chains against plain loops, with hot keys over many blocks."""

import random

import pytest

from contentlake.operators import prefix, timejoin
from contentlake.operators.timejoin import asof_join, interval_join


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(3)
    when = lambda: rng.choice([None] + [rng.randrange(50) for _ in range(9)])
    left = [(i, rng.choice(["a", "a", "a", "b", "c", None]), when()) for i in range(400)]
    right = [(rng.choice(["a", "a", "b", "d", None]), when(), rng.randrange(1000)) for _ in range(120)]
    return left, right


@pytest.mark.parametrize("strictly,block", [(False, 10**6), (True, 30), (False, 30)])
def test_asof_equals_plain_search(spark, sides, strictly, block):
    left, right = sides
    found = asof_join(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, u int, v int"), ["k"], "t", "u", ["v"], strictly, block)
    assert found.columns == ["id", "k", "t", "v"]
    want = {}
    for i, k, t in left:
        before = [(u, v) for key, u, v in right if None not in (key, u, t) and key == k and (u < t if strictly else u <= t)]
        want[i] = (k, t, max(before)[1] if before else None)
    assert {r["id"]: (r["k"], r["t"], r["v"]) for r in found.collect()} == want


def test_asof_of_many_equal_rows(spark):
    """One key and one time for all rows; blocks of ten."""
    left = spark.createDataFrame([(i, "k", 5) for i in range(200)], "id int, k string, t int")
    right = spark.createDataFrame([("k", 5, 7), ("k", 5, 9), ("k", 4, 99)], "k string, t int, v int")
    assert {r["v"] for r in asof_join(left, right, ["k"], "t", "t", ["v"], False, 10).collect()} == {9}
    assert {r["v"] for r in asof_join(left, right, ["k"], "t", "t", ["v"], True, 10).collect()} == {99}
    assert asof_join(left, right.limit(0), ["k"], "t", "t", ["v"]).filter("v is null").count() == 200
    assert asof_join(left.limit(0), right, ["k"], "t", "t", ["v"]).count() == 0


def test_intervals_equal_plain_search(spark, sides):
    left, _ = sides
    rng = random.Random(4)
    spans = [(rng.choice("ab"), s, rng.choice([None, s + rng.randrange(-3, 40), s + 1]), n) for n in range(80) for s in [rng.randrange(-20, 70)]]
    points = spark.createDataFrame(left, "id int, k string, t int")
    intervals = spark.createDataFrame(spans, "k string, s int, e int, n int")
    found = interval_join(points, intervals, ["k"], "t", "s", "e")
    assert found.columns == ["id", "k", "t", "s", "e", "n"]
    want = sorted((i, n) for i, k, t in left for key, s, e, n in spans if k == key and t is not None and s <= t and (e is None or t < e))
    assert sorted((r["id"], r["n"]) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(points.limit(0), intervals, ["k"], "t", "s", "e").count() == 0
    assert interval_join(points, intervals.limit(0), ["k"], "t", "s", "e").count() == 0


def test_chains(spark, monkeypatch):
    rules = [(f"a{i}", f"a{i + 1}") for i in range(1000)] + [("b", "a990"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("s", "s"), ("n", None)]
    rounds = []
    once = prefix.materialize
    monkeypatch.setattr(prefix, "materialize", lambda df, label: rounds.append(label) or once(df, label))
    got = {r["prefix"]: (r["target"], r["hops"], r["cyclic"]) for r in prefix.chain_targets(spark.createDataFrame(rules, "prefix string, target string")).collect()}
    assert len(got) == len(rules) and len(rounds) - 1 <= 12
    assert got["a0"] == ("a1000", 1000, False) and got["a999"] == ("a1000", 1, False) and got["b"] == ("a1000", 11, False) and got["n"] == (None, 1, False)
    assert {p for p, v in got.items() if v[2]} == {"w", "x", "y", "z", "s"} and got["w"] == ("x", None, True)
    assert prefix.chain_targets(spark.createDataFrame([], "prefix string, target string")).count() == 0


@pytest.mark.parametrize("few", [0, 20, 64])
def test_intervals_of_few_and_crowded_keys(spark, few, monkeypatch):
    """Null keys and numbers, repeated rows, empty and open intervals; all keys crowded, some, and none. Points are sliced above 50 of a key."""
    monkeypatch.setattr(timejoin, "HOT_POINTS", 50)
    monkeypatch.setattr(timejoin, "known_bytes", lambda df: 1 << 40)  # no broadcast
    rng = random.Random(6)
    points = [(i % 300, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *range(50)])) for i in range(400)]
    spans = [(k, s, rng.choice([None, s, s - 2, s + 1, s + rng.randrange(40)]), n % 70) for k, m in (("a", 20), ("b", 60), ("d", 5), (None, 5)) for n in range(m) for s in [rng.randrange(-20, 70)]]
    spans += spans[:10] + [("a", None, 5, 1)]
    left, right = spark.createDataFrame(points, "id int, k string, t int"), spark.createDataFrame(spans, "k string, s int, e int, n int")
    found = interval_join(left, right, ["k"], "t", "s", "e", few)
    want = sorted((i, n) for i, k, t in points for key, s, e, n in spans if None not in (k, t, s) and k == key and s <= t and (e is None or t < e))
    assert sorted((r["id"], r["n"]) for r in found.collect()) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("_cell" in plan) == (few < 64) and "_slice" in plan


def test_few_intervals_and_points_are_sent_once(spark, monkeypatch):
    """By the key alone: no row is copied for levels or cells, and no key is counted when all points are few."""
    monkeypatch.setattr(timejoin, "known_bytes", lambda df: 1 << 40)
    left = spark.createDataFrame([(i, "k", i) for i in range(100)], "id int, k string, t int")
    found = interval_join(left, spark.createDataFrame([("k", 0, 97, 7), ("k", 50, None, 8)], "k string, s int, e int, n int"), ["k"], "t", "s", "e")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 147 and "Generate" not in plan and "_level" not in plan and "_slice" not in plan
