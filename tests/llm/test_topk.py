import numpy as np

from contentlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    scaled = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and usable(v) and v]
    out = []
    for q in sorted({i for i, _ in scaled if queries(i)}):
        vector = min(v for i, v in scaled if i == q)
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in scaled if i != q and len(v) == len(vector))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return out


def found(spark, rows, k, monkeypatch=None):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = topk.top_k(df, df.filter("vec_id % 5 = 0"), k)
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force_with_ties_and_gaps(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 8]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 260)]  # many ties
    rows += [(300, None), (305, [0.1, None, 0.2, 0.3]), (310, [float("nan")] * 4), (315, [float("inf"), 0.0, 0.0, 0.0]), (320, [1.0, 2.0]), (321, [3.0, 1.0]), (None, [1.0] * 4), (325, []), (10, [0.25] * 4)]
    assert found(spark, rows, 6) == sorted(brute(rows, lambda i: i % 5 == 0, 6))


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert found(spark, rows, 10) == [(0, 1, 1, 512 * 1024)]
    assert found(spark, [], 10) == []
    assert found(spark, [(0, [1.0])], 10) == []


def test_products_stay_exact():
    a = np.array([[2**52, 3], [2**30, -(2**30)]], np.int64)
    assert topk.products(a, a)[1, 1] == 2**61
    assert topk.products(a, a)[0, 0] == 2**63 - 1
