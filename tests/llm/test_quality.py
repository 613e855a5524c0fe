"""Bradley-Terry quality: held-out accuracy, the pairs, the cut, the features, and awkward rows."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contentlake.llm import quality, queries

from .helpers import SCHEMA, awkward
from .test_models import auc

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    got = queries.op12_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.score.values, held.quality.values) > 0.9
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97


def test_scores_of_awkward_rows(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "Score").withColumnRenamed("source", "features")
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)] + [(0, 1), (None, 1), (77777, 0), (1, None), (2, 5)], "doc_id long, quality int")
    scored = quality.score(df, quality.fit(df, labels))
    assert scored.columns == ["doc_id", "text", "features", "n_chars", "score"]
    got = scored.toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(0, 1), (1, 1)], 1.0), ([(0, 0)], 0.0)])
def test_without_both_classes(spark, labels, want):
    df = spark.createDataFrame(awkward(), SCHEMA)
    model = quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r.score for r in quality.score(df, model).collect()} == {want}
    assert quality.score(spark.createDataFrame([], SCHEMA), model).count() == 0


@pytest.mark.parametrize("good,bad", [(6, 4), (1, 5), (40, 3)])
def test_pairs_are_good_over_bad_and_even(spark, good, bad):
    rows = [(i, int(i < good), [float(i)]) for i in range(good + bad)]
    pairs = quality.preference_pairs(spark.createDataFrame(rows, "order long, label int, features array<double>"), 2).collect()
    seen = Counter((r.better[0], r.worse[0]) for r in pairs)
    assert len(pairs) == min(2 * max(good, bad), good * bad) == len(seen)
    assert all(x < good <= y for x, y in seen)
    for side, n in ((0, good), (1, bad)):
        uses = Counter(p[side] for p in seen)
        assert len(uses) == n and max(uses.values()) - min(uses.values()) <= 1


def test_ranking_learns_an_order(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, len(quality.FEATURES)))
    label = (x[:, 2] - 0.5 * x[:, 5] > 0).astype(int)
    rows = [(i, int(label[i]), x[i].tolist()) for i in range(300)]
    knots = np.quantile(x, quality.KNOTS, axis=0)
    model = quality.Model(knots=knots)
    model.weights = quality.rank(quality.preference_pairs(spark.createDataFrame(rows, "order long, label int, features array<double>")), knots)
    assert auc(model.worth(x), label) > 0.98


def test_cut_disagrees_least():
    worth, label = np.arange(100.0), (np.arange(100) >= 30).astype(int)
    label[[5, 70]] = 1, 0  # two odd labels
    assert np.isclose(quality.cut_by_quantile(worth, worth, label), np.quantile(worth, 0.3), atol=1)
    assert quality.cut_by_quantile(worth, worth, np.ones(100, int)) == 0


def plain_features(text):
    words = text.lower().split() if text.isascii() else None
    raw = text.encode()
    solid = [c for c in raw if c not in b" \t\n\r\x0b\x0c"]
    lines = [line.split() for line in text.lower().split("\n") if line.split()]
    triples = Counter(zip(words, words[1:], words[2:]))
    same = Counter(map(tuple, lines))
    n, top = len(words), Counter(words).most_common(1)[0][1]
    return {
        "log_words": np.log1p(n), "word_bytes": sum(map(len, words)) / n / 10, "log_longest": np.log1p(max(map(len, words))) / 5,
        "letters": sum(chr(c).isalpha() for c in solid) / len(solid), "digits": sum(chr(c).isdigit() for c in solid) / len(solid),
        "exclamations": raw.count(b"!") / n, "stops": raw.count(b".") / n, "lines": raw.count(b"\n") / n,
        "short_lines": sum(len(x) < 3 for x in lines) / len(lines), "open_lines": sum(x[-1][-1] not in ".!?" for x in lines) / len(lines),
        "repeated_lines": sum(v for v in same.values() if v > 1) / len(lines), "distinct": len(set(words)) / n, "top_word": top / n,
        "repeated_triples": sum(v for v in triples.values() if v > 1) / n, "signs_only": sum(set(w) <= set("|$%") for w in words) / n,
    }


def test_features_equal_plain_counts():
    texts = ["One two. Three | four |\nOne two!\n\nABC DEF ghi1 $$$ a%b\none two!", "x", "same same same same same\nsame", "A B.\n" * 4000, "word"]
    got = quality.features_of(pa.array([*texts, "", None, " \n "]))
    for row, text in zip(got, texts):
        for name, value in plain_features(text).items():
            assert np.isclose(row[quality.FEATURES.index(name)], value), (name, text[:20])
    assert (got[len(texts) :] == 0).all()
    assert np.allclose(quality.features_of(pa.array(texts * 50 + ["w " * 400_000]))[:5], got[:5])


def test_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, "some text", 3)], "doc_id long, text string, `a.b` int")
    model = quality.Model(weights=np.zeros((len(quality.KNOTS) + 1) * len(quality.FEATURES)))
    got = quality.score(df, model)
    assert got.columns == ["doc_id", "text", "a.b", "score"] and got.first()["score"] == 0.5
    assert got.filter(F.col("score").isNull()).count() == 0
