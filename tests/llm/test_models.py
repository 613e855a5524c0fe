"""Toxicity and language identification: held-out quality on the given tables, and awkward rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contentlake.llm import language_id, queries, toxicity

from .helpers import SCHEMA, awkward

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    for v in np.unique(score):
        rank[score == v] = np.flatnonzero(score[order] == v).mean() + 1
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_toxicity_on_held_out_labels(spark):
    got = queries.op5_toxicity(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.score.values, held.toxic.values) > 0.8
    assert held[held.toxic == 0].predicted.mean() < 0.03


def test_language_on_held_out_rows(spark):
    got = queries.op9_language(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    both = got.merge(docs, on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = both[both.held_out & both.lang.notna()]
    assert (held.lang_pred == held.lang).mean() > 0.95 and got.score.between(0, 1).all()


def test_scores_of_awkward_rows(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "score").withColumnRenamed("source", "features")
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)] + [(0, 1), (None, 1), (77777, 0), (1, None)], "doc_id long, toxic int")
    scored = toxicity.score(df, toxicity.fit(df, labels))
    assert scored.columns == ["doc_id", "text", "features", "n_chars", "score"]
    got = scored.toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(0, 1), (1, 1)], 1.0), ([(0, 0)], 0.0)])
def test_toxicity_without_both_classes(spark, labels, want):
    df = spark.createDataFrame(awkward(), SCHEMA)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(df, model).collect()} == {want}
    assert toxicity.score(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_features():
    known = toxicity.Words(np.sort(toxicity._hash_of(["zorgle"])), np.array([2.0]))
    texts = ["You are an 1d1.ot!", "", None, "Zorgle zorgle here " * 3, "SHOUTING WORDS ok", "nothing " * 300_000]
    got = dict(zip(toxicity.FEATURES, toxicity.features_of(pa.array(texts), known).T))
    assert got["seed_share"].tolist()[:2] == [0.25, 0] and got["near_you"][0] == 0.25
    assert got["obfuscated"][0] == 0.25 and got["hidden_hits"][0] > 0
    assert got["learned_kinds"][3] == 1 and got["learned_top"][3] == 2 and np.isclose(got["learned_sum"][3], np.log1p(12))
    assert np.isclose(got["shouting"][4], 2 / 3) and np.isclose(got["words"][5], np.log1p(300_000))
    assert (np.stack(list(got.values()))[:, 1:3] == 0).all()


def test_language_cases(spark):
    df = spark.createDataFrame(awkward() + [(1, "12 345 !!", "en", "a", 1)], SCHEMA).withColumnRenamed("source", "lang_pred")
    model = language_id.fit(df)
    got = language_id.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert letters or r["score"] == 0
    assert language_id.fit(df.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in language_id.predict(df, None).collect()} == {"und"}
    assert language_id.predict(spark.createDataFrame([], SCHEMA), model).count() == 0
    one = language_id.fit(df.withColumn("lang", F.lit("xx")))
    assert {r.lang_pred for r in language_id.predict(df, one).collect()} == {"xx", "und"}


def test_languages_of_copies_train(spark, monkeypatch):
    """Many copies of few texts; a first draw that is empty."""
    letters = {"aa": "abcdef", "bb": "ghijkl", "cc": "mnopqr"}
    texts = [(x, " ".join(c * 3 + d + str(k) for c in own for d in own)) for x, own in letters.items() for k in range(3)]
    df = spark.createDataFrame(texts, "lang string, text string")
    copies = df.crossJoin(spark.range(20_000).select()).unionByName(spark.createDataFrame([("dd", "stu vwx " * k) for k in range(1, 60)], df.schema))
    for draw in (3, 1e-9):
        monkeypatch.setattr(language_id, "DRAW", draw, raising=False)
        model = language_id.fit(copies)
        assert model.languages == ["aa", "bb", "cc", "dd"]
        assert all(r["lang_pred"] == r["lang"] for r in language_id.predict(df, model).collect())
    assert language_id.fit(df.crossJoin(spark.range(50_000).select())).languages == ["aa", "bb", "cc"]


def test_all_languages_train(spark, monkeypatch):
    """More languages than were once taken, and than there are landmarks; fewer texts of each."""
    monkeypatch.setattr(language_id, "SAMPLE_TOTAL", 1000, raising=False)
    rows = [(f"l{i:03}", "".join(chr(97 + (i * 7 + k * (i + 3) + j) % 26) for k in range(40))) for i in range(450) for j in range(3)]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == sorted({x for x, _ in rows}) and model.weights.shape == (400, 450)


def test_kernel_is_shared_ngrams():
    a, b = (language_id.presence(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in (b"abcab", b"xabc"))

    def grams(t):
        return {t[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)}

    assert a.sum() == len(grams(b"abcab")) and a @ b == len(grams(b"abcab") & grams(b"xabc"))
