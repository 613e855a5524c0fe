import pytest
from pyspark.sql import functions as F

from contentlake.llm import token_counts as T
from contentlake.llm.tables import n_words
from contentlake.session import scratch_path

from .helpers import SCHEMA, awkward

CHANGE = "key string, change string, source string, lang string, tokenizer string, n_tokens long, at int, extra string"


def totals(spark, store):
    got = sorted(map(str, T.totals(spark, store).collect()))
    assert got == sorted(map(str, T.recount(spark, store).collect()))
    return T.totals(spark, store).collect()


def test_batches_against_a_dictionary(spark):
    store = T.create_store(spark, scratch_path(spark, "tokens"))
    held = {}
    batches = [
        [("a", "insert", "s", "en", "v1", 5), ("b", "insert", "s", "en", "v1", 7), (None, "insert", None, None, "v1", 1), ("c", "insert", "t", None, "v1", None)],
        [("a", "revise", "s", "en", "v2", 9), ("b", "delete", None, None, None, None), ("x", "delete", "s", "en", "v1", 3), ("n", "revise", "t", "de", "v2", 2)],
        [("a", "delete", None, None, None, None), ("a", "insert", "u", "fr", "v2", 4), ("c", "insert", "t", "de", "v2", 8), (None, "delete", None, None, None, None)],
        [],
    ]
    for no, batch in enumerate(batches):
        rows = [(*r, i, "") for i, r in enumerate(batch)]
        changes = spark.createDataFrame(rows, CHANGE)
        assert T.apply_batch(spark, store, f"b{no}", changes)
        assert not T.apply_batch(spark, store, f"b{no}", changes)
        for key, change, *value in batch:
            held.pop(key, None)
            if change != "delete":
                held[key] = value
        want = {}
        for s, lang, v, n in held.values():
            docs, tokens = want.get((s, lang, v), (0, 0))
            want[(s, lang, v)] = (docs + 1, tokens + (n or 0))
        assert {tuple(r)[:3]: tuple(r)[3:] for r in totals(spark, store)} == want


def test_a_failed_batch_leaves_nothing(spark):
    store = T.create_store(spark, scratch_path(spark, "tokens"))
    bad = spark.createDataFrame([("a", "upsert", "s", "en", "v1", 5, 0, "")], CHANGE)
    with pytest.raises(Exception, match="unknown change"):
        T.apply_batch(spark, store, "b", bad)
    assert totals(spark, store) == [] and T.commits(spark, store) == []
    assert T.apply_batch(spark, store, "b", bad.withColumn("change", F.lit("insert")))
    assert len(totals(spark, store)) == 1


def test_documents_and_a_public_vocabulary(spark):
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/byte_bpe_50k.json"
    rows = [r for r in awkward(2, 10) if r[0] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    reader = Tokenizer.from_file(path)
    reader.encode_special_tokens = True
    for r in df.select("text", T.n_vocabulary_tokens(df.text, path).alias("n"), n_words(df.text).alias("w")).collect():
        assert r["n"] == len(reader.encode(r["text"] or "", add_special_tokens=False).ids)
    store = T.create_store(spark, scratch_path(spark, "tokens"))
    assert T.apply_all(spark, store, [("one", T.change_rows(df, "doc_id", "insert", "w", n_words(df.text)))] * 2) == 1
    assert sum(r["n_docs"] for r in totals(spark, store)) == len({r[0] for r in rows})
