"""The pipeline's stages against brute force, each on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .helpers import SCHEMA, awkward
from .test_decontamination import brute as leaks
from .test_jaccard import brute as groups, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema if len(out) < len(corpus_pipeline.STAGES) else None)
        out.append(docs.collect())
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_against_brute_force(spark, steps):
    docs, clean, single, free, mixed, dealt = steps
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean}
    fine = [d for d, t in labels.items() if t == 0]
    assert sum(d in kept for d in fine) >= 0.9 * len(fine)  # a fit on 80 labels; test_models has the larger table
    rows = [tuple(r) for r in clean]
    first = sorted(c for i, n, c, _ in groups(rows) if n and c == i)
    assert sorted(str(r.doc_id) for r in single if shingles(r.text)) == first
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in leaks([tuple(r) for r in single], items)}
    assert {r.doc_id for r in free} == {r.doc_id for r in single} - bad
    words = sum(len((r.text or "").split()) for r in free)
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * words) < 0.02 * words
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in free}
    assert len(dealt) == len(mixed)
    sizes = [sum(r.shard == s for r in dealt) for s in range(corpus_pipeline.SHARDS)]
    assert max(sizes) - min(sizes) <= 1


def test_stages_bear_awkward_rows(spark, tmp_path):
    rows = awkward(5, 20)
    df = spark.createDataFrame(rows, SCHEMA)
    for table, data, schema in (("labels", [(1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), ("benchmark", [(None, None)], "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    for docs in (df.withColumn("Shard", F.lit(1)).withColumn("hits", F.lit("x")), spark.createDataFrame([], SCHEMA)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
