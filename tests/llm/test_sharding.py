import numpy as np
import pytest

from contentlake.llm.sharding import communication_matrix, hypergeometric, shard_rows, shard_wide_rows, write_shards

from .helpers import SCHEMA, awkward


@pytest.mark.parametrize("rows,shards", [([5, 0, 7, 100], 4), ([1], 3), ([], 5), ([10**10, 3, 4 * 10**10], 7)])
def test_matrix_has_both_margins(rows, shards):
    made = communication_matrix(rows, shards, 3)
    assert made.sum(1).tolist() == rows and (made >= 0).all()
    totals = made.sum(0) if rows else np.zeros(shards, int)
    assert totals.max() - totals.min() <= 1


def test_large_draws_have_the_right_mean_and_spread():
    rng = np.random.default_rng(1)
    good, bad, draws = 2 * 10**9, 3 * 10**9, 10**6
    got = np.array([hypergeometric(rng, good, bad, draws) for _ in range(400)])
    sd = (draws * 0.4 * 0.6) ** 0.5
    assert abs(got.mean() - 0.4 * draws) < 5 * sd / 20
    assert 0.8 < got.std() / sd < 1.2


@pytest.mark.parametrize("deal", [shard_rows, shard_wide_rows])
def test_shards_are_exact_gapless_and_repeatable(spark, deal):
    df = spark.createDataFrame(awkward(), SCHEMA).withColumnRenamed("lang", "Shard")
    got = deal(df, 7).toPandas()
    plain = df.drop("Shard").toPandas().astype(str).values.tolist()
    assert sorted(got.drop(columns=["shard", "slot"]).astype(str).values.tolist()) == sorted(plain)
    assert list(got.columns) == ["doc_id", "text", "source", "n_chars", "shard", "slot"]
    sizes = got.groupby("shard").size()
    assert len(got) == df.count() and len(sizes) == 7 and sizes.max() - sizes.min() <= 1
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    again = deal(df.repartition(3), 7).toPandas()
    key = ["shard", "slot"]
    a, b = got.sort_values(key).astype(str).values, again.sort_values(key).astype(str).values
    assert (a == b).all()


def test_shuffle_is_uniform_enough(spark):
    df = spark.range(4000)
    got = shard_rows(df, 8).toPandas()
    assert abs(np.corrcoef(got.id, got.shard)[0, 1]) < 0.06
    one = got[got.shard == 3].sort_values("slot")
    assert abs(np.corrcoef(one.id, one.slot)[0, 1]) < 0.2


def test_empty_and_files(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert shard_rows(empty, 4).count() == 0 and shard_wide_rows(empty, 4).count() == 0
    df = spark.createDataFrame(awkward(), SCHEMA)
    write_shards(df, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count() and back.select("shard").distinct().count() == 5
