"""Every named query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, rows_of
from contentlake.oracles import ORACLES
from contentlake.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_registry():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_module.queries()) >= set(QUERIES) and set(entry_module.oracle_sql()) >= set(ORACLES)


def test_entry(spark):
    out = entry_module.entry(spark)
    assert out.columns == ["canonical_url", "product", "part", "avg_q1", "n", "q2_comments"]
    assert out.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    result = entry_module.queries()[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = result.toPandas()
    want = con.execute(entry_module.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
