"""Every query of the subpackage: against its SQL where there is some, else its shape."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, rows_of
from contentlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_registered():
    names = entry_module.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", ["op1_shards", "op4_mix", "op6_repeats", "op11_runs", "op12_quality"])
def test_one_row_per_document(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.doc_id) == sorted(r[0] for r in con.execute("select doc_id from documents").fetchall())
