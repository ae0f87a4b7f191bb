"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from hirelattice.plans.bindings import BASE
from tools.check import rows

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    if name not in SQL:
        assert got.num_rows > 0
        return
    want = duck.execute(SQL[name]).to_arrow_table()
    got_columns, got_rows = rows({c: got.column(c).to_pylist() for c in got.column_names})
    want_columns, want_rows = rows({c: want.column(c).to_pylist() for c in want.column_names})
    assert got_columns == want_columns
    assert got_rows == want_rows


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
