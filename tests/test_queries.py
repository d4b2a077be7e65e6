"""Every registered query vs its DuckDB oracle on the smallest test tables."""

import os

import pytest

from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _names():
    import __spark_entry__ as E
    return sorted(E.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    got = E.queries()[name](spark, SF).toArrow()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows >= 0
        return
    exp = duck.sql(sql).to_arrow_table()
    assert rows_of(got) == rows_of(exp)


def test_entry_runs(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
