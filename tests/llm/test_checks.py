"""The columns that SQL can express, on the driver's table and on odd rows."""

import oracle
import pytest

from skein.llm import checks, queries

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(D)


@pytest.mark.parametrize("name", list(checks.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, D, queries.QUERIES[name], queries.ORACLES[name]) == 1000


@pytest.mark.parametrize("name", list(checks.ORACLES))
def test_odd_rows_equal_sql(spark, odd, odd_dir, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{odd_dir}/documents.parquet/*.parquet')")
    assert oracle.compare(spark, con, odd_dir, queries.QUERIES[name], queries.ORACLES[name]) == odd.count()
