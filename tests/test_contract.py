"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import TABLES, table_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_sql(spark, con, name):
    frame = contract.queries()[name](spark, FOLDER)
    mine = table_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(contract.oracle_sql()[name])
    assert mine == table_of([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 20
