"""Every registered query with SQL, next to DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from check_oracles import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    cursor = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert compare(df.columns, df.collect(), names, cursor.fetchall()) == ""


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
