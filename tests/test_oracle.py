"""Every registered query against its SQL, run by DuckDB on the same tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "decimal(28,2)": "DECIMAL(28,2)",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in registry.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return connection


def test_each_query_has_sql():
    assert set(registry.own_queries()) <= set(registry.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.own_queries()))
def test_same_rows_as_sql(spark, duck, key):
    df = registry.queries()[key](spark, SF_DIR)
    expected = duck.sql(registry.oracle_sql()[key])
    types = {name: SQL_TYPES[kind] for name, kind in df.dtypes}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    order = [expected.columns.index(c) for c in df.columns]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert want, "empty results prove nothing"
    assert Counter(map(tuple, df.collect())) == want
