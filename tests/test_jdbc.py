"""JDBC sources and sinks on the embedded, in-memory Derby that ships with Spark.

It lives in the session's own process: no server, no port. Only a local master can use it.
"""

import datetime as dt
import uuid
from collections import Counter

import pytest

from lakeshelf.sinks.jdbc import append_rows, reload_day, replace_table
from lakeshelf.sources.tables import jdbc_split, jdbc_tables, orders_of_day, read_jdbc


@pytest.fixture
def options():
    return {
        "url": f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
        "driver": "org.apache.derby.jdbc.EmbeddedDriver",
    }


FACT = "REPORT_DATE date, PRODUCT_ID long, QUANTITY long"


def test_replace_keeps_the_targets_own_types(spark, options):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "ID long, FULLNAME string")
    first.write.format("jdbc").options(**options).options(
        dbtable="DIM_CLIENTS", createTableColumnTypes="ID bigint, FULLNAME varchar(63)"
    ).save()
    replace_table(spark.createDataFrame([(3, "c")], first.schema), options, "DIM_CLIENTS")
    assert [tuple(r) for r in read_jdbc(spark, options, "DIM_CLIENTS").collect()] == [(3, "c")]
    # An unbounded text column would have become a CLOB, which Derby cannot compare.
    kept = read_jdbc(spark, options, "(select ID from DIM_CLIENTS where FULLNAME = 'c') q")
    assert kept.count() == 1


def test_scans(spark, options):
    orders = spark.createDataFrame(
        [(i, i % 7, i % 3, i % 2, i, dt.date(2021, 1, 1 + i % 3)) for i in range(100)],
        "order_id long, product_id long, client_id long, store_id long, quantity long, order_date date",
    )
    upper = orders.toDF(*(c.upper() for c in orders.columns))
    append_rows(upper, options, "ORDERS", connections=2)
    split = jdbc_split(spark, options, "ORDERS", "ORDER_ID", 4)
    assert split == ("ORDER_ID", 0, 99, 4)
    whole = read_jdbc(spark, options, "ORDERS", split)
    assert whole.rdd.getNumPartitions() == 4
    assert whole.count() == 100
    day = orders_of_day(whole, "2021-01-02")
    assert day.columns == ["order_id", "product_id", "client_id", "store_id", "quantity"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(ORDER_DATE), *GreaterThanOrEqual(ORDER_DATE,2021-01-02)" in plan
    assert day.count() == 33
    assert read_jdbc(spark, options, "(select distinct STORE_ID from ORDERS) q").count() == 2


def test_empty_table_has_no_split(spark, options):
    append_rows(spark.createDataFrame([], FACT), options, "FACT")
    assert jdbc_split(spark, options, "FACT", "PRODUCT_ID", 4) is None


def test_day_reload_is_repeatable(spark, options):
    one, two = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    reloads = [(one, [(1, 5), (2, 6)]), (two, [(1, 7)]), (one, [(1, 5)]), (two, [])]
    append_rows(spark.createDataFrame([], FACT), options, "FACT")
    for day, rows in reloads:
        df = spark.createDataFrame([(day, *r) for r in rows], FACT)
        reload_day(df, options, "FACT", day, connections=3)
    assert Counter(map(tuple, read_jdbc(spark, options, "FACT").collect())) == Counter([(one, 1, 5)])


def test_table_names_of_a_schema(spark, options):
    listing = spark.createDataFrame(
        [("public", "orders"), ("public", "stores"), ("other", "secret")], "table_schema string, table_name string"
    )
    listing.write.format("jdbc").options(**options).options(
        dbtable="INFORMATION_SCHEMA.TABLES",
        createTableColumnTypes="table_schema varchar(20), table_name varchar(20)",
    ).save()
    assert sorted(r[0] for r in jdbc_tables(spark, options).collect()) == ["orders", "stores"]
