"""Foreign keys, all in one pass."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import final_plan, settings

import __spark_entry__ as registry
from lakeshelf import schemas
from lakeshelf.operators.quality import orphan_keys, reference_violations
from lakeshelf.schemas import Reference

SF_DIR = "/root/testdata/sf0.01"


def test_one_shuffle_for_all_references(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        df = registry.queries()["orphan_keys"](spark, SF_DIR)
        plan = final_plan(df)
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert plan.count("FileScan parquet") == 9  # each table once


def test_each_kind_of_key(spark):
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables = {
        "fact": spark.createDataFrame([(1, day, "a"), (1, day, "b"), (2, other, None), (None, None, "a")], "id int, day date, code string"),
        "ids": spark.createDataFrame([(2,), (2,), (5,)], "id bigint"),
        "days": spark.createDataFrame([(day, 1)], "day date, n int"),
        "codes": spark.createDataFrame([(1, "a"), (7, None)], "id bigint, code string"),
    }
    numbers = [Reference("fact", ("id",), "ids", ("id",)), Reference("fact", ("day",), "days", ("day",))]
    assert sorted(map(tuple, orphan_keys(tables, numbers).collect())) == [
        ("fact", "day", "days", "2024-01-02", 1), ("fact", "id", "ids", "1", 2)
    ]
    texts = [*numbers, Reference("fact", ("code",), "codes", ("code",)), Reference("fact", ("id", "code"), "codes", ("id", "code"))]
    assert sorted(map(tuple, orphan_keys(tables, texts).collect())) == [
        ("fact", "code", "codes", "b", 1),
        ("fact", "day", "days", "2024-01-02", 1),
        ("fact", "id", "ids", "1", 2),
        ("fact", "id,code", "codes", '["1","b"]', 1),
    ]
    assert [tuple(r) for r in reference_violations(tables, numbers[:1]).collect()] == [("reference", "fact", "id", 1, 2)]
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert orphan_keys(empty, texts).count() == 0
    assert orphan_keys({**tables, "ids": tables["ids"].limit(0)}, numbers[:1]).count() == 2
    with pytest.raises(ValueError):
        orphan_keys(tables, [])


def test_tables_that_refer_to_themselves_and_each_other(spark):
    tables = {
        "a": spark.createDataFrame([(1, 2, 9), (2, None, 8)], "id int, parent int, b int"),
        "b": spark.createDataFrame([(9, 1), (8, 3)], "id int, a int"),
    }
    references = [Reference("a", ("parent",), "a", ("id",)), Reference("a", ("b",), "b", ("id",)), Reference("b", ("a",), "a", ("id",))]
    assert [tuple(r) for r in orphan_keys(tables, references).collect()] == [("b", "a", "a", "3", 1)]


def test_hot_key_travels_as_one_row_a_task(spark):
    """A third of all rows refer to one missing key; what is shuffled are keys, not rows."""
    fact = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100).alias("k"))
    df = orphan_keys({"f": fact, "d": spark.range(100).toDF("k")}, [Reference("f", ("k",), "d", ("k",))])
    assert [tuple(r) for r in df.collect()] == [("f", "k", "d", "-1", 30_000)]
    assert "partial_count" in final_plan(df) or "partial_max" in final_plan(df)


def test_gold_references_fit_the_schemas():
    for r in schemas.GOLD_REFERENCES:
        own, target = schemas.GOLD[r.table], schemas.GOLD[r.target]
        assert [own[c].dataType for c in r.columns] == [target[c].dataType for c in r.target_columns]
        assert r.target_columns == schemas.GOLD_RULES[r.target].key
