"""Rows without a partner are dropped before the shuffle; rows with one never are."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registry
from lakeshelf.operators.reduction import MOST_BITS, possible_matches
from lakeshelf.plans import rental

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def no_broadcasts(spark):
    for key in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(f"spark.sql.{key}", "-1")
    yield
    for key in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(f"spark.sql.{key}")


def nodes(plan):
    """All operators of a finished plan; stages that are used again count once."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from nodes(plan.executedPlan())
    elif "QueryStage" in plan.nodeName():
        yield from nodes(plan.plan())
    elif plan.nodeName() != "ReusedExchange":
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))


def finished(df):
    rows = sorted(map(tuple, df.collect()))
    return rows, list(nodes(df._jdf.queryExecution().executedPlan()))


def shuffled_rows(plan):
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for n in plan if n.nodeName() == "Exchange")


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 20])
def test_no_partner_is_lost(spark, bits):
    fact = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    keys = spark.range(0, 900).select((F.col("id") * 37 - 500).cast("int").alias("k"), F.lit("x").alias("v"))
    kept = possible_matches(fact, keys.unionByName(keys), "k", bits)
    assert kept.columns == ["k", "v"]
    plain = fact.join(keys.select("k"), "k", "left_semi")
    assert plain.exceptAll(kept).count() == 0
    if bits == 1 << 20:
        assert kept.count() < 1.01 * plain.count()


@pytest.mark.parametrize("kind", ["string", "date", "smallint"])
def test_other_types(spark, kind):
    value = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))}.get(kind, F.col("id").cast(kind))
    fact = spark.range(0, 5000).select(value.alias("k"))
    keys = fact.where(F.xxhash64("k") % 50 == 0)
    kept = possible_matches(fact, keys, "k")
    assert kept.exceptAll(keys).count() < 5 and keys.exceptAll(kept).count() == 0


def test_nulls_and_nothing(spark):
    fact = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (1, "a")], "k int, x string")
    keys = spark.createDataFrame([(None,), (1,), (1,)], "k bigint")
    assert sorted(map(tuple, possible_matches(fact, keys, "k").collect())) == [(1, "a"), (1, "a")]
    assert possible_matches(fact, keys.limit(0), "k").count() == 0
    assert possible_matches(fact.limit(0), keys, "k").count() == 0
    assert possible_matches(fact, keys.where("k IS NULL"), "k").count() == 0


def test_types_without_a_common_hash_are_left_alone(spark):
    fact = spark.range(3).select(F.col("id").cast("double").alias("k"))
    assert possible_matches(fact, spark.range(1).select(F.col("id").alias("k")), "k") is fact
    assert possible_matches(fact, fact, "k") is fact
    text = fact.select(F.col("k").cast("string").alias("k"))
    collated = spark.createDataFrame([("A",)], T.StructType([T.StructField("k", T.StringType("UTF8_LCASE"))]))
    assert possible_matches(text, collated, "k") is text and possible_matches(collated, collated, "k") is collated


@pytest.mark.parametrize("bits", [0, 32, 100, MOST_BITS * 2])
def test_size_of_the_filter_is_bounded(spark, bits):
    df = spark.range(1).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        possible_matches(df, df, "k", bits)


def few_cities(city):
    return {"few": city.endswith("4"), "none": city == "nowhere"}


QUESTIONS = {
    "5": lambda tables, **how: rental.top_actors_of_category(tables, "Brand#7", **how),
    "7": lambda tables, **how: rental.longest_rented_categories(tables, few_cities(F.col("city")), **how),
}


@pytest.mark.parametrize("question, scan, most", [("5", "l_partkey", 0.1), ("7", "o_custkey", 0.8)])
def test_fact_is_reduced_at_its_scan(spark, no_broadcasts, question, scan, most):
    """The filter stands right above the fact's scan, no fact is scanned more often than without it, fewer rows travel.

    The rows counted are those of the main plan, without the filter's own, at most ``bits / 64`` a task. Question 7 has a
    rental frame of two tables here, of which the filter reaches the smaller one.
    """
    seen = {}
    for reduce in (True, False):
        df = QUESTIONS[question](registry._Rental(spark, SF_DIR), reduce=reduce)
        rows, plan = finished(df)
        filters = [n for n in plan if n.nodeName() == "Filter" and "getbit" in n.simpleString(1000)]
        seen[reduce] = rows, filters, shuffled_rows(plan), sum(n.nodeName().startswith("Scan parquet") for n in plan)
    assert seen[True][0] == seen[False][0]
    assert not seen[False][1]
    assert any(scan in n.simpleString(1000) for n in seen[True][1])
    for found in seen[True][1]:
        below = found.children().apply(0)
        while below.nodeName() in ("ColumnarToRow", "InputAdapter") or below.nodeName().startswith("WholeStageCodegen"):
            below = below.children().apply(0)
        assert below.nodeName().startswith("Scan parquet")
    assert seen[True][3] <= seen[False][3]
    assert seen[True][2] < most * seen[False][2]
