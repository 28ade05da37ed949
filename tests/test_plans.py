"""What Spark plans for the operators: pruning, reuse, broadcasts by size, hot keys."""

import re
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from lakeshelf.operators.aggregates import carry_up, count_rows
from lakeshelf.operators.joins import left_outer, star_sum, without_match
from lakeshelf.operators.ranking import leaders_per_group, top_k
from lakeshelf.sinks.files import as_array_documents

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    values = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(plan):
    return Counter(re.findall(r"FileScan \w+ .*?/(\w+)\.parquet", plan))


@pytest.mark.parametrize("key", sorted(registry.own_queries()))
def test_no_cross_join_and_no_python(spark, key):
    plan = registry.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert operator not in plan


@pytest.mark.parametrize(
    "key", ["q2_topk_with_ties", "q3_top_category_by_amount", "q5_top3_dense_rank", "q7_longest_by_pattern"]
)
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_ranking_scans_each_fact_once(spark, key, threshold):
    with settings(spark, autoBroadcastJoinThreshold=threshold):
        plan = final_plan(registry.queries()[key](spark, SF_DIR))
    assert "ReusedExchange" in plan
    found = scans(plan)
    assert all(found[t] <= 1 for t in ("lineitem", "orders", "customer", "part", "supplier")), found


def test_carried_sums_are_shuffled_once_per_key(spark):
    """The shuffle of a sum also serves the next join."""
    lines = registry.read_table(spark, SF_DIR, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    supplier = registry.read_table(spark, SF_DIR, "supplier")
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        sums = carry_up(count_rows(lines, ["s_suppkey"]), supplier, "s_suppkey", ["s_suppkey", "s_name"], ["cnt"])
        plan = final_plan(sums)
    assert plan.count("Exchange hashpartitioning(s_suppkey") == 2  # the sums and the suppliers
    assert "partial_count(1)" in plan


def test_scans_are_pruned(spark):
    plan = registry.queries()["scan_orders_for_day"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1998-10-03T00:00)" in plan
    plan = registry.queries()["q4_anti_left_outer"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "LeftAnti" in plan


def test_star_sum_starts_no_job_while_it_is_built(spark):
    spark.sparkContext.setJobGroup("building", "")
    try:
        df = registry.queries()["star_join_broadcast"](spark, SF_DIR)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setJobGroup("default", "")
    assert "BroadcastHashJoin" in final_plan(df)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_star_sum_by_broadcast_or_shuffle(spark, threshold):
    fact = spark.range(3000).select((F.col("id") % 40).alias("k"), F.lit(1).alias("n"))
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") % 3).alias("area"))
    with settings(spark, autoBroadcastJoinThreshold=threshold, adaptive__autoBroadcastJoinThreshold=threshold):
        got = star_sum(fact, [(dim, "k", ["area"])], "k", ["n"], ["area"])
        assert {r["area"]: r["n"] for r in got.collect()} == {0: 750, 1: 750, 2: 750}


@pytest.mark.parametrize("key", sorted(registry.own_queries()))
def test_no_fixed_number_of_tasks(spark, key):
    """What moves rows lets their number decide how many tasks there are."""
    plan = registry.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan and "Coalesce " not in plan


def test_left_outer_reads_the_left_side_once(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        plan = final_plan(registry.queries()["left_outer_keep_nulls"](spark, SF_DIR))
    assert "ReusedExchange" in plan
    # One scan of the rows with a key; the other looks for rows without one only.
    assert len(re.findall(r"PushedFilters: \[IsNotNull\(o_orderkey\)\]", plan)) == 1
    assert len(re.findall(r"PushedFilters: \[IsNull\(o_orderkey\)\]", plan)) == 1


def test_left_outer_with_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "b")], "k int, x string")
    right = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "r int, y int")
    got = Counter(map(tuple, left_outer(left, right, "k", "r").collect()))
    assert got == Counter([(1, "a", 1, 5), (1, "a", 1, 6), (2, "c", None, None)] + [(None, "b", None, None)] * 2)


def test_question_3_has_fewer_shuffles(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        plan = final_plan(registry.queries()["rental_top_category_by_amount"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") < 19


def test_documents_of_one_row_need_no_shuffle(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    plan = as_array_documents(df, ["n"], per_document=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("kind", ["float", "double"])
def test_top_k_refuses_floating_point(spark, kind):
    with pytest.raises(TypeError):
        top_k(spark.range(3).select(F.col("id").cast(kind).alias("v")), "v", 2)


# --- hot keys -------------------------------------------------------------------------------


def hot_rows(spark, n=60_000):
    """A third of the rows has key 1."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    return spark.range(0, n, numPartitions=8).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("text"))


def test_hot_key_is_split_in_the_left_outer_join(spark):
    left = spark.range(0, 70_000, numPartitions=8).withColumnRenamed("id", "key")
    right = hot_rows(spark)
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="200k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="100k",
    ):
        df = left_outer(left, right, "key", "k")
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        # Keys 0, 3, 6, ... have no row of their own on the right; key 1 has a third of all.
        assert df.where("k IS NULL").count() == 70_000 - 40_000
        assert df.where("k = 1").count() == 20_001
        assert df.count() == 60_000 + 30_000


def test_hot_key_of_a_bridge_is_split(spark):
    """The carried sums hold one row per key, but the bridge has a third of its rows on one."""
    sold = spark.range(0, 50_000, numPartitions=8).select((F.col("id") % 20_000).alias("k"))
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50k",
    ):
        sums = count_rows(sold, ["k"], splittable=True)
        df = carry_up(sums, hot_rows(spark), "k", ["text"], ["cnt"])
        plan = final_plan(df)
        assert "SortMergeJoin(skew=true)" in plan
        want = sold.join(hot_rows(spark), "k").groupBy("text").count()
        assert df.exceptAll(want).count() == 0 and df.count() == want.count()


def test_anti_join_shuffles_distinct_keys(spark):
    left = spark.range(0, 70_000, numPartitions=8).withColumnRenamed("id", "key")
    df = without_match(left, hot_rows(spark), "key", "k")
    assert df.count() == 30_000
    assert re.search(r"HashAggregate\(keys=\[_right_key#\d+L?\]", final_plan(df))


@pytest.mark.parametrize("ties, ranks", [("rank", [1, 2]), ("dense_rank", [1, 2, 3])])
def test_ties_are_whole_and_spread(spark, ties, ranks):
    """20,000 rows share the second place; they do not meet in one task."""
    df = hot_rows(spark).select(
        "k", "text", F.when(F.col("k") == 1, 5).when(F.col("k") == 4, 9).when(F.col("k") == 2, None).otherwise(3).alias("v")
    )
    grouped = df.groupBy("k", "text").agg(F.max("v").alias("v"))
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        top = top_k(grouped, "v", 3, ties)
        counts = Counter(r["rank"] for r in top.collect())
        assert sorted(counts) == ranks
        assert counts[1] == 1 and counts[2] == 20_001
        tied = top.where("rank = 2").select(F.spark_partition_id().alias("p"))
        assert tied.distinct().count() > 1


def test_leaders_per_group(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, None), (None, 5, 1), (None, 6, 0)], "g string, id int, v int"
    )
    for few in (True, False):
        got = leaders_per_group(df, "v", "g", few_groups=few, rank_column="r")
        assert {(r.g, r.id, r.r) for r in got.collect()} == {("a", 1, 1), ("a", 2, 1), ("b", 4, 1), (None, 5, 1)}


def test_top_k_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 7), (3, None)], "id int, v int")
    assert top_k(df.limit(0), "v", 3).count() == 0
    assert top_k(df.limit(0), "v", 1).count() == 0
    assert {(r.id, r["rank"]) for r in top_k(df, "v", 2).collect()} == {(1, 2), (2, 1), (3, 2)}
    assert [r.id for r in top_k(df, "v", 1).collect()] == [2]
