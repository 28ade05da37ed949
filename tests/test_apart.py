"""Bad lines set aside, one large JSON array over many tasks, types from texts, and layouts that spare work at run time."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_files import put
from test_plans import final_plan, settings

import __spark_entry__ as registry
from lakeshelf.operators.profile import column_counts, common_counts, narrowest_type, profile_types, schema_of, widened
from lakeshelf.plans import medallion
from lakeshelf.session import scratch_path
from lakeshelf.sinks.buckets import buckets_for, write_bucketed
from lakeshelf.sinks.files import write_array_document, write_csv
from lakeshelf.sources.layout import Layout, day_path
from lakeshelf.sources.payloads import read_json_array, read_json_objects, read_number_array
from lakeshelf.sources.snapshots import TooManyBadRows, read_csv_apart

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "id int, name string, day date, amount decimal(5,2)"

# --- bad lines ------------------------------------------------------------------------------

GOOD = ['1,a,2021-01-01,1.50', '2,"x, ""y""",,', '3,"",2021-01-02,0.1']
BAD = ["x,a,2021-01-01,1", "4,a", "5,a,2021-01-01,1,more", "6,a,2021-13-01,1", "7,a,2021-01-01,one", "99999999999,a,,"]


def test_bad_lines_are_set_aside(spark, tmp_path):
    lines = [line for pair in zip(BAD, GOOD * 2) for line in pair]
    path = put(tmp_path, "a.csv", "\n".join(["id,name,day,amount", *lines]) + "\n")
    parsed = read_csv_apart(spark, path, StructType.fromDDL(SCHEMA), most_bad=0.5)
    assert sorted(r.record for r in parsed.bad.collect()) == sorted(BAD)
    assert {r.file for r in parsed.bad.collect()} == {f"file://{tmp_path}/a.csv"} or all("a.csv" in r.file for r in parsed.bad.collect())
    rows = [(r.id, r.name, str(r.day), str(r.amount)) for r in parsed.good.collect()]
    assert sorted(rows) == sorted([(1, "a", "2021-01-01", "1.50"), (2, 'x, "y"', "None", "None"), (3, "", "2021-01-02", "0.10")] * 2)
    assert (parsed.n_good, parsed.n_bad) == (6, 6) and parsed.good.schema == StructType.fromDDL(SCHEMA)
    with pytest.raises(TooManyBadRows, match="6 of 12 rows"):
        read_csv_apart(spark, path, StructType.fromDDL(SCHEMA), most_bad=0.4)


def test_clean_empty_and_one_column_files(spark, tmp_path):
    path = put(tmp_path, "b.csv", "id,name,day,amount\n" + "\n".join(GOOD) + "\n")
    parsed = read_csv_apart(spark, path, StructType.fromDDL(SCHEMA), most_bad=0)
    assert (parsed.n_good, parsed.n_bad, parsed.bad.count()) == (3, 0, 0)
    parsed = read_csv_apart(spark, put(tmp_path, "c.csv", "id,name,day,amount\n"), StructType.fromDDL(SCHEMA))
    assert (parsed.n_good, parsed.good.count(), parsed.bad.count()) == (0, 0, 0)
    one = scratch_path(spark, "one.csv")
    write_csv(spark.createDataFrame([("1",), (None,), ("x",)], "id string"), one)
    parsed = read_csv_apart(spark, one, StructType.fromDDL("id int"), most_bad=0.5)
    assert sorted(map(str, (r.id for r in parsed.good.collect()))) == ["1", "None"] and parsed.n_bad == 1
    with pytest.raises(Exception, match="id"):
        read_csv_apart(spark, put(tmp_path, "d.csv", "no,name,day,amount\n1,a,,\n"), StructType.fromDDL(SCHEMA))


def test_all_lines_are_parsed_once(spark, tmp_path):
    path = put(tmp_path, "e.csv", "id,name,day,amount\n" + "\n".join(GOOD + BAD[:1]) + "\n")
    spark.sparkContext.setJobGroup("apart", "")
    try:
        parsed = read_csv_apart(spark, path, StructType.fromDDL(SCHEMA), most_bad=0.5)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("apart")) == 1
        plans = parsed.good._jdf.queryExecution().toString() + parsed.bad._jdf.queryExecution().toString()
    finally:
        spark.sparkContext.setJobGroup("default", "")
    assert "csv" not in plans.lower().replace("e.csv", "")


def test_silver_goes_on_without_bad_lines(spark, tmp_path):
    layout = Layout(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")
    path = tmp_path / "bronze" / "t" / "2021-01-01"
    path.mkdir(parents=True)
    (path / "t.csv").write_text("id|name|day|amount\n1|a||\n1|a||\nx|a||\n")
    args = (spark, layout, "t", "2021-01-01", StructType.fromDDL(SCHEMA))
    with pytest.raises(Exception, match="MALFORMED|malformed|bad"):
        medallion.snapshot_to_silver(*args)
    with pytest.raises(TooManyBadRows):
        medallion.snapshot_to_silver(*args, most_bad=0.1)
    assert medallion.snapshot_to_silver(*args, most_bad=0.5).count() == 1
    assert [r.record for r in spark.read.parquet(layout.silver_table("rejected_t", "2021-01-01")).collect()] == ["x|a||"]


# --- one array over many tasks ---------------------------------------------------------------

NESTED = "a int, s string, n array<struct<x:int,t:string>>, o struct<p:struct<q:string>>"


def nested(n, seed):
    rnd = random.Random(seed)

    def text():
        return "".join(rnd.choice(["}", "{", '"', "\\", "},{", "[", "]", ",", "a", "é", " ", "\n", "}, {", '\\"']) for _ in range(rnd.randrange(12)))

    return [
        {"a": i, "s": text(), "n": [{"x": rnd.randrange(9), "t": text()} for _ in range(rnd.randrange(3))], "o": {"p": {"q": text()}}} for i in range(n)
    ]


@pytest.mark.parametrize("options", [{}, {"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_array_is_read_by_many_tasks(spark, tmp_path, options):
    rows = nested(600, 1)
    rows[50]["s"] = "}{" * 4000  # longer than several splits
    path = put(tmp_path, "x.json", json.dumps(rows, **options))
    put(tmp_path, "y.json", json.dumps(nested(40, 2), **options))
    with settings(spark, files__maxPartitionBytes="2k", files__openCostInBytes="1"):
        df = read_json_array(spark, path, StructType.fromDDL(NESTED))
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
        got = sorted((r.asDict(True) for r in df.collect()), key=lambda r: r["a"])
        both = read_json_array(spark, f"{tmp_path}/[xy].json", StructType.fromDDL(NESTED)).count()
    assert got == rows and both == 640


@pytest.mark.parametrize("text, n", [("[]", 0), (" [\n ] \n", 0), ("", 0), ('[{"a": 1}]', 1), ('\n[ {"a": 1} ,{"a":2}\n]\n', 2)])
def test_small_arrays(spark, tmp_path, text, n):
    assert read_json_array(spark, put(tmp_path, "x.json", text), StructType.fromDDL(NESTED)).count() == n


@pytest.mark.parametrize("text", ['{"a": 1}', '[{"a": 1}', '[{"a": 1}] x', "nothing", '[{"a": 1}, 5]', '[{"a": "text"}]', '[{"a": 1}}]'])
def test_what_is_no_array_raises(spark, tmp_path, text):
    with pytest.raises(Exception, match="one array of objects|MALFORMED"):
        read_json_array(spark, put(tmp_path, "x.json", text), StructType.fromDDL(NESTED)).collect()


def test_numbers_are_split_too(spark, tmp_path):
    numbers = list(range(-500, 3000))
    path = put(tmp_path, "n.json", json.dumps(numbers, indent=1))
    with settings(spark, files__maxPartitionBytes="1k", files__openCostInBytes="1"):
        df = read_number_array(spark, path)
        assert df.rdd.getNumPartitions() > 10 and sorted(r.product_id for r in df.collect()) == numbers
    assert read_number_array(spark, put(tmp_path, "o.json", "[ ]")).count() == 0
    with pytest.raises(Exception, match="not a whole number: x"):
        read_number_array(spark, put(tmp_path, "p.json", "[1, x]")).collect()


def test_array_document_is_valid_json(spark):
    path = scratch_path(spark, "rows.json")
    df = spark.range(0, 50, 1, 7).select("id", F.when(F.col("id") > 9, F.lit("}")).alias("s"))
    write_array_document(df, path)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    assert [r["id"] for r in json.loads(text)] == list(range(50))
    assert read_json_objects(spark, path, df.schema, multi_line=True).count() == 50
    write_array_document(df.limit(0), path)
    assert read_json_array(spark, path, df.schema).count() == 0


def test_payload_day_from_one_document(spark, tmp_path):
    layout = Layout(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")
    for day, text in (("2021-01-01", '[\n{"product_id": 5},\n{"product_id": 5}]'), ("2021-01-02", "[]")):
        folder = tmp_path / "bronze" / "out-of-stock" / day
        folder.mkdir(parents=True)
        (folder / "out-of-stock.json").write_text(text)
    medallion.run_payload_day(spark, layout, "2021-01-01", split=True)
    assert len(medallion.backfill_out_of_stock(spark, layout, "2021-01-01", "2021-01-02", split=True)) == 2
    assert [r.product_id for r in spark.read.parquet(layout.gold_table("fact_oos")).collect()] == [5]
    numbers = tmp_path / "bronze" / "out-of-stock" / "2021-01-02" / "out-of-stock.json"
    numbers.write_text("[7,\n7]")
    medallion.backfill_out_of_stock(spark, layout, "2021-01-02", "2021-01-02", form="numbers", split=True)
    assert sorted(r.product_id for r in spark.read.parquet(layout.gold_table("fact_oos")).collect()) == [5, 7]
    assert day_path(layout.bronze, "out-of-stock", "2021-01-01", "json").endswith("out-of-stock/2021-01-01/out-of-stock.json")


# --- types -------------------------------------------------------------------------------------


def test_one_day_widens_a_column(spark):
    rows = [
        ("d1", "1", "2021-01-01", "true", None, "1.5", "x", "01"),
        ("d1", "-20", "2021-01-02", "false", None, "22", "1", "2"),
        ("d2", "3.25", "2021-01-02 10:00:00", "true", None, "1e3", "2", "00012345678901234567"),
    ]
    df = spark.createDataFrame(rows, "day string, n string, t string, f string, e string, x string, m string, l string")
    types = {r.column_name: r["type"] for r in profile_types(df.drop("day")).collect()}
    assert types == {"n": "decimal(4,2)", "t": "timestamp", "f": "boolean", "e": "string", "x": "double", "m": "string", "l": "decimal(17,0)"}
    got = {(r.day, r.column_name): (r["type"], r.common_type) for r in widened(df, ["day"]).collect()}
    assert got == {
        ("d1", "n"): ("bigint", "decimal(4,2)"), ("d2", "n"): ("decimal(3,2)", "decimal(4,2)"), ("d1", "t"): ("date", "timestamp"),
        ("d1", "x"): ("decimal(3,1)", "double"), ("d2", "m"): ("bigint", "string"), ("d1", "l"): ("bigint", "decimal(17,0)"),
    }
    whole = common_counts(column_counts(df, ["day"])).select("column_name", narrowest_type().alias("type"))
    assert {r.column_name: r["type"] for r in whole.collect()} == types
    assert schema_of(df.drop("day")).simpleString() == "struct<n:decimal(4,2),t:timestamp,f:boolean,e:string,x:double,m:string,l:decimal(17,0)>"


def test_forms_that_no_calendar_has(spark):
    df = spark.createDataFrame([("2021-02-30", "2021-01-01 25:00:00", "", "9" * 39)], "a string, b string, c string, d string")
    types = {r.column_name: r["type"] for r in profile_types(df).collect()}
    assert types == {"a": "string", "b": "string", "c": "string", "d": "double"}
    assert {r["type"] for r in profile_types(df.limit(0)).collect()} == set()


def test_types_need_one_shuffle(spark):
    assert final_plan(registry.queries()["profile_types"](spark, SF_DIR)).count("Exchange hashpartitioning") == 2  # one a table


# --- layouts ---------------------------------------------------------------------------------------


def test_weekends_are_pruned_at_run_time(spark):
    df = registry.queries()["weekend_quantities"](spark, SF_DIR)
    plan = final_plan(df)
    assert "dynamicpruningexpression(report_date" in plan
    nodes, read = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.metrics().contains("numPartitions"):
            read.append(node.metrics().apply("numPartitions").value())
        if hasattr(node, "executedPlan") and "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    assert 8 in read and max(read) == 8  # the weekend days of thirty


def test_bucketed_join_shuffles_nothing(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        plan = final_plan(registry.queries()["bucketed_join"](spark, SF_DIR))
    assert "SortMergeJoin" in plan and "hashpartitioning(orderkey" not in plan


def test_bucket_counts_divide(spark):
    assert [buckets_for(n, 100) for n in (0, 1, 100, 101, 399, 400, 401, 5000)] == [1, 1, 1, 2, 4, 4, 8, 64]
    for name, buckets in (("few", 4), ("many", 8)):
        write_bucketed(spark.range(100).toDF("k"), f"t_{name}", scratch_path(spark, name), "k", buckets)
    values = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1", "bucketing__coalesceBucketsInJoin__enabled": "true"}
    with settings(spark, **values):
        df = spark.table("t_few").join(spark.table("t_many"), "k")
        assert df.count() == 100
        plan = final_plan(df)
    assert "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8 (Coalesced to 4)" in plan


def test_records_of_an_array_are_not_shuffled(spark, tmp_path):
    """Only the ends of splits move, not every piece between two braces."""
    rows = nested(3000, 3)
    path = put(tmp_path, "x.json", json.dumps(rows, indent=1))
    with settings(spark, files__maxPartitionBytes="64k", files__openCostInBytes="1", adaptive__enabled="false"):
        df = read_json_array(spark, path, StructType.fromDDL(NESTED), file="_file")
        moved = _shuffled_rows(df)
    assert moved and max(moved) <= 4 * (os.path.getsize(path) // 65536 + 1)


def _shuffled_rows(df):
    """Rows that each shuffle of the plan wrote, after it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    assert sum(1 for _ in df.toLocalIterator()) == 3000
    counts, todo = [], [plan]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange":
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
    return counts
