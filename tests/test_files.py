"""CSV, JSON and Parquet sources and sinks, with the traps of each format."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeshelf.functions import cents, from_cents, money
from lakeshelf.schemas import OUT_OF_STOCK, SHOP
from lakeshelf.session import scratch_path
from lakeshelf.sinks import files
from lakeshelf.sinks.files import as_array_documents, write_csv, write_documents, write_json, write_parquet
from lakeshelf.sources.layout import day_path, days_glob
from lakeshelf.sources.payloads import read_json_numbers, read_json_objects
from lakeshelf.sources.snapshots import landed_days, read_csv, read_history, read_snapshot, read_snapshots
from lakeshelf.sources.tables import folder_tables

AISLES = SHOP["aisles"]
TRICKY = [
    (1, 'say "hi", ok|really'), (2, "two\nlines"), (3, ""), (4, None), (5, "  padded\t"), (6, "back\\slash\\"),
    (7, "#no comment"), (8, "\r\n\r"), (9, "żółw 🐢"), (None, "key is null"), (10, '"'), (11, "'a', 'b'"),
]


def put(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sep", [",", "|"])
def test_csv_keeps_every_value(spark, sep):
    path = scratch_path(spark, "tricky.csv")
    write_csv(spark.createDataFrame(TRICKY, AISLES), path, sep)
    assert rows(read_csv(spark, path, AISLES, sep)) == Counter(TRICKY)


def test_csv_as_a_database_copies_it(spark, tmp_path):
    text = 'aisle_id,aisle\n1,"say ""hi"", ok"\n2,"two\nlines"\n3,\n4,""\n5,plain\n'
    path = put(tmp_path, "aisles.csv", text)
    expected = {1: 'say "hi", ok', 2: "two\nlines", 3: None, 4: "", 5: "plain"}
    assert dict(map(tuple, read_csv(spark, path, AISLES).collect())) == expected
    assert read_csv(spark, path).schema["aisle_id"].dataType.typeName() == "integer"


def test_csv_value_of_wrong_type_raises(spark, tmp_path):
    path = put(tmp_path, "aisles.csv", "aisle_id,aisle\nnot a number,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|CAST_INVALID"):
        read_csv(spark, path, AISLES).collect()


def test_csv_with_other_columns_raises(spark, tmp_path):
    path = put(tmp_path, "aisles.csv", "aisle,aisle_id\n1,2\n")
    with pytest.raises(Exception, match="header|schema"):
        read_csv(spark, path, AISLES).collect()


def test_day_of_a_snapshot_comes_from_its_path(spark):
    root = scratch_path(spark, "bronze")
    for day, n in (("2021-01-01", 2), ("2021-01-02", 0), ("2021-01-04", 1)):
        df = spark.createDataFrame([(i, "x") for i in range(n)], AISLES)
        write_csv(df, day_path(root, "aisles", day), "|")
    history = read_history(spark, root, "aisles", "2021-01-01", "2021-01-03", AISLES, "|")
    assert rows(history.select(F.col("report_date").cast("string"), "aisle_id")) == Counter(
        [("2021-01-01", 0), ("2021-01-01", 1)]
    )
    landed = landed_days(spark, root, "aisles", "2020-12-31", "2021-01-04")
    assert [str(d) for d in landed] == ["2021-01-01", "2021-01-02", "2021-01-04"]


def test_absent_day_raises_and_empty_day_does_not(spark):
    root = scratch_path(spark, "bronze")
    write_csv(spark.createDataFrame([], AISLES), day_path(root, "aisles", "2021-01-01"), "|")
    assert read_snapshot(spark, root, "aisles", "2021-01-01", AISLES, "|").count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_snapshot(spark, root, "aisles", "2021-01-02", AISLES, "|")


def test_layout():
    assert day_path("/b", "orders", "2021-01-01") == "/b/orders/2021-01-01/orders.csv"
    assert days_glob("/b", "o", "2021-01-31", "2021-02-01", "json") == "/b/o/{2021-01-31,2021-02-01}/o.json"
    with pytest.raises(ValueError):
        days_glob("/b", "o", "2021-02-01", "2021-01-31")
    with pytest.raises(ValueError):
        day_path("/b", "o", "01.02.2021")


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"product_id": 5, "date": "2021-01-01"}, {"product_id": 7}]', [(5,), (7,)]),
        ("[{'product_id': 5}, {'product_id': 5}]", [(5,), (5,)]),
        ("[]", []),
        ('{"product_id": 1}\n{"product_id": null}', [(1,), (None,)]),
    ],
)
def test_json_objects(spark, tmp_path, text, expected):
    df = read_json_objects(spark, put(tmp_path, "p.json", text))
    assert df.columns == OUT_OF_STOCK.names
    assert rows(df) == Counter(expected)


def test_json_over_several_lines(spark, tmp_path):
    path = put(tmp_path, "p.json", '[\n  {"product_id": 5},\n  {"product_id": 6}\n]\n')
    assert rows(read_json_objects(spark, path, multi_line=True)) == Counter([(5,), (6,)])
    path = put(tmp_path, "q.json", "[\n 5,\n 6]\n")
    assert rows(read_json_numbers(spark, path, multi_line=True)) == Counter([(5,), (6,)])


def test_json_that_does_not_parse_raises(spark, tmp_path):
    path = put(tmp_path, "p.json", "[{'product_id': 1}, {'product_id': None}]")
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_objects(spark, path).collect()


def test_json_numbers(spark, tmp_path):
    path = put(tmp_path, "p.json", "[1, 2, 2]\n[]\n[9007199254740993]")
    assert rows(read_json_numbers(spark, path)) == Counter([(1,), (2,), (2,), (9007199254740993,)])
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_numbers(spark, put(tmp_path, "q.json", "[1, 2")).collect()


def test_json_round_trip_keeps_nulls(spark):
    path = scratch_path(spark, "p.json")
    df = spark.createDataFrame([(1,), (None,), (1,)], OUT_OF_STOCK)
    write_json(df, path)
    assert rows(read_json_objects(spark, path)) == rows(df)


def test_documents_are_bounded_and_whole(spark):
    df = spark.range(0, 2500, numPartitions=3).withColumnRenamed("id", "product_id")
    documents = as_array_documents(df, ["product_id"], per_document=100)
    sizes = documents.select(F.size(F.from_json("value", "array<bigint>")).alias("n"))
    assert sizes.agg(F.max("n"), F.sum("n")).first()[:] == (100, 2500)
    path = scratch_path(spark, "ids.json")
    write_documents(documents, path)
    assert rows(read_json_numbers(spark, path)) == rows(df)


def test_parquet_file_count(spark):
    path = scratch_path(spark, "numbers")
    write_parquet(spark.range(1000), path, files=3)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 3
    write_parquet(spark.range(10), path)
    assert spark.read.parquet(path).count() == 10


def test_folder_tables(spark):
    assert "lineitem" in folder_tables(spark, "/root/testdata/sf0.001")


def test_moments_keep_their_microseconds(spark):
    schema = "z timestamp, n timestamp_ntz"
    moments = [(dt.datetime(2021, 1, 1, 0, 0, 0, 900), dt.datetime(2021, 1, 1, 0, 0, 0, 100)), (None, dt.datetime(1, 1, 1))]
    df = spark.createDataFrame(moments, schema)
    write_csv(df, path := scratch_path(spark, "m.csv"))
    assert read_csv(spark, path, df.schema).exceptAll(df).isEmpty() and read_csv(spark, path, df.schema).count() == 2
    write_json(df, path := scratch_path(spark, "m.json"))
    assert read_json_objects(spark, path, df.schema).exceptAll(df).isEmpty()


def test_null_rows_of_one_column_come_back(spark):
    df = spark.createDataFrame([(1,), (None,), (2,), (None,)], OUT_OF_STOCK)
    write_csv(df, path := scratch_path(spark, "one.csv"))
    assert rows(read_csv(spark, path, OUT_OF_STOCK)) == rows(df)
    assert rows(read_csv(spark, path)) == rows(df)


def test_no_text_stands_for_null(spark):
    values = [(1, "\u0001"), (2, "NULL"), (3, "\\N"), (4, None), (5, "")]
    write_csv(spark.createDataFrame(values, AISLES), path := scratch_path(spark, "marker.csv"))
    assert rows(read_csv(spark, path, AISLES)) == Counter(values)


def test_columns_by_name(spark, tmp_path):
    put(tmp_path, "aisles/2021-01-01/aisles.csv", 'extra,aisle,more,aisle_id\n"a,b",x,,7\n,"",2,\n')
    (df,) = read_snapshots(spark, str(tmp_path), {"aisles": AISLES}, "2021-01-01").values()
    assert rows(df) == Counter([(7, "x"), (None, "")])
    with pytest.raises(ValueError, match="department"):
        read_snapshots(spark, str(tmp_path), {"aisles": SHOP["departments"]}, "2021-01-01")


def test_money_and_cents_round_alike(spark):
    for kind in ("double", "decimal(10,3)", "string"):
        df = spark.createDataFrame([("0.125",), ("1.005",), ("-0.125",), ("2.675",)], "v string").select(F.col("v").cast(kind))
        got = df.select(money(F.col("v")).alias("m"), from_cents(cents(F.col("v"))).cast("decimal(18,2)").alias("c")).collect()
        assert all(r.m == r.c for r in got)
        assert [str(r.m) for r in got] == ["0.13", "1.01", "-0.13", "2.68"]


def test_csv_is_written_by_the_tasks_that_have_the_rows(spark, tmp_path, monkeypatch):
    """A large table is not shuffled before it is landed; its files are cut by their rows."""
    df = spark.range(0, 1000, 1, 5).select("id", (F.col("id") % 7).alias("k"))
    monkeypatch.setattr(files, "ROWS_PER_FILE", 60)
    for gather, least in ((False, 20), (True, 17)):
        path = f"{tmp_path}/{gather}.csv"
        write_csv(df, path, gather=gather)
        sizes = [len((tmp_path / f"{gather}.csv" / f).read_text().splitlines()) - 1 for f in os.listdir(path) if f.endswith(".csv")]
        assert len(sizes) == least and max(sizes) <= 60
        assert sorted(r.id for r in read_csv(spark, path, df.schema).collect()) == list(range(1000))
