"""Fingerprints of row sets, and back-fills that load only what changed."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lakeshelf import schemas
from lakeshelf.operators.fingerprints import PARTS, add_fingerprints, changed, fingerprint
from lakeshelf.plans import medallion
from lakeshelf.session import scratch_path
from lakeshelf.sources.layout import Layout, day_path

FIRST, LAST = "2021-01-01", "2021-01-03"


def value(df, **options):
    return tuple(fingerprint(df, **options).first())


def test_order_does_not_count_and_every_value_does(spark):
    rows = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "", "x")]
    schema = "n int, s string, t string"
    df = spark.createDataFrame(rows, schema)
    own = value(df)
    assert own == value(spark.createDataFrame(rows[::-1], schema).repartition(3)) == value(df.select("t", "n", "s"))
    others = [
        rows[:-1],
        rows + rows[:1],
        [(1, None, "a"), *rows[1:]],
        [(1, "a", ""), *rows[1:]],
        [(4, "a", None), *rows[1:]],
        [(1, "a", None), (2, None, "b"), (1, "a", None), (3, "", "x")],
    ]
    assert len({value(spark.createDataFrame(r, schema)) for r in others} | {own}) == len(others) + 1
    assert own[0] == 4


def test_nested_nulls_count(spark):
    schema = "a array<int>, s struct<x:int,y:int>, m map<string,int>"
    rows = [([1, None], (1, None), {"k": None}), ([None, 1], (1, None), {"k": None}), ([1], (1, None), {"k": None}),
            ([1, None], (None, 1), {"k": None}), ([1, None], (1, None), {}), ([1, None], (1, None), None), (None, (1, None), {"k": None})]
    assert len({value(spark.createDataFrame([r], schema)) for r in rows}) == len(rows)


def test_parts_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("day"), F.col("id").alias("n"))
    whole = fingerprint(df, ["day"])
    parts = fingerprint(df.where("n < 400"), ["day"]).unionByName(fingerprint(df.where("n >= 400"), ["day"]))
    assert sorted(add_fingerprints(parts, ["day"]).collect()) == sorted(whole.collect())
    assert changed(whole, add_fingerprints(parts, ["day"]), ["day"]).count() == 0
    more = fingerprint(df.union(df.where("n = 7")), ["day"])
    assert [r.day for r in changed(more, whole, ["day"]).collect()] == [1]
    assert changed(whole, whole.where("day = 0"), ["day"]).count() == 2
    assert whole.columns == ["day", *PARTS]


def lake(spark):
    root = scratch_path(spark, "lake")
    return Layout(f"{root}/bronze", f"{root}/silver", f"{root}/gold")


def orders(spark, *rows):
    fields = "report_date date, order_id long, product_id long, client_id long, store_id long, quantity long"
    return spark.createDataFrame([(dt.date(2021, 1, d), *rest) for d, *rest in rows], fields)


def files(layout, table):
    root = layout.gold_table(table).removeprefix("file:")
    return {d: sorted(os.listdir(f"{root}/{d}")) for d in os.listdir(root) if d.startswith("report_date=")}


def loaded(spark, layout, **options):
    return [d.day for d in medallion.backfill_orders(spark, layout, FIRST, LAST, changed_only=True, **options)]


def test_only_changed_days_are_loaded(spark):
    layout = lake(spark)
    rows = [(1, 1, 1, 1, 1, 5), (1, 2, 1, 1, 1, 6), (2, 3, 1, 1, 1, 7), (3, 4, 2, 1, 1, 8)]
    medallion.land_days(orders(spark, *rows), layout.bronze, "orders")
    assert loaded(spark, layout) == [1, 2, 3]
    before = files(layout, "fact_orders")
    medallion.land_days(orders(spark, *rows[::-1]).repartition(3), layout.bronze, "orders")
    assert loaded(spark, layout) == []
    assert files(layout, "fact_orders") == before
    medallion.land_days(orders(spark, (2, 3, 1, 1, 1, 70)), layout.bronze, "orders")
    assert loaded(spark, layout) == [2]
    after = files(layout, "fact_orders")
    assert {d for d in after if after[d] != before[d]} == {"report_date=2021-01-02"}
    facts = spark.read.parquet(layout.gold_table("fact_orders"))
    assert sorted((r.report_date.day, r.quantity) for r in facts.collect()) == [(1, 11), (2, 70), (3, 8)]


def test_empty_and_absent_days(spark):
    layout = lake(spark)
    medallion.land_days(orders(spark, (1, 1, 1, 1, 1, 5), (2, 2, 1, 1, 1, 6)), layout.bronze, "orders")
    assert loaded(spark, layout, missing="skip") == [1, 2]
    empty = spark.createDataFrame([], schemas.SHOP["orders"])
    for day in ("2021-01-02", "2021-01-03"):
        medallion.land_table(empty, layout.bronze, "orders", day)
    assert loaded(spark, layout) == [2, 3]
    assert loaded(spark, layout) == []
    assert [r.quantity for r in spark.read.parquet(layout.gold_table("fact_orders")).collect()] == [5]


def test_load_that_dies_is_done_again(spark, monkeypatch):
    layout = lake(spark)
    medallion.land_days(orders(spark, (1, 1, 1, 1, 1, 5), (2, 2, 1, 1, 1, 6), (3, 2, 1, 1, 1, 6)), layout.bronze, "orders")
    real = medallion.reload_days

    def reload(df, root, days):
        if "fingerprints" in root:
            raise OSError("gone")
        real(df, root, days)

    with monkeypatch.context() as patch:
        patch.setattr(medallion, "reload_days", reload)
        try:
            loaded(spark, layout)
        except OSError:
            pass
    assert loaded(spark, layout) == [1, 2, 3] and loaded(spark, layout) == []


def test_payload_days(spark):
    layout = lake(spark)
    for day, product in (("2021-01-01", 4), ("2021-01-02", 5)):
        spark.createDataFrame([(f'[{{"product_id": {product}}}]',)], "value string").write.text(day_path(layout.bronze, "out-of-stock", day, "json"))
    args = (spark, layout, "2021-01-01", "2021-01-02")
    assert len(medallion.backfill_out_of_stock(*args, changed_only=True)) == 2
    assert medallion.backfill_out_of_stock(*args, changed_only=True) == []
