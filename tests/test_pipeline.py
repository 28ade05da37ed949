"""The daily pipeline: repeatable days, ranges, empty and absent days, gold rules."""

import datetime as dt
import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeshelf import schemas
from lakeshelf.functions import days_between
from lakeshelf.operators.calendar import build_dates, date_spine, days_without_rows, new_dates, rows_of_days
from lakeshelf.operators.quality import violations
from lakeshelf.plans import medallion, star
from lakeshelf.schemas import GOLD, GOLD_RULES, SHOP
from lakeshelf.session import scratch_path
from lakeshelf.sinks.days import read_days, reload_day, reload_days
from lakeshelf.sinks.files import write_json
from lakeshelf.sources.layout import Layout, day_path

DAYS = ("2021-01-01", "2021-01-02", "2021-01-03")
DIMENSIONS = {
    "departments": [(1, "food"), (2, "drink | more"), (2, "drink | more")],
    "aisles": [(1, "north"), (2, 'the "south"')],
    "products": [(1, "bread", 1, 1), (2, "tea\nand milk", 2, 2), (3, None, None, 1)],
    "location_areas": [(1, "centre")],
    "clients": [(1, "Ann Lee", 1), (2, "Bo Ray", None)],
    "store_types": [(1, "kiosk")],
    "stores": [(1, 1, 1), (2, 1, 1)],
}
# (order, product, client, store, quantity, day); the second line is an exact repeat.
ORDERS = [
    (1, 1, 1, 1, 5, 1), (1, 1, 1, 1, 5, 1), (2, 1, 1, 1, 7, 1), (3, 2, 1, 2, 1, 1),
    (4, 1, 2, 1, 2, 3), (5, 1, 2, 1, 2, 3),
]
FACTS = {
    ("2021-01-01", 1, 1, 1, 12), ("2021-01-01", 2, 1, 2, 1), ("2021-01-03", 1, 2, 1, 4),
}


@pytest.fixture
def layout(spark):
    root = scratch_path(spark, "lake")
    return Layout(f"{root}/bronze", f"{root}/silver", f"{root}/gold")


@pytest.fixture
def source(spark):
    def read(table):
        if table != "orders":
            return spark.createDataFrame(DIMENSIONS[table], SHOP[table])
        rows = [(*r[:5], dt.datetime(2021, 1, r[5], 13, 30)) for r in ORDERS]
        names = ", ".join(f"{n} bigint" for n in SHOP["orders"].names)
        return spark.createDataFrame(rows, f"{names}, order_date timestamp_ntz")

    return read


def facts(spark, layout, table="fact_orders"):
    df = spark.read.parquet(layout.gold_table(table)).select(*GOLD[table].names)
    assert [f.dataType for f in df.schema] == [f.dataType for f in GOLD[table]]
    return Counter((str(r[0]), *r[1:]) for r in df.collect())


def dates(spark, layout):
    return sorted(tuple(r) for r in spark.read.parquet(layout.gold_table("dim_dates")).collect())


def test_days_in_any_order_and_again(spark, layout, source):
    for day in (DAYS[2], DAYS[0], DAYS[1], DAYS[0]):
        medallion.run_day(spark, layout, day, source)
    assert facts(spark, layout) == Counter(FACTS)
    # 2021-01-01 was a Friday.
    assert dates(spark, layout) == [
        (dt.date(2021, 1, 1), 5, False), (dt.date(2021, 1, 2), 6, True), (dt.date(2021, 1, 3), 7, True),
    ]
    for table in schemas.SHOP_DIMENSIONS:
        loaded = spark.read.parquet(layout.gold_table(f"dim_{table}"))
        assert loaded.columns == GOLD[f"dim_{table}"].names
        assert Counter(map(tuple, loaded.collect())) == Counter(set(DIMENSIONS[table]))
        assert violations(loaded, GOLD_RULES[f"dim_{table}"]).count() == 0
    silver = spark.read.parquet(layout.silver_table("orders", DAYS[0]))
    total = sum(q for day, *_, q in FACTS if day == DAYS[0])
    assert silver.agg(F.sum("quantity")).first()[0] == total
    by_department = star.quantity_by_department(spark, layout, DAYS[0], DAYS[2])
    assert {r["department"]: r["quantity"] for r in by_department.collect()} == {"food": 16, "drink | more": 1}


def test_backfill_equals_single_days(spark, layout, source):
    for day in DAYS:
        medallion.land_day(source, layout.bronze, day)
    # Rows of an earlier load, one of them on a day that is now empty.
    old = spark.createDataFrame([(9, 9, 9, 9)], "product_id long, client_id long, store_id long, quantity long")
    for day in (DAYS[0], DAYS[1], "2020-12-31"):
        reload_day(old, layout.gold_table("fact_orders"), day)
    loaded = medallion.backfill_orders(spark, layout, DAYS[0], DAYS[2])
    assert [str(d) for d in loaded] == list(DAYS)
    assert facts(spark, layout) == Counter({*FACTS, ("2020-12-31", 9, 9, 9, 9)})
    medallion.backfill_orders(spark, layout, DAYS[0], DAYS[2])
    assert facts(spark, layout) == Counter({*FACTS, ("2020-12-31", 9, 9, 9, 9)})
    assert len(dates(spark, layout)) == 3


def test_absent_days(spark, layout, source):
    medallion.land_day(source, layout.bronze, DAYS[0])
    with pytest.raises(medallion.MissingDay):
        medallion.backfill_orders(spark, layout, DAYS[0], DAYS[2])
    assert [str(d) for d in medallion.backfill_orders(spark, layout, DAYS[0], DAYS[2], missing="skip")] == [DAYS[0]]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        medallion.run_day(spark, layout, DAYS[1])


def test_out_of_stock(spark, layout):
    for day, products in ((DAYS[0], [3, 3, 4]), (DAYS[1], [])):
        df = spark.createDataFrame([(p,) for p in products], schemas.OUT_OF_STOCK)
        write_json(df, day_path(layout.bronze, "out-of-stock", day, "json"))
    for day in (DAYS[0], DAYS[1], DAYS[0]):
        medallion.run_payload_day(spark, layout, day, files=2)
    assert facts(spark, layout, "fact_oos") == Counter([(DAYS[0], 3), (DAYS[0], 4)])
    assert len(dates(spark, layout)) == 2
    again = Layout(layout.bronze, f"{layout.silver}-2", f"{layout.gold}-2")
    reload_day(spark.createDataFrame([(9,)], schemas.OUT_OF_STOCK), again.gold_table("fact_oos"), DAYS[1])
    with pytest.raises(medallion.MissingDay):
        medallion.backfill_out_of_stock(spark, again, DAYS[0], DAYS[2])
    loaded = medallion.backfill_out_of_stock(spark, again, DAYS[0], DAYS[2], missing="skip")
    assert [str(d) for d in loaded] == list(DAYS[:2])
    assert facts(spark, again, "fact_oos") == facts(spark, layout, "fact_oos")


def test_reload_clears_an_empty_day(spark):
    root = scratch_path(spark, "fact")
    df = spark.createDataFrame([(1,)], "product_id long")
    reload_day(df, root, DAYS[0])
    reload_day(df, root, DAYS[1])
    reload_day(df.limit(0), root, DAYS[0])
    assert [str(r.report_date) for r in spark.read.parquet(root).collect()] == [DAYS[1]]


def test_reload_days_splits_a_hot_day(spark):
    """The day that holds almost all rows is written by several tasks."""
    root = scratch_path(spark, "fact")
    hot, cold = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    df = spark.range(400_000).select(
        F.when(F.col("id") % 100 == 0, F.lit(cold)).otherwise(F.lit(hot)).alias("report_date"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        reload_days(df, root, [hot, cold])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{root}/report_date={hot}") if f.endswith(".parquet")]
    assert len(files) > 3
    assert spark.read.parquet(root).count() == 400_000
    plan = read_days(spark, root, cold, cold)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan


def test_dates(spark):
    spine = date_spine(spark, "2021-02-27", "2021-03-01")
    assert [str(r[0]) for r in spine.collect()] == ["2021-02-27", "2021-02-28", "2021-03-01"]
    existing = spark.createDataFrame([(dt.date(2021, 2, 28), 1, False)], GOLD["dim_dates"])
    added = new_dates(existing, build_dates(spine.union(spine), "report_date"))
    assert sorted(map(tuple, added.collect())) == [
        (dt.date(2021, 2, 27), 6, True), (dt.date(2021, 3, 1), 1, False),
    ]
    data = spark.createDataFrame([(dt.datetime(2021, 2, 28, 23, 59), 1)], "ts timestamp_ntz, n int")
    assert len(days_without_rows(spine, data, "ts").collect()) == 2
    with_gaps = rows_of_days(data, "ts", "2021-02-28", "2021-03-01")
    assert Counter((str(r.report_date), r.n) for r in with_gaps.collect()) == Counter(
        [("2021-02-28", 1), ("2021-03-01", None)]
    )
    assert rows_of_days(data, "ts", "2021-02-28", "2021-03-01", keep_gaps=False).count() == 1


def test_violations(spark):
    df = spark.createDataFrame(
        [(1, "x" * 63, 1), (1, "x" * 64, 1), (None, None, 1), (None, "y", 2)], SHOP["clients"]
    )
    assert Counter(map(tuple, violations(df, GOLD_RULES["dim_clients"]).collect())) == Counter(
        [("not_null", "id", 2), ("max_length", "fullname", 1), ("unique", "id", 4)]
    )


def test_column_types_of_rules_match_schemas():
    for table, rules in GOLD_RULES.items():
        names = set(GOLD[table].names)
        assert {*rules.key, *rules.required, *rules.max_length} <= names
    assert set(GOLD_RULES) == set(GOLD)


def test_any_source_lands_and_becomes_silver(spark, layout):
    """Two databases through the same functions; types declared for one and inferred for the other."""
    tables = {name: SHOP[name] for name in schemas.SILVER_TABLES if name in DIMENSIONS}
    medallion.land_tables(
        lambda t: spark.createDataFrame(DIMENSIONS[t], SHOP[t]), tables, layout.bronze, DAYS[0], sep=","
    )
    other = Layout(f"{layout.bronze}-2", f"{layout.silver}-2", layout.gold)
    sales = spark.createDataFrame([(1, "2021-01-01"), (1, "2021-01-01")], "sales_id int, day string")
    medallion.land_tables(lambda t: sales, ["sales_by_store"], other.bronze, DAYS[0], sep=",")
    silver = medallion.tables_to_silver(spark, layout, tables, DAYS[0], sep=",")
    assert {t: df.count() for t, df in silver.items()} == {t: len(set(DIMENSIONS[t])) for t in tables}
    inferred = medallion.tables_to_silver(spark, other, {"sales_by_store": None}, DAYS[0], sep=",")
    assert [tuple(r) for r in inferred["sales_by_store"].collect()] == [(1, dt.date(2021, 1, 1))]


def at_once(*jobs):
    with ThreadPoolExecutor(len(jobs)) as pool:
        for job in [pool.submit(j) for j in jobs]:
            job.result()


def land_payload(spark, layout, day, products):
    df = spark.createDataFrame([(p,) for p in products], schemas.OUT_OF_STOCK)
    write_json(df, day_path(layout.bronze, "out-of-stock", day, "json"))


def test_orders_and_payload_of_one_day_side_by_side(spark, layout, source):
    for n in range(3):
        own = Layout(layout.bronze, f"{layout.silver}-{n}", f"{layout.gold}-{n}")
        land_payload(spark, own, DAYS[0], [3, 4])
        at_once(
            lambda: medallion.run_day(spark, own, DAYS[0], source), lambda: medallion.run_payload_day(spark, own, DAYS[0])
        )
        assert dates(spark, own) == [(dt.date(2021, 1, 1), 5, False)]
        assert facts(spark, own) == Counter(f for f in FACTS if f[0] == DAYS[0])
        assert facts(spark, own, "fact_oos") == Counter([(DAYS[0], 3), (DAYS[0], 4)])


def test_six_days_side_by_side(spark, layout):
    days = [f"2021-02-0{n}" for n in range(1, 7)]
    for n, day in enumerate(days):
        land_payload(spark, layout, day, [n])
    at_once(*(lambda day=day: medallion.run_payload_day(spark, layout, day) for day in days))
    calendar = spark.read.parquet(layout.gold_table("dim_dates"))
    assert calendar.count() == 6 and violations(calendar, GOLD_RULES["dim_dates"]).count() == 0
    assert facts(spark, layout, "fact_oos") == Counter((day, n) for n, day in enumerate(days))


def test_ranges_side_by_side(spark, layout):
    days = [f"2021-02-0{n}" for n in range(1, 7)]
    for n, day in enumerate(days):
        land_payload(spark, layout, day, [n])
    spans = [(days[0], days[3]), (days[2], days[5])]
    at_once(*(lambda a=a, b=b: medallion.ensure_dates(spark, layout, days_between(a, b)) for a, b in spans))
    assert len(dates(spark, layout)) == 6


@pytest.mark.parametrize(
    "text, options",
    [
        ('[\n  {"product_id": 5},\n  {"product_id": 5}\n]\n', {"multi_line": True}),
        ("[5, 5]\n", {"form": "numbers"}),
        ("[\n 5,\n 5]\n", {"form": "numbers", "multi_line": True}),
    ],
)
def test_payload_forms(spark, layout, text, options):
    path = day_path(layout.bronze, "out-of-stock", DAYS[0], "json").removeprefix("file:")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as out:
        out.write(text)
    medallion.run_payload_day(spark, layout, DAYS[0], **options)
    assert facts(spark, layout, "fact_oos") == Counter([(DAYS[0], 5)])
    medallion.backfill_out_of_stock(spark, layout, DAYS[0], DAYS[0], **options)
    assert facts(spark, layout, "fact_oos") == Counter([(DAYS[0], 5)])


def test_reload_refuses_rows_of_another_day(spark):
    root = scratch_path(spark, "fact")
    df = spark.createDataFrame([(dt.date(2021, 1, 2), 1)], "report_date date, n int")
    with pytest.raises(Exception, match="a row is not of 2021-01-01"):
        reload_day(df, root, DAYS[0])
    reload_day(df, root, DAYS[1])
    assert [str(r.report_date) for r in spark.read.parquet(root).collect()] == [DAYS[1]]
