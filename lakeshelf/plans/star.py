"""Reads the gold star schema is shaped for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf import schemas
from lakeshelf.operators.aggregates import add_up
from lakeshelf.operators.joins import star_sum
from lakeshelf.sinks.days import read_days
from lakeshelf.sources.layout import Layout


def quantity_by_department(
    spark: SparkSession, layout: Layout, first: str | dt.date, last: str | dt.date
) -> DataFrame:
    """Ordered quantity per department over a range of days."""
    fact = read_days(spark, layout.gold_table("fact_orders"), first, last)
    products, departments = (
        spark.read.schema(schemas.GOLD[name]).parquet(layout.gold_table(name))
        for name in ("dim_products", "dim_departments")
    )
    return star_sum(
        fact,
        [
            (products, "product_id", ["department_id"]),
            (departments, "department_id", ["department_id", "department"]),
        ],
        "product_id",
        ["quantity"],
        ["department_id", "department"],
    )


def quantities_on(facts: DataFrame, dates: DataFrame, wanted: Column, keys: list[str], measure: str) -> DataFrame:
    """``measure`` summed by day and ``keys`` over the days whose row in ``dates`` is ``wanted``.

    The days are not known when the plan is made. ``facts`` is partitioned by ``report_date``, so Spark runs the filter on the
    small ``dates`` first and lists the other days' folders out of the scan (dynamic partition pruning). It does so for a
    comparison, such as ``day_of_week >= 6``, not for a bare flag.
    """
    days = dates.where(wanted).select("report_date")
    return add_up(facts.join(days, "report_date"), ["report_date", *keys], [measure])


def weekend_quantities(spark: SparkSession, layout: Layout) -> DataFrame:
    """Ordered quantity per weekend day and product."""
    facts = spark.read.parquet(layout.gold_table("fact_orders"))
    dates = spark.read.schema(schemas.GOLD["dim_dates"]).parquet(layout.gold_table("dim_dates"))
    return quantities_on(facts, dates, F.col("day_of_week") >= 6, ["product_id"], "quantity")
