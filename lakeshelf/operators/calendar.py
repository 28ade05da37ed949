"""Date spines, the date dimension and gaps in daily data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions import as_date, is_weekend, iso_weekday, within_days
from lakeshelf.operators.joins import without_match


def date_spine(
    spark: SparkSession, first: str | dt.date, last: str | dt.date, name: str = "report_date"
) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(as_date(first)), F.lit(as_date(last)))
    return spark.range(1).select(F.explode(days).alias(name))


def spine_of(df: DataFrame, date_column: str, name: str = "report_date") -> DataFrame:
    """One row per day from the earliest to the latest date in the data."""
    ends = df.agg(
        F.min(date_column).cast("date").alias("first"), F.max(date_column).cast("date").alias("last")
    ).where(F.col("first").isNotNull())
    return ends.select(F.explode(F.sequence("first", "last")).alias(name))


def days_without_rows(spine: DataFrame, df: DataFrame, date_column: str) -> DataFrame:
    """Days of the spine on which the data has no row."""
    present = df.select(F.col(date_column).cast("date").alias("_day"))
    return without_match(spine, present, spine.columns[0], "_day")


def rows_of_days(
    df: DataFrame,
    date_column: str,
    first: str | dt.date,
    last: str | dt.date,
    name: str = "report_date",
    keep_gaps: bool = True,
) -> DataFrame:
    """Rows of an inclusive day range, marked with their day.

    A day without rows appears once with nulls, or not at all with ``keep_gaps=False``. The
    rows themselves come from a range filter: joining them to the days would gather each
    whole day under one key.
    """
    landed = df.where(within_days(F.col(date_column), first, last)).select(
        F.col(date_column).cast("date").alias(name), "*"
    )
    if not keep_gaps:
        return landed
    gaps = days_without_rows(date_spine(df.sparkSession, first, last, name), landed, name)
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return landed.unionByName(gaps.select(name, *blanks))


def build_dates(days: DataFrame, date_column: str) -> DataFrame:
    """Date dimension rows for the distinct days of a column."""
    day = F.col("report_date")
    return (
        days.select(F.col(date_column).cast("date").alias("report_date"))
        .where(day.isNotNull())
        .distinct()
        .select("report_date", iso_weekday(day).alias("day_of_week"), is_weekend(day).alias("is_holiday"))
    )


def new_dates(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Date rows that the dimension does not hold yet."""
    return without_match(candidates, existing, "report_date", "report_date")
