"""Fact tables on Parquet, one folder per ``report_date``, reloaded by day."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions import as_date
from lakeshelf.sinks.files import write_parquet
from lakeshelf.sinks.swap import NEW, recover, recover_all, staged_path, swap
from lakeshelf.sources.files import list_names, mark_finished, remove, rename

DAY = "report_date"


def reload_day(df: DataFrame, root: str, day: str | dt.date, files: int | None = None) -> None:
    """Replace one day's folder. A day without rows is cleared, too; rows of another day raise."""
    if DAY in df.columns:
        same = F.col(DAY).cast("date") == F.lit(as_date(day))
        df = df.where(F.assert_true(same, F.lit(f"a row is not of {day}")).isNull())
    write_parquet(df.drop(DAY), f"{root}/{DAY}={as_date(day)}", files)


def reload_days(df: DataFrame, root: str, days: Iterable[dt.date]) -> None:
    """Replace several days by one job; a day without rows is cleared, rows of other days raise.

    Rows are gathered by day to avoid a file per task and day; the rebalance splits a day that is larger than a file should be over
    several tasks. All days are written aside first and then swapped in one by one, so a job that fails leaves every day old or new,
    none empty. The driver lists the days that were asked for and renames their folders; it sees no values of the data.
    """
    spark, wanted = df.sparkSession, sorted({as_date(d) for d in days})
    known = F.col(DAY).cast("date").isin(wanted) if wanted else F.lit(False)
    rows = df.where(F.assert_true(F.coalesce(known, F.lit(False)), F.lit("a row is of none of the days")).isNull())
    batch = f"{root}/{NEW}batch.{uuid.uuid4().hex}"
    rows.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(batch)
    filled = swap_days(spark, batch, lambda day: f"{root}/{DAY}={day}")
    for day in wanted:
        if str(day) not in filled:
            reload_day(df.limit(0), root, day)


def swap_days(spark: SparkSession, batch: str, target: Callable[[str], str]) -> set[str]:
    """Put each day's folder of a finished write ``batch``, partitioned by day, in the place that ``target`` names; returns the days."""
    days = {name.partition("=")[2] for name in list_names(spark, batch)}
    for day in sorted(days):
        place = target(day)
        recover(spark, place, tidy=True)
        staged = staged_path(place)
        rename(spark, f"{batch}/{DAY}={day}", staged)
        mark_finished(spark, staged)
        swap(spark, staged, place)
    remove(spark, batch)
    return days


def read_days(spark: SparkSession, root: str, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """Fact rows of an inclusive day range; other days' folders are not read. A swap that died is finished first."""
    recover_all(spark, root)
    return spark.read.parquet(root).where(F.col(DAY).between(F.lit(as_date(first)), F.lit(as_date(last))))
