"""Landed snapshots as validity intervals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.functions import as_date


def validity(history: DataFrame, days: Sequence[str | dt.date], day: str = "report_date") -> DataFrame:
    """The rows of daily snapshots with ``valid_from`` and ``valid_to``, both inclusive; a null ``valid_to`` is the latest day.

    ``days`` are the landed days (``landed_days``): a row ends on the last one before it is missing, and a day that was never landed ends
    nothing. A changed row is an end and a start, a row that comes back has several intervals, rows repeated within a day
    count once, and rows of other days are left out.

    One shuffle, without a self-join or a window: each distinct row gathers the places of its days, map-side first, so what
    meets in a task is one short sorted list per row (at most the number of days), however often it was landed; runs are
    cut out of that list.
    """
    landed = sorted({as_date(d) for d in days})
    if not landed:
        raise ValueError("no landed day")
    dates = F.array(*(F.lit(d) for d in landed))
    calendar = history.sparkSession.range(1).select(F.posexplode(dates).alias("_place", "_landed"))
    columns = [c for c in history.columns if c != day]
    placed = history.join(calendar, F.col(day).cast("date") == F.col("_landed"))
    rows = placed.groupBy(*columns).agg(F.sort_array(F.collect_set("_place")).alias("_places"))

    def alone(step: int):
        """Places whose neighbour in the list is not the neighbouring day."""
        return F.filter("_places", lambda x, i: F.coalesce(F.get("_places", i + step) != x + step, F.lit(True)))

    runs = F.arrays_zip(alone(-1).alias("first"), alone(1).alias("last"))
    last = F.when(F.col("_run.last") < len(landed) - 1, F.get(dates, F.col("_run.last")))
    spread = rows.select(*columns, F.explode(runs).alias("_run"))
    return spread.select(*columns, F.get(dates, F.col("_run.first")).alias("valid_from"), last.alias("valid_to"))


def as_of(intervals: DataFrame, day: str | dt.date) -> DataFrame:
    """The rows that were valid on a landed day."""
    on = F.lit(as_date(day))
    return intervals.where((F.col("valid_from") <= on) & F.coalesce(F.col("valid_to") >= on, F.lit(True))).drop("valid_from", "valid_to")
