"""Column expressions. All are built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: str | dt.date) -> dt.date:
    """Parse a ``YYYY-MM-DD`` job argument; anything else raises ``ValueError``."""
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def days_between(first: str | dt.date, last: str | dt.date) -> list[dt.date]:
    """All days of a range, both ends included."""
    start, end = as_date(first), as_date(last)
    return [start + dt.timedelta(n) for n in range((end - start).days + 1)]


def starts_with_ignoring_case(text: Column, prefix: str) -> Column:
    return F.lower(text).startswith(prefix.lower())


def contains_text(text: Column, part: str) -> Column:
    return text.contains(part)


def on_day(moment: Column, day: str | dt.date) -> Column:
    return within_days(moment, day, day)


def within_days(moment: Column, first: str | dt.date, last: str | dt.date) -> Column:
    """``moment`` falls on one of the days, both ends included.

    A half-open range on the bare column, so that Parquet and JDBC scans can skip data; it
    also holds for plain date columns.
    """
    after = as_date(last) + dt.timedelta(days=1)
    return (moment >= F.lit(as_date(first))) & (moment < F.lit(after))


def whole_days(start: Column, end: Column) -> Column:
    """Calendar days between two moments: 23:00 to 01:00 is one day."""
    return F.datediff(end, start)


def exact_seconds(start: Column, end: Column) -> Column:
    """Exact elapsed seconds as decimal(20,6).

    ``end - start`` needs no time zone for timestamps without one. Its parts are added up as
    a decimal because a sum of day-time intervals overflows 64 bits of microseconds on large
    tables.
    """
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap) * F.lit(86400)
        + F.extract(F.lit("HOUR"), gap) * F.lit(3600)
        + F.extract(F.lit("MINUTE"), gap) * F.lit(60)
        + F.extract(F.lit("SECOND"), gap)
    ).cast("decimal(20,6)")


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(day) + F.lit(1)).cast("smallint")


def is_weekend(day: Column) -> Column:
    return F.weekday(day).isin(5, 6)


def money(amount: Column) -> Column:
    """Exact amounts; sum these, never doubles, whose sum depends on the order."""
    return amount.cast("decimal(18,2)")


def cents(amount: Column) -> Column:
    """An amount in whole cents, rounded as ``money`` rounds it.

    For the widest sum of a plan: adding up 64-bit cents per key costs a fraction of adding
    up decimals, and holds 9e16 per key. Turn the sums back with ``from_cents`` before they
    are carried on.
    """
    return (money(amount) * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(22,2)")
