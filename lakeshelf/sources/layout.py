"""Where things lie: dated landing folders, silver tables, gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from lakeshelf.functions import as_date, days_between


@dataclass(frozen=True)
class Layout:
    """Roots of the three zones; any Hadoop file system will do."""

    bronze: str
    silver: str
    gold: str

    def silver_table(self, table: str, day: str | dt.date | None = None) -> str:
        """Silver is kept per day, so that days may run in any order or at the same time.

        Without a day it is the undated folder that each run replaces.
        """
        path = f"{self.silver}/{table}"
        return path if day is None else f"{path}/{as_date(day)}"

    def gold_table(self, table: str) -> str:
        return f"{self.gold}/{table}"


def day_path(root: str, table: str, day: str | dt.date, suffix: str = "csv") -> str:
    """``{root}/{table}/{day}/{table}.{suffix}``"""
    return f"{root}/{table}/{as_date(day)}/{table}.{suffix}"


def days_glob(
    root: str,
    table: str,
    first: str | dt.date | None = None,
    last: str | dt.date | None = None,
    suffix: str = "csv",
    days: Sequence[dt.date] | None = None,
) -> str:
    """One pattern for all days of an inclusive range, or for the given ``days``; only these folders are listed."""
    days = days_between(first, last) if days is None else days
    if not days:
        raise ValueError(f"empty range: {first} to {last}")
    return f"{root}/{table}/{{{','.join(map(str, days))}}}/{table}.{suffix}"
