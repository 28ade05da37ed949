"""Grouped counts and sums, arranged so that a hot key is reduced before it is shuffled.

A chain "fact - bridge - bridge - dimension" is not joined row by row and grouped at the end.
The fact is summed per foreign key first and the sums are carried from key to key: a key that
holds a third of all rows reaches the first join as one row. The shuffle of each sum also
partitions its result by the key of the next join, so no join of the chain shuffles the sums a
second time. Counts and sums may be carried because a join multiplies a partial sum exactly as
it would multiply the rows behind it.

If the *other* table of the next join may hold very many rows of one key (a bridge, not a
dimension), say ``splittable``. Spark splits a skewed join partition only if both inputs come
straight from a shuffle made for that join. Grouping also by a hash of the key changes no
group, but makes Spark shuffle the finished sums - one row per key - once more for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _grouped(df: DataFrame, by: Sequence[str], sums: Sequence[Column], splittable: bool) -> DataFrame:
    if not splittable:
        return df.groupBy(*by).agg(*sums)
    return df.groupBy(*by, F.xxhash64(*by).alias("_hash")).agg(*sums).drop("_hash")


def count_rows(
    df: DataFrame, by: Sequence[str] = (), name: str = "cnt", splittable: bool = False
) -> DataFrame:
    return _grouped(df, by, [F.count(F.lit(1)).alias(name)], splittable)


def add_up(
    df: DataFrame, by: Sequence[str], measures: Sequence[str], splittable: bool = False
) -> DataFrame:
    """Sum each measure per group, keeping its name."""
    return _grouped(df, by, [F.sum(m).alias(m) for m in measures], splittable)


def carry_up(
    sums: DataFrame,
    via: DataFrame,
    on: str,
    to: Sequence[str],
    measures: Sequence[str],
    keep: Sequence[str] = (),
    splittable: bool = False,
) -> DataFrame:
    """Move sums per ``on`` to sums per ``to`` through the table ``via``.

    ``keep`` names further grouping columns of ``sums``. Rows without a partner are dropped,
    as in an inner join.
    """
    columns = [on, *(c for c in to if c != on)]
    return add_up(sums.join(via.select(*columns), on), [*to, *keep], measures, splittable)


def flag_count(condition: Column) -> Column:
    """How many rows satisfy the condition; an unknown condition does not count."""
    return F.sum(F.when(condition, 1).otherwise(0))
