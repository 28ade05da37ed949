"""Equi-joins: using, left outer, anti, and a star join of sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.operators.aggregates import add_up, carry_up

def join_using(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on equally named columns; each key appears once."""
    return left.join(right, list(keys))


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; a null key has no match.

    The right side is reduced to its distinct keys before the shuffle, so neither its other
    columns nor the repeats of a hot key travel.
    """
    keys = right.select(F.col(right_key).alias("_right_key")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_right_key"), "left_anti")


def left_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join whose many-rows side is ``right``.

    At run time Spark can split a skewed partition on either side of an inner join, but only
    the left side of a left outer join. So the matched rows come from an inner join, and the
    unmatched ones from an anti-join against the distinct keys. Both read the same rows, those
    with a key, so they share the scan and the shuffle of the left side; rows without a key
    are added by a scan that can skip data by statistics. Column names must differ between
    the two sides.
    """
    keyed = left.where(F.col(left_key).isNotNull())
    others = right.where(F.col(right_key).isNotNull())
    matched = keyed.join(others, F.col(left_key) == F.col(right_key))
    unmatched = without_match(keyed, others, left_key, right_key)
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    unmatched = unmatched.unionByName(left.where(F.col(left_key).isNull()))
    return matched.unionByName(unmatched.select("*", *blanks))


def star_sum(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str, Sequence[str]]],
    fact_key: str,
    measures: Sequence[str],
    result: Sequence[str],
) -> DataFrame:
    """Sum a fact by attributes found along a chain of dimensions.

    ``dims`` is a chain of ``(table, join column, columns to carry on)``. The fact is summed
    per foreign key before the first join, so that every dimension meets one row per key.
    Spark chooses between broadcast and shuffle at run time, by the sizes it then knows.
    """
    sums = add_up(fact, [fact_key], measures)
    for dim, on, columns in dims:
        carried = [c for c in sums.columns if c in result]
        sums = carry_up(sums, dim, on, columns, measures, keep=carried)
    return add_up(sums, result, measures)
