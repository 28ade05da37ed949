"""Top-k and arg-max, with the treatment of ties spelled out.

Rankings over a whole result are not computed by a window without partitions: that sends every
row tied at the cut to one task. Instead the k leading values - at most k rows - are ranked, and
the rows holding one of those values are found by a join with that tiny table. Ties stay spread
over the cluster, however many there are. Both uses of the input share one shuffle, since
``df`` ends in a group-by here (Spark shows ``ReusedExchange``).

Nulls rank last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


MOST_LEADERS = 100_000


def top_k(
    df: DataFrame, by: str, k: int, ties: str = "rank", rank_column: str = "rank"
) -> DataFrame:
    """Rows whose descending rank by ``by`` is at most ``k``, unsorted.

    ``ties="rank"`` leaves gaps after ties, ``"dense_rank"`` ranks distinct values. ``by`` is
    computed twice and compared for equality, so floating-point values, whose sums depend on
    the order of adding, are refused. At most ``k`` rows are broadcast; ``k`` is bounded by
    ``MOST_LEADERS``.
    """
    if isinstance(df.schema[by].dataType, (FloatType, DoubleType)):
        raise TypeError(f"{by} is a floating-point column; rank a decimal or whole number")
    if k > MOST_LEADERS:
        raise ValueError(f"k is at most {MOST_LEADERS}; sort and filter for more")
    if ties not in ("rank", "dense_rank"):
        raise ValueError(f"ties must be 'rank' or 'dense_rank', not {ties!r}")
    order = F.desc_nulls_last("_value")
    values = df.select(F.col(by).alias("_value"))
    # The windows and the broadcast see at most k rows; a single leader needs no window.
    if k == 1:
        ranks = values.agg(F.max("_value").alias("_value")).withColumn(rank_column, F.lit(1).cast("bigint"))
    elif ties == "dense_rank":
        leaders = values.distinct().orderBy(order).limit(k)
        rank = F.row_number().over(Window.orderBy(order)).cast("bigint")
        ranks = leaders.select("_value", rank.alias(rank_column))
    else:
        leaders = values.orderBy(order).limit(k)
        rank = F.rank().over(Window.orderBy(order)).cast("bigint")
        ranks = leaders.select("_value", rank.alias(rank_column)).distinct()
    return df.join(F.broadcast(ranks), F.col(by).eqNullSafe(F.col("_value"))).drop("_value")


def top_k_cut(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """Exactly ``k`` rows in descending order; ``tie_break`` makes the cut repeatable."""
    return df.orderBy(F.desc_nulls_last(by), *tie_break).limit(k)


def leaders_per_group(
    df: DataFrame, by: str, group: str, few_groups: bool = False, rank_column: str | None = None
) -> DataFrame:
    """All rows that hold the maximum of ``by`` within their group (rank 1, ties kept).

    The maxima are combined map-side; no task sees a whole group. Say ``few_groups`` only if
    the group values come from a fixed list, which bounds the broadcast table of maxima.
    """
    best = df.groupBy(F.col(group).alias("_group")).agg(F.max(by).alias("_best"))
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(by).eqNullSafe(F.col("_best"))
    winners = df.join(F.broadcast(best) if few_groups else best, same).drop("_group", "_best")
    return winners.withColumn(rank_column, F.lit(1).cast("bigint")) if rank_column else winners
