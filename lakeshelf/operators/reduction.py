"""Dropping rows of a fact that can have no partner, before they are shuffled for a join.

Where a join chain keeps few keys of a large fact but too many to broadcast their rows, the keys are turned into a
Bloom filter: a fixed number of bits, of which each key sets two. Spark adds its own run-time filters only where the
filtered table itself is scanned next to the join; here the keys may come out of joins and sums of any kind.

The filter is one uncorrelated scalar subquery of ``bits`` bits (1 MB by default), whatever the number of keys. Its condition
stands on the bare key, so Spark moves it below projections, groupings by that key and other joins to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 1 << 23
MOST_BITS = 1 << 26


def _common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The type in which equal keys have equal hashes."""
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return T.LongType()
    return left if left == right and left in (T.StringType(), T.DateType()) else None


def _places(key: Column, bits: int) -> list[Column]:
    hashed = F.xxhash64(key)
    return [h.bitwiseAND(F.lit(bits - 1).cast("bigint")) for h in (hashed, F.shiftright(hashed, 32))]


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _bit(place: Column) -> Column:
    return place.bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def key_filter(keys: DataFrame, key: Column, bits: int = BITS) -> DataFrame:
    """One row with the filter's words, an array of ``bits / 64`` integers.

    Each task adds up its own keys, so at most ``bits / 64`` rows a task are shuffled and as many meet in the last one.
    """
    set_bits = keys.where(key.isNotNull()).select(F.explode(F.array(*_places(key, bits))).alias("_place"))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("_place")))
    words = set_bits.select(_word(F.col("_place")).alias("_word"), mask.alias("_mask"))
    blank = keys.sparkSession.range(0, bits // 64, numPartitions=1)
    words = words.unionByName(blank.select(F.col("id").cast("int").alias("_word"), F.lit(0).cast("bigint").alias("_mask")))
    words = words.groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    return words.agg(F.sort_array(F.collect_list(F.struct("_word", "_mask")))["_mask"].alias("words"))


def possible_matches(df: DataFrame, keys: DataFrame, on: str, bits: int = BITS) -> DataFrame:
    """Rows of ``df`` but for such whose ``on`` is surely not among those of ``keys``.

    To be followed by an inner or semi join on that column, whose result is the same without it. Every row with a
    partner stays. Of the others, one in 20 stays at a million distinct keys and 2 ** 23 bits; with ten times
    as many keys most stay, and nothing is won. ``keys`` may be null (no key), repeated or empty (nothing stays).
    Keys other than integers, dates and plain strings of one type are not filtered: ``df`` is returned.
    """
    if bits & (bits - 1) or not 64 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be a power of two from 64 to {MOST_BITS}")
    kind = _common_type(df.schema[on].dataType, keys.schema[on].dataType)
    if kind is None:
        return df
    words = key_filter(keys.select(on), F.col(on).cast(kind), bits).scalar()
    tests = [F.getbit(F.get(words, _word(place)), _bit(place)) == 1 for place in _places(F.col(on).cast(kind), bits)]
    return df.where(F.col(on).isNotNull() & tests[0] & tests[1])
