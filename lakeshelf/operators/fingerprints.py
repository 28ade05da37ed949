"""Fingerprints of row sets: equal for equal rows in any order, and additive over parts.

A set of rows becomes its number of rows and the sums of two 64-bit hashes of its rows, as exact decimals. Sums do not depend on
order, count repeated rows, are combined map-side, and those of two sets add up to that of both. Two sets that differ share a fingerprint
only if both sums agree by chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

PARTS = ("n_rows", "hash_a", "hash_b")
_SUM = "decimal(38,0)"


def row_hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of a row.

    Spark's hash skips nulls, inside of arrays and structs as well, so plain columns go in with a null flag, and nested ones as JSON texts.
    """
    parts: list[Column] = [F.lit(seed)]
    for name in columns:
        column, kind = F.col(f"`{name}`"), df.schema[name].dataType
        nested = isinstance(kind, (ArrayType, MapType, StructType, VariantType))
        parts += [F.to_json(column, {"ignoreNullFields": "false"}) if nested else column, column.isNull()]
    return F.xxhash64(*parts)


def fingerprint(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``(by..., n_rows, hash_a, hash_b)`` of ``df`` by its ``by`` columns; ``columns`` are all others by default, in any order."""
    columns = sorted(c for c in df.columns if c not in by) if columns is None else sorted(columns)
    hashes = [row_hash(df, columns, seed).cast("decimal(20,0)") for seed in (1, 2)]
    rows = df.select(*by, hashes[0].alias("hash_a"), hashes[1].alias("hash_b"))
    sums = [F.sum(c).cast(_SUM).alias(c) for c in PARTS[1:]]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def add_fingerprints(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fingerprints of unions from those of their parts."""
    return parts.groupBy(*by).agg(*(F.sum(c).cast("bigint" if c == "n_rows" else _SUM).alias(c) for c in PARTS))


def changed(new: DataFrame, known: DataFrame, by: Sequence[str]) -> DataFrame:
    """The ``by`` values of ``new`` whose fingerprint ``known`` lacks or has otherwise; a missing one counts as no rows."""
    both = new.select(*by, F.struct(*PARTS).alias("new")).join(known.select(*by, F.struct(*PARTS).alias("known")), list(by), "left")
    return both.where(~F.col("new").eqNullSafe(F.col("known"))).select(*by)
