"""Checks of gold-table rules, each returning what breaks them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType

from lakeshelf.operators.aggregates import count_rows
from lakeshelf.schemas import Reference, Rules


def repeated_keys(df: DataFrame, key: Sequence[str], name: str = "cnt") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return count_rows(df, key, name).where(F.col(name) > 1)


def column_violations(df: DataFrame, rules: Rules) -> DataFrame:
    """``(rule, column_name, n_rows)`` for null and length rules, counted in one pass.

    Only broken rules are returned.
    """
    checks = [("not_null", c, F.col(c).isNull()) for c in rules.required]
    checks += [("max_length", c, F.length(c) > n) for c, n in rules.max_length.items()]
    counts = df.agg(*(F.count_if(broken).alias(f"n{i}") for i, (_, _, broken) in enumerate(checks)))
    found = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_rows")
            )
            for i, (rule, c, _) in enumerate(checks)
        )
    )
    return counts.select(F.inline(found)).where(F.col("n_rows") > 0)


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """All broken rules of a gold table as ``(rule, column_name, n_rows)``."""
    found = column_violations(df, rules) if rules.required or rules.max_length else None
    if rules.key:
        repeats = (
            repeated_keys(df, rules.key)
            .agg(F.sum("cnt").alias("n_rows"))
            .where(F.col("n_rows") > 0)
            .select(
                F.lit("unique").alias("rule"), F.lit(",".join(rules.key)).alias("column_name"), "n_rows"
            )
        )
        found = repeats if found is None else found.unionByName(repeats)
    if found is None:
        raise ValueError("no rule to check")
    return found


def orphan_keys(tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """Keys that a table holds and its target lacks: ``(table_name, column_name, target, key, n_rows)``, for all references at once.

    Every table is read once. Its keys, one row per reference, are stacked with the keys of the targets, and a single
    grouping by (target, key) tells which were never seen in the target: one shuffle for all references, where an anti-join each would
    take two. Counts are made before the shuffle, so a key with a third of all rows travels as one row a task.

    Keys are compared as whole numbers if all of them are whole numbers or dates, else as texts, those of several columns as JSON
    arrays. A key with a null column refers to nothing. ``key`` is returned as text.
    """
    if not references:
        raise ValueError("no reference to check")
    sides = [(r.table, r.columns) for r in references] + [(r.target, r.target_columns) for r in references]
    kinds = [tables[t].schema[c].dataType for t, columns in sides for c in columns]
    plain = all(len(columns) == 1 for _, columns in sides) and all(isinstance(k, (IntegralType, DateType)) for k in kinds)

    def key(table: str, columns: Sequence[str]) -> Column:
        if not plain:
            texts = [F.col(c).cast("string") for c in columns]
            return texts[0] if len(texts) == 1 else F.when(reduce(Column.__and__, (t.isNotNull() for t in texts)), F.to_json(F.array(*texts)))
        days = isinstance(tables[table].schema[columns[0]].dataType, DateType)
        return F.unix_date(columns[0]).cast("bigint") if days else F.col(columns[0]).cast("bigint")

    targets = sorted({(r.target, r.target_columns) for r in references})
    place = {t: i for i, t in enumerate(targets)}
    stacked = []
    for name in dict.fromkeys(t for t, _ in sides):
        # As a target first (reference -1), then once for each reference it makes.
        entries = [(i, -1, columns) for (t, columns), i in place.items() if t == name]
        entries += [(place[r.target, r.target_columns], i, r.columns) for i, r in enumerate(references) if r.table == name]
        items = [F.struct(F.lit(t).alias("target"), F.lit(r).alias("ref"), key(name, c).alias("key")) for t, r, c in entries]
        stacked.append(tables[name].select(F.inline(F.array(*items))).where(F.col("key").isNotNull()))
    counts = [F.count_if(F.col("ref") == i).alias(f"n{i}") for i in range(len(references))]
    keys = reduce(DataFrame.unionByName, stacked).groupBy("target", "key")
    lost = keys.agg(F.max(F.col("ref") == -1).alias("known"), *counts).where("NOT known")

    def text(target: int) -> Column:
        t, columns = targets[target]
        days = plain and isinstance(tables[t].schema[columns[0]].dataType, DateType)
        return (F.date_from_unix_date(F.col("key").cast("int")) if days else F.col("key")).cast("string")

    found = [
        F.struct(
            F.lit(r.table).alias("table_name"),
            F.lit(r.name).alias("column_name"),
            F.lit(r.target).alias("target"),
            text(place[r.target, r.target_columns]).alias("key"),
            F.col(f"n{i}").alias("n_rows"),
        )
        for i, r in enumerate(references)
    ]
    return lost.select(F.inline(F.array(*found))).where(F.col("n_rows") > 0)


def reference_violations(tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """Broken references as ``(rule, table_name, column_name, n_keys, n_rows)``."""
    lost = orphan_keys(tables, references).groupBy("table_name", "column_name")
    sums = lost.agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    return sums.select(F.lit("reference").alias("rule"), "table_name", "column_name", "n_keys", "n_rows")
