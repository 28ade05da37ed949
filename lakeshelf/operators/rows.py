"""Whole-row operators: distinct rows, labelled unions, tagging by text pattern."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop exact repeats of whole rows; repeats are removed map-side first."""
    return df.dropDuplicates()


def union_labelled(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """``UNION ALL`` by position, each part marked by a constant first column."""
    marked = [df.select(F.lit(name).alias(label), "*") for name, df in parts.items()]
    return reduce(DataFrame.union, marked)


def tag_rows(df: DataFrame, tags: Mapping[str, Column], name: str) -> DataFrame:
    """One output row per tag whose condition holds; rows without any tag are dropped.

    Replaces one scan and one join chain per condition by a single one.
    """
    held = F.filter(
        F.array(*(F.when(condition, F.lit(tag)) for tag, condition in tags.items())),
        lambda tag: tag.isNotNull(),
    )
    return df.select("*", F.explode(held).alias(name))
