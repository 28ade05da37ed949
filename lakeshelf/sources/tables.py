"""Whole-table and query scans: Parquet folders, JDBC databases, catalogs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions import on_day
from lakeshelf.sources.files import list_names


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_tables(spark: SparkSession, folder: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    """Named frames for a list of tables; nothing is read yet."""
    return {table: read_table(spark, folder, table) for table in tables}


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make the frames available to ``spark.sql`` under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def folder_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the Parquet tables in a folder."""
    return [n.removesuffix(".parquet") for n in list_names(spark, folder) if n.endswith(".parquet")]


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    relation: str,
    split: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """A table, view or bracketed query with alias of one database.

    ``options`` holds ``url``, ``driver`` and credentials of that source, so the same call
    serves any number of databases. ``split`` is ``(column, lowest, highest, partitions)`` and
    reads a large table by that many parallel range queries instead of one cursor; rows
    outside the bounds still arrive, in the outermost ranges.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", relation)
    if split:
        column, lowest, highest, partitions = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lowest))
            .option("upperBound", str(highest))
            .option("numPartitions", partitions)
        )
    return reader.load()


def jdbc_split(
    spark: SparkSession, options: Mapping[str, str], relation: str, column: str, partitions: int
) -> tuple[str, object, object, int] | None:
    """Bounds for ``read_jdbc``, asked from the database; ``None`` for an empty table."""
    ends = read_jdbc(
        spark,
        options,
        f"(select min({column}) as LO, max({column}) as HI from {relation}) ends",
    ).first()
    return None if ends["LO"] is None else (column, ends["LO"], ends["HI"], partitions)


def jdbc_tables(spark: SparkSession, options: Mapping[str, str], schema: str = "public") -> DataFrame:
    """Table names of a database schema, for databases with an information schema."""
    tables = read_jdbc(spark, options, "information_schema.tables")
    return tables.where(F.col("table_schema") == schema).select("table_name")


def orders_of_day(orders: DataFrame, day: str | dt.date) -> DataFrame:
    """The five landed columns of one day's orders.

    The filter and the columns reach the scan, be it Parquet or JDBC.
    """
    return orders.where(on_day(F.col("order_date"), day)).select(
        "order_id", "product_id", "client_id", "store_id", "quantity"
    )
