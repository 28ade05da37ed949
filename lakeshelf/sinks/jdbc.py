"""JDBC sinks: full replace, capped append, reload of one day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeshelf.functions import as_date


def replace_table(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Replace the rows but keep the target's own column types, keys and indexes."""
    df.write.format("jdbc").mode("overwrite").options(**options).options(
        dbtable=table, truncate=True
    ).save()


def append_rows(df: DataFrame, options: Mapping[str, str], table: str, connections: int = 10) -> None:
    """Append over at most ``connections`` database connections.

    The shuffle keeps the stage before it at full width. Each connection commits its rows
    once; if an executor is lost right after a commit, the repeated task appends them again,
    so reload the day (``reload_day``) after a job that lost executors.
    """
    df.repartition(connections).write.format("jdbc").mode("append").options(**options).options(
        dbtable=table, numPartitions=connections
    ).save()


def delete_day(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    day: str | dt.date,
    date_column: str = "report_date",
) -> None:
    """Delete one day's rows: a single statement that the database runs by itself."""
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(options["driver"])
    login = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            login.setProperty(key, options[key])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], login)
    try:
        statement = connection.prepareStatement(f"delete from {table} where {date_column} = ?")
        statement.setDate(1, jvm.java.sql.Date.valueOf(str(as_date(day))))
        statement.executeUpdate()
    finally:
        connection.close()


def reload_day(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    day: str | dt.date,
    connections: int = 10,
    date_column: str = "report_date",
) -> None:
    """Delete the day, then append it; a repeated run leaves the same rows.

    Not atomic: a run that dies in between leaves the day empty until it is repeated.
    """
    delete_day(df.sparkSession, options, table, day, date_column)
    append_rows(df, options, table, connections)
