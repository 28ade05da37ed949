"""Dated CSV snapshots as a database's COPY writes them.

Quotes inside a value are doubled, values may hold line breaks, a null is an empty field and
an empty text is a pair of quotes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeshelf.functions import days_between
from lakeshelf.session import scratch_path
from lakeshelf.sinks.files import FILLER
from lakeshelf.sources.files import exists, list_names
from lakeshelf.sources.layout import day_path, days_glob


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a CSV file or folder; only a first line is read."""
    return spark.read.options(header=True, sep=sep, quote='"', escape='"').csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    sep: str = ",",
    multi_line: bool = True,
    by_name: bool = False,
) -> DataFrame:
    """CSV with a header line.

    Values that do not fit the declared schema raise instead of turning into nulls, and so does
    a header with other names. With ``by_name`` the header may hold further columns, in any
    order; they are not read. Without a schema the types are inferred, which costs another
    pass. ``multi_line`` is needed for
    values with line breaks; each file is then read by one task, so land many files
    (``write_csv`` does). Switch it off for tables without free text to split large files.
    """
    reader = _reader(spark, sep, multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path).drop(FILLER)
    whole = _columns_in_file(spark, path, schema, sep, by_name)
    rows = reader.options(mode="FAILFAST", enforceSchema=False).schema(whole).csv(path)
    return rows.select(*schema.names)


def _reader(spark: SparkSession, sep: str, multi_line: bool) -> DataFrameReader:
    # With a marker for null, the reader tells an empty field (null) from an empty text in
    # quotes. Fields equal to the marker become null, so it is a new random text each time.
    marker = f"\u0001{uuid.uuid4().hex}"
    return spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=multi_line, nullValue=marker)


def _columns_in_file(spark: SparkSession, path: str, schema: StructType, sep: str, by_name: bool) -> StructType:
    """The declared columns in the order of the file, with those that are not declared."""
    if not by_name and len(schema) > 1:
        return schema
    names = header_of(spark, path, sep)
    absent = [n for n in schema.names if n not in names]
    if by_name and names and absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    if names and (by_name or names == [*schema.names, FILLER]):
        return StructType([schema[n] if n in schema.names else StructField(n, StringType()) for n in names])
    return schema


class TooManyBadRows(ValueError):
    """More rows than allowed do not fit the schema; they have been set aside and are named in the message."""


@dataclass(frozen=True)
class Parsed:
    """The rows that fit their schema, and ``bad`` (file, record) with the text of those that do not."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def read_csv_apart(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    multi_line: bool = False,
    by_name: bool = False,
    most_bad: float = 0.1,
) -> Parsed:
    """CSV whose bad lines are set aside instead of stopping the load.

    A line is bad if it has too few or too many fields, or a value that does not fit its column's type. The files are parsed once:
    good and bad rows are written to the shared scratch folder by one job, which counts both on its way, and read from there. More than
    ``most_bad`` of all rows (0.1 is a tenth) raise ``TooManyBadRows``. A header with other names raises as in ``read_csv``: then all rows
    are wrong. With ``multi_line`` a quote that is never closed takes all lines up to the next quote with it.
    """
    whole, record = _columns_in_file(spark, path, schema, sep, by_name), f"_record_{uuid.uuid4().hex}"
    reader = _reader(spark, sep, multi_line).options(mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=record)
    rows = reader.schema(StructType([*whole.fields, StructField(record, StringType())])).csv(path)
    is_bad = F.col(record).isNotNull()
    counts, aside = Observation(), scratch_path(spark, "parsed")
    (
        rows.select(
            F.struct(*(F.col(f"`{n}`") for n in schema.names)).alias("row"),
            F.col("_metadata.file_path").alias("file"),
            F.col(record).alias("record"),
            is_bad.cast("int").alias("bad"),
        )
        .observe(counts, F.count(F.lit(1)).alias("n"), F.count_if(F.col("bad") == 1).alias("n_bad"))
        .write.partitionBy("bad")
        .parquet(aside)
    )
    n, n_bad = counts.get["n"], counts.get["n_bad"]
    parsed = spark.read.schema(_parsed_schema(schema)).parquet(aside)
    if n_bad > most_bad * n:
        raise TooManyBadRows(f"{n_bad} of {n} rows of {path} do not fit their schema; see {aside}/bad=1")
    good = parsed.where("bad = 0").select("row.*")
    return Parsed(good, parsed.where("bad = 1").select("file", "record"), n - n_bad, n_bad)


def _parsed_schema(schema: StructType) -> StructType:
    texts = [StructField(n, StringType()) for n in ("file", "record")]
    return StructType([StructField("row", schema), *texts, StructField("bad", IntegerType())])


def read_snapshot(
    spark: SparkSession,
    root: str,
    table: str,
    day: str | dt.date,
    schema: StructType | None = None,
    sep: str = ",",
    multi_line: bool = True,
) -> DataFrame:
    """One table as landed on one day. A day that was never landed raises ``PATH_NOT_FOUND``."""
    return read_csv(spark, day_path(root, table, day), schema, sep, multi_line)


def read_snapshots(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, StructType],
    day: str | dt.date,
    sep: str = ",",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Named frames of the tables landed on one day, with the declared columns of each."""
    return {
        table: read_csv(spark, day_path(root, table, day), schema, sep, multi_line, by_name=True)
        for table, schema in tables.items()
    }


def read_history(
    spark: SparkSession,
    root: str,
    table: str,
    first: str | dt.date,
    last: str | dt.date,
    schema: StructType,
    sep: str = ",",
    multi_line: bool = True,
) -> DataFrame:
    """All landed days of an inclusive range in one scan, with the day from the path."""
    rows = read_csv(spark, days_glob(root, table, first, last), schema, sep, multi_line)
    return rows.select(day_of_file(table), "*")


def day_of_file(table: str, name: str = "report_date", file: str = "_metadata.file_path") -> Column:
    """The day in the path of the file a row was read from; ``file`` is the column with that path."""
    day = F.regexp_extract(F.col(file), rf"/{table}/(\d{{4}}-\d\d-\d\d)/{table}\.", 1)
    return F.to_date(day).alias(name)


def landed_days(
    spark: SparkSession,
    root: str,
    table: str,
    first: str | dt.date,
    last: str | dt.date,
    suffix: str = "csv",
) -> list[dt.date]:
    """Days of an inclusive range that have a snapshot, be it an empty one."""
    folders = set(list_names(spark, f"{root}/{table}"))
    return [
        day
        for day in days_between(first, last)
        if str(day) in folders and exists(spark, day_path(root, table, day, suffix))
    ]
