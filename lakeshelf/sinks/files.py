"""File sinks. Each replaces its folder; every task writes its own files.

Parquet is written aside and swapped in (see ``lakeshelf.sinks.swap``), so a write that fails leaves the old rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from lakeshelf.sinks.swap import replace_folder


def with_file_count(df: DataFrame, files: int | None) -> DataFrame:
    """At most ``files`` output files, or files of the advisory partition size.

    The given number is reached by a shuffle, not by ``coalesce``, which would also squeeze the
    stage before it into that many tasks. Without a number the rebalance hint lets Spark cut
    files to size, also where one partition is much larger than the others.
    """
    return df.repartition(files) if files else df.hint("rebalance")


# Moments keep their microseconds; Spark's own formats stop at three digits.
_MOMENTS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# A null in a frame of one column would be an empty line, which readers skip; a second column prevents that.
FILLER = "_filler"
#: Rows of a CSV file. Values may hold line breaks, so a file is read by one task.
ROWS_PER_FILE = 500_000


def csv_writer(df: DataFrame, sep: str = ",") -> DataFrameWriter:
    """A writer of CSV with header in the form that ``read_csv`` reads back value for value; ``df`` without its partition columns."""
    return df.write.mode("overwrite").options(
        header=True,
        **_MOMENTS,
        sep=sep,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_csv(df: DataFrame, path: str, sep: str = ",", gather: bool = False) -> None:
    """CSV in files of at most ``ROWS_PER_FILE`` rows.

    Each task writes the rows it has: a large table is not shuffled once more only to cut its files to size. With ``gather`` it is, for a
    few rows out of many tasks, which would else make a small file each.
    """
    if len(df.columns) == 1:
        df = df.withColumn(FILLER, F.lit(1))
    rows = with_file_count(df, None) if gather else df
    csv_writer(rows, sep).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are written, so every line has every field."""
    df.write.mode("overwrite").options(ignoreNullFields=False, **_MOMENTS).json(path)


def as_array_documents(df: DataFrame, columns: Sequence[str], per_document: int = 1000) -> DataFrame:
    """JSON array documents of at most ``per_document`` objects, or bare values for one column.

    Rows are numbered within their partition and cut into runs, so a document never outgrows
    its limit, whatever the data holds. Documents of one item need no shuffle. Pass a scan: a task that is repeated after a lost
    executor numbers the rows of a file as before, but not those of a shuffle.
    """
    item = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
    if per_document == 1:
        return df.select(F.to_json(F.array(item)).alias("value"))
    run = F.expr(f"monotonically_increasing_id() DIV {per_document}")
    grouped = df.select(item.alias("item"), run.alias("run")).groupBy("run")
    return grouped.agg(F.to_json(F.collect_list("item")).alias("value")).select("value")


def write_array_document(df: DataFrame, path: str) -> None:
    """All rows as one JSON array in one file, an object per line, as a service sends it.

    One file is written by one task. ``as_array_documents`` makes many documents instead; prefer it where the format is yours to choose.
    """
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    items = df.select(F.lit(1).alias("part"), F.monotonically_increasing_id().alias("at"), text.alias("value"))
    first = items.agg(F.min("at")).first()[0]
    marks = df.sparkSession.createDataFrame([(0, 0, "["), (2, 0, "]")], "part int, at bigint, value string")
    lines = items.unionByName(marks).repartition(1).sortWithinPartitions("part", "at")
    comma = F.when((F.col("part") == 1) & (F.col("at") != F.lit(first)), ",").otherwise("")
    lines.select(F.concat(comma, "value").alias("value")).write.mode("overwrite").text(path)


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    rows = with_file_count(df, files)
    replace_folder(df.sparkSession, path, lambda staged: rows.write.parquet(staged))
