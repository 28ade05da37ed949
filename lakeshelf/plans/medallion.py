"""The daily pipeline: land (bronze), deduplicate (silver), star schema (gold).

``run_day`` and ``run_payload_day`` call the stages in order; ``backfill_orders`` and
``backfill_out_of_stock`` load a range of landed days by one job. All stages replace what they
write, so a repeated day gives the same tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshelf import schemas
from lakeshelf.functions import as_date, days_between
from lakeshelf.operators.aggregates import add_up
from lakeshelf.operators.calendar import build_dates
from lakeshelf.operators.fingerprints import PARTS, changed, fingerprint
from lakeshelf.operators.rows import distinct_rows
from lakeshelf.sinks.days import DAY, read_days, reload_day, reload_days, swap_days
from lakeshelf.sinks.files import FILLER, csv_writer, write_csv, write_parquet
from lakeshelf.sinks.swap import NEW
from lakeshelf.session import scratch_path
from lakeshelf.sources.files import exists, list_names, publish
from lakeshelf.sources.layout import Layout, day_path, days_glob
from lakeshelf.sources.payloads import read_json_array, read_json_numbers, read_json_objects, read_number_array
from lakeshelf.sources.snapshots import day_of_file, landed_days, read_csv, read_csv_apart, read_snapshot
from lakeshelf.sources.tables import orders_of_day

Day = str | dt.date
Source = Callable[[str], DataFrame]

SEPARATOR = "|"


class MissingDay(LookupError):
    """A day of the range was never landed; this is not the same as an empty day."""


# --- bronze -----------------------------------------------------------------------------


def land_table(df: DataFrame, root: str, table: str, day: Day, sep: str = SEPARATOR, gather: bool = False) -> None:
    """A whole table; ``gather`` is for a few rows of a large one (see ``write_csv``)."""
    write_csv(df, day_path(root, table, day), sep, gather)


def land_days(df: DataFrame, root: str, table: str, sep: str = SEPARATOR) -> None:
    """One snapshot for each ``report_date`` of ``df``, all by one job; the day is in the path, not in the files.

    The snapshots are written aside and swapped in day by day; days without rows are not touched.
    """
    rows = df.withColumn(FILLER, F.lit(1)) if len(df.columns) == 2 else df
    batch = f"{root}/{table}/{NEW}batch.{uuid.uuid4().hex}"
    csv_writer(rows.hint("rebalance", F.col(DAY)), sep).partitionBy(DAY).csv(batch)
    swap_days(df.sparkSession, batch, lambda day: day_path(root, table, day))


def land_tables(
    source: Source, tables: Iterable[str], root: str, day: Day, sep: str = SEPARATOR
) -> None:
    """Snapshots of all named tables of one source, each whole."""
    for table in tables:
        land_table(source(table), root, table, day, sep)


def land_day(source: Source, root: str, day: Day, sep: str = SEPARATOR) -> None:
    """Snapshots of all dimensions and the day's orders."""
    for table in schemas.SHOP_DIMENSIONS:
        names = schemas.SHOP[table].names
        land_table(source(table).select(*names), root, table, day, sep)
    land_table(orders_of_day(source("orders"), day), root, "orders", day, sep, gather=True)


# --- silver -----------------------------------------------------------------------------


def snapshot_to_silver(
    spark: SparkSession,
    layout: Layout,
    table: str,
    day: Day,
    schema: StructType | None,
    sep: str = SEPARATOR,
    files: int | None = None,
    most_bad: float | None = None,
) -> DataFrame:
    """Landed snapshot without repeated rows, as Parquet; no schema means inferred types.

    Whole rows are compared: two order lines equal in every column, order id included,
    become one. With a share ``most_bad`` lines that do not fit the schema are written to the table ``rejected_<table>`` of silver, and
    more than that share raise before silver is touched; without it any such line raises.
    """
    if most_bad is None or schema is None:
        rows = read_snapshot(spark, layout.bronze, table, day, schema, sep)
    else:
        parsed = read_csv_apart(spark, day_path(layout.bronze, table, day), schema, sep, most_bad=most_bad)
        write_parquet(parsed.bad, layout.silver_table(f"rejected_{table}", day))
        rows = parsed.good
    path = layout.silver_table(table, day)
    write_parquet(distinct_rows(rows), path, files)
    return spark.read.parquet(path)


def tables_to_silver(
    spark: SparkSession,
    layout: Layout,
    tables: Mapping[str, StructType | None],
    day: Day,
    sep: str = SEPARATOR,
    files: int | None = None,
) -> dict[str, DataFrame]:
    return {
        table: snapshot_to_silver(spark, layout, table, day, schema, sep, files)
        for table, schema in tables.items()
    }


def read_payload(
    spark: SparkSession, path: str, form: str = "objects", multi_line: bool = False, split: bool = False, file: str | None = None
) -> DataFrame:
    """Out-of-stock documents of either form: arrays of objects, or ``"numbers"`` for arrays of bare ids.

    ``multi_line`` is for documents spread over lines, one per file; with ``split`` many tasks read one such document, and ``file`` names
    a column for its path.
    """
    if form not in ("objects", "numbers"):
        raise ValueError(f"form must be 'objects' or 'numbers', not {form!r}")
    if split:
        return read_json_array(spark, path, file=file) if form == "objects" else read_number_array(spark, path, file=file)
    if form == "objects":
        return read_json_objects(spark, path, multi_line=multi_line)
    return read_json_numbers(spark, path, multi_line=multi_line)


def payload_to_silver(
    spark: SparkSession,
    layout: Layout,
    day: Day,
    files: int | None = None,
    form: str = "objects",
    multi_line: bool = False,
    split: bool = False,
) -> DataFrame:
    """The day's out-of-stock documents without repeated rows, as Parquet."""
    rows = read_payload(spark, day_path(layout.bronze, "out-of-stock", day, "json"), form, multi_line, split)
    path = layout.silver_table("oos", day)
    write_parquet(distinct_rows(rows), path, files)
    return spark.read.parquet(path)


# --- gold -------------------------------------------------------------------------------


def load_dimension(layout: Layout, table: str, silver: DataFrame, files: int | None = None) -> None:
    """Replace ``dim_<table>``, columns in declared order."""
    columns = schemas.GOLD[f"dim_{table}"].names
    write_parquet(silver.select(*columns), layout.gold_table(f"dim_{table}"), files)


def roll_up_day(
    orders: DataFrame,
    day: Day,
    keys: Sequence[str] = schemas.FACT_ORDERS_KEYS,
    measure: str = "quantity",
) -> DataFrame:
    """One day's fact rows: the measure per key, marked with the day."""
    sums = add_up(orders, keys, [measure])
    return sums.select(F.lit(as_date(day)).alias("report_date"), *keys, measure)


def roll_up_days(
    orders: DataFrame,
    keys: Sequence[str] = schemas.FACT_ORDERS_KEYS,
    measure: str = "quantity",
) -> DataFrame:
    """The same for rows that carry their ``report_date``."""
    return add_up(orders, ["report_date", *keys], [measure])


def out_of_stock_day(silver: DataFrame, day: Day) -> DataFrame:
    return silver.select(F.lit(as_date(day)).alias("report_date"), "product_id")


def ensure_dates(spark: SparkSession, layout: Layout, days: Iterable[Day]) -> None:
    """Add the days that ``dim_dates`` does not hold; present rows stay as they are.

    The table has one file per day, named by it, and a file is written aside and moved to its
    place when it is finished. So loads may run side by side: of two that add the same day
    one file is left, and both files would hold the same row. The number of files is that of
    the calendar's days.
    """
    path = layout.gold_table("dim_dates")
    present = set(list_names(spark, path)) if exists(spark, path) else set()
    wanted = sorted({as_date(d) for d in days if f"{as_date(d)}.parquet" not in present})
    if not wanted:
        return
    aside = scratch_path(spark, "dates")
    rows = build_dates(_days_frame(spark, wanted), "report_date").withColumn("_day", F.col("report_date"))
    rows.write.partitionBy("_day").parquet(aside)
    for day in wanted:
        folder = f"{aside}/_day={day}"
        (file,) = list_names(spark, folder)
        publish(spark, f"{folder}/{file}", f"{path}/{day}.parquet")


def _days_frame(spark: SparkSession, days: Sequence[Day]) -> DataFrame:
    return spark.createDataFrame([(as_date(d),) for d in days], "report_date date")


def load_orders_day(
    spark: SparkSession, layout: Layout, silver: DataFrame, day: Day, files: int | None = None
) -> None:
    ensure_dates(spark, layout, [day])
    reload_day(roll_up_day(silver, day), layout.gold_table("fact_orders"), day, files)


def load_out_of_stock_day(
    spark: SparkSession, layout: Layout, silver: DataFrame, day: Day, files: int | None = None
) -> None:
    ensure_dates(spark, layout, [day])
    reload_day(out_of_stock_day(silver, day), layout.gold_table("fact_oos"), day, files)


# --- whole runs -------------------------------------------------------------------------


def run_day(
    spark: SparkSession,
    layout: Layout,
    day: Day,
    source: Source | None = None,
    sep: str = SEPARATOR,
    files: int | None = None,
) -> None:
    """All stages of one day, each for all tables before the next stage begins.

    Without a ``source`` the day must be landed already; a missing snapshot raises before
    anything in gold is touched.
    """
    if source is not None:
        land_day(source, layout.bronze, day, sep)
    silver = tables_to_silver(spark, layout, schemas.SHOP, day, sep, files)
    for table in schemas.SHOP_DIMENSIONS:
        load_dimension(layout, table, silver[table], files)
    load_orders_day(spark, layout, silver["orders"], day, files)


def run_payload_day(
    spark: SparkSession,
    layout: Layout,
    day: Day,
    files: int | None = None,
    form: str = "objects",
    multi_line: bool = False,
    split: bool = False,
) -> None:
    silver = payload_to_silver(spark, layout, day, files, form, multi_line, split)
    load_out_of_stock_day(spark, layout, silver, day, files)


def _days_to_load(
    spark: SparkSession, layout: Layout, table: str, first: Day, last: Day, missing: str, suffix: str
) -> list[dt.date]:
    if missing not in ("fail", "skip"):
        raise ValueError(f"missing must be 'fail' or 'skip', not {missing!r}")
    landed = landed_days(spark, layout.bronze, table, first, last, suffix)
    gap = len(days_between(first, last)) - len(landed)
    if gap and missing == "fail":
        raise MissingDay(f"{gap} of the days {first} to {last} have no {table} snapshot")
    return landed


def _prints(spark: SparkSession, layout: Layout, table: str) -> str:
    return f"{layout.gold}/day_fingerprints/{table}"


def _days_that_changed(
    spark: SparkSession, layout: Layout, table: str, rows: DataFrame, days: Sequence[dt.date]
) -> tuple[list[dt.date], DataFrame]:
    """Of the landed ``days`` those whose rows differ from what was loaded last, and the fingerprints of these.

    The fingerprints of all days are taken in one pass over ``rows`` and written before they are used; a landed day without rows
    has one of zeros.
    """
    found = _days_frame(spark, days).join(fingerprint(rows, ["report_date"]), "report_date", "left")
    zeros = [F.coalesce(c, F.lit(0)).cast(found.schema[c].dataType).alias(c) for c in PARTS]
    path = scratch_path(spark, "fingerprints")
    found.select("report_date", *zeros).write.parquet(path)
    new, root = spark.read.parquet(path), _prints(spark, layout, table)
    if exists(spark, root) and any(name.startswith("report_date=") for name in list_names(spark, root)):
        known = read_days(spark, root, min(days), max(days))
        stale = [r.report_date for r in changed(new, known, ["report_date"]).collect()]  # at most the days asked for
    else:
        stale = list(days)
    return sorted(stale), new.where(F.col("report_date").isin(stale)) if stale else new.limit(0)


def backfill_orders(
    spark: SparkSession,
    layout: Layout,
    first: Day,
    last: Day,
    sep: str = SEPARATOR,
    missing: str = "fail",
    changed_only: bool = False,
) -> list[dt.date]:
    """Load ``fact_orders`` for an inclusive range of landed days by one job.

    Equal to running the days one after another: repeats are dropped within a day, and a
    landed but empty day ends up empty. Days that were never landed raise, or are left
    untouched with ``missing="skip"``. Returns the loaded days.

    With ``changed_only`` days are left alone whose landed rows have the fingerprint of the last such load, whatever the
    order of their rows or files. Fingerprints are stored after the facts, so a job that dies in between loads
    its days again. Loads by other functions store none: a day that ``run_day`` wrote from other rows must be landed anew to be noticed.
    """

    def read(days: Sequence[dt.date]) -> DataFrame:
        path = days_glob(layout.bronze, "orders", days=days)
        return read_csv(spark, path, schemas.SHOP["orders"], sep).select(day_of_file("orders"), "*")

    def load(days: Sequence[dt.date]) -> None:
        facts = roll_up_days(distinct_rows(read(days)))
        reload_days(facts, layout.gold_table("fact_orders"), days)

    days = _days_to_load(spark, layout, "orders", first, last, missing, "csv")
    return _load_days(spark, layout, "fact_orders", days, read, load, changed_only)


def backfill_out_of_stock(
    spark: SparkSession,
    layout: Layout,
    first: Day,
    last: Day,
    missing: str = "fail",
    form: str = "objects",
    multi_line: bool = False,
    changed_only: bool = False,
    split: bool = False,
) -> list[dt.date]:
    """The same for ``fact_oos`` and landed payloads."""
    table = "out-of-stock"

    def read(days: Sequence[dt.date]) -> DataFrame:
        path = days_glob(layout.bronze, table, suffix="json", days=days)
        if split:
            payloads = read_payload(spark, path, form, split=True, file="_file")
            return payloads.select(day_of_file(table, file="_file"), "product_id")
        return read_payload(spark, path, form, multi_line).select(day_of_file(table), "product_id")

    def load(days: Sequence[dt.date]) -> None:
        reload_days(distinct_rows(read(days)), layout.gold_table("fact_oos"), days)

    days = _days_to_load(spark, layout, table, first, last, missing, "json")
    return _load_days(spark, layout, "fact_oos", days, read, load, changed_only)


def _load_days(
    spark: SparkSession,
    layout: Layout,
    table: str,
    days: list[dt.date],
    read: Callable[[Sequence[dt.date]], DataFrame],
    load: Callable[[Sequence[dt.date]], None],
    changed_only: bool,
) -> list[dt.date]:
    prints = None
    if days and changed_only:
        days, prints = _days_that_changed(spark, layout, table, read(days), days)
    if days:
        ensure_dates(spark, layout, days)
        load(days)
    if days and prints is not None:
        reload_days(prints, _prints(spark, layout, table), days)
    return days
