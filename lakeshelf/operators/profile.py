"""Column types from texts, by one aggregation over all columns and days.

Each type is a form that all filled values of a column must have. Counts of values that have it are added up map-side, so the
data is read once, however many columns and types there are, and the counts of several days or files add up to those of all: where one
day widens a column, its common type is the wider one.

The lattice, narrowest first:

    boolean                                    true or false
    bigint < decimal(p,s) < double             whole numbers of up to 18 digits; up to 38 digits with a point; with an exponent
    date < timestamp                           2024-01-31; 2024-01-31 10:00:00 with up to six decimals
    string                                     all else, and columns without a value
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Forms of the types.
BOOLEAN = r"^(true|false)$"
WHOLE = r"^[+-]?[0-9]{1,18}$"
POINT = r"^[+-]?[0-9]{1,38}([.][0-9]{1,38})?$"
FLOAT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"

COUNTS = ("n_rows", "n_filled", "n_boolean", "n_whole", "n_point", "n_float", "n_day", "n_moment")
MOST = ("left_digits", "right_digits")


def column_counts(texts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column_name, counts..., digits...)`` of all columns of ``texts``, all of them strings; additive but for the digits."""
    names = [c for c in texts.columns if c not in by]
    values = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in names))
    rows = texts.select(*by, F.inline(values))
    value = F.col("value")
    point = value.rlike(POINT)
    # A form can hold what no calendar has.
    forms = (
        value.rlike(BOOLEAN), value.rlike(WHOLE), point, value.rlike(FLOAT),
        value.rlike(DAY) & value.try_cast("date").isNotNull(),
        (value.rlike(MOMENT) | value.rlike(DAY)) & F.replace(value, F.lit("T"), F.lit(" ")).try_cast("timestamp").isNotNull(),
    )
    counts = [F.count(F.lit(1)), F.count("value"), *(F.count_if(form) for form in forms)]
    digits = [F.length(F.regexp_extract("value", pattern, 1)) for pattern in (r"^[+-]?0*([0-9]*)", r"[.]([0-9]+)$")]
    most = [F.coalesce(F.max(F.when(point, d)), F.lit(0)) for d in digits]
    return rows.groupBy(*by, "column_name").agg(*(c.alias(n) for c, n in zip([*counts, *most], [*COUNTS, *MOST])))


def common_counts(parts: DataFrame) -> DataFrame:
    """The counts of all days or files together."""
    return parts.groupBy("column_name").agg(*(F.sum(c).alias(c) for c in COUNTS), *(F.max(c).alias(c) for c in MOST))


def narrowest_type() -> Column:
    """The name of the narrowest type that holds all values, from the counts of a column."""
    filled = F.col("n_filled")
    whole, scale = F.greatest(F.col("left_digits"), F.lit(1)), F.col("right_digits")
    decimal = F.format_string("decimal(%d,%d)", whole + scale, scale)
    fits = (F.col("n_point") == filled) & (whole + scale <= 38)
    return (
        F.when(filled == 0, "string")
        .when(F.col("n_boolean") == filled, "boolean")
        .when(F.col("n_whole") == filled, "bigint")
        .when(fits, decimal)
        .when(F.col("n_float") == filled, "double")
        .when(F.col("n_day") == filled, "date")
        .when(F.col("n_moment") == filled, "timestamp")
        .otherwise("string")
    )


def profile_types(texts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column_name, type, n_rows, n_filled)`` of all columns."""
    return column_counts(texts, by).select(*by, "column_name", narrowest_type().alias("type"), "n_rows", "n_filled")


def widened(texts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns whose type differs between days: ``(by..., column_name, type, common_type)`` where a day has a narrower type than all."""
    parts = column_counts(texts, by)
    common = common_counts(parts).select("column_name", narrowest_type().alias("common_type"))
    own = parts.select(*by, "column_name", narrowest_type().alias("type"))
    return own.join(common, "column_name").where("type <> common_type").select(*by, "column_name", "type", "common_type")


def schema_of(texts: DataFrame) -> StructType:
    """The schema to read ``texts`` with; one row per column reaches the driver."""
    types = {r.column_name: r["type"] for r in profile_types(texts).collect()}
    empty = texts.limit(0).select(*(F.col(f"`{c}`").cast(types.get(c, "string")).alias(c) for c in texts.columns))
    return empty.schema
