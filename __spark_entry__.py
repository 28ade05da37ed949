"""Queries on the given tables, each next to the SQL that must give the same rows.

Rental frames and shop snapshots are derived from the given tables (``_Rental``, ``_orders``), so
that the library's own plans run over whole tables. Queries with a file format or a pipeline in
their name write to the shared scratch folder first and return what is read back.
"""

from __future__ import annotations

import importlib
import importlib.util
import uuid
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshelf import schemas
from lakeshelf.functions import (
    cents,
    contains_text,
    days_between,
    exact_seconds,
    from_cents,
    money,
    on_day,
    starts_with_ignoring_case,
    whole_days,
)
from lakeshelf.operators.aggregates import add_up, carry_up, count_rows, flag_count
from lakeshelf.operators.calendar import (
    build_dates,
    date_spine,
    days_without_rows,
    new_dates,
    rows_of_days,
    spine_of,
)
from lakeshelf.operators.history import validity
from lakeshelf.operators.joins import join_using, left_outer, star_sum, without_match
from lakeshelf.operators.profile import profile_types
from lakeshelf.operators.quality import orphan_keys, reference_violations, repeated_keys, violations
from lakeshelf.operators.ranking import leaders_per_group, top_k, top_k_cut
from lakeshelf.operators.rows import distinct_rows, tag_rows, union_labelled
from lakeshelf.plans import medallion, rental, star
from lakeshelf.session import scratch_path
from lakeshelf.sinks.buckets import write_bucketed
from lakeshelf.sinks.days import read_days, reload_day, reload_days
from lakeshelf.sinks.files import (
    as_array_documents,
    write_array_document,
    write_csv,
    write_documents,
    write_json,
    write_parquet,
)
from lakeshelf.sources.layout import Layout, day_path
from lakeshelf.sources.payloads import field_of_objects, read_json_array, read_json_numbers, read_json_objects
from lakeshelf.sources.snapshots import read_csv, read_csv_apart, read_history, read_snapshot, read_snapshots
from lakeshelf.sources.tables import folder_tables, orders_of_day

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
ORDER_DAY = "1998-10-03"
EVENT_DAY, NEXT_DAY = "2024-01-05", "2024-01-06"
EVENTS_FROM, EVENTS_TO = "2024-01-01", "2024-01-30"

_SCHEMAS: dict[tuple[str, str], StructType] = {}
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None, name: str | None = None):
    def register(function: Query) -> Query:
        key = name or function.__name__
        _QUERIES[key] = function
        if sql is not None:
            _SQL[key] = sql
        return function

    return register


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One given table. These never change, so each one's schema is looked up only once."""
    path = f"{folder}/{table}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def read_tables(spark: SparkSession, folder: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {table: read_table(spark, folder, table) for table in tables}


# --- the questions, bound to the order tables ---------------------------------------------


@_query("""
    SELECT n_nationkey, n_name, count(*) AS cnt
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_nationkey, n_name
""")
def q1_count_by_category(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    counts = carry_up(
        count_rows(customer, ["n_nationkey"]),
        read_table(spark, sf_dir, "nation"),
        "n_nationkey",
        ["n_nationkey", "n_name"],
        ["cnt"],
    )
    return counts.orderBy(F.desc("cnt"), "n_nationkey")


def _orders_per_customer(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customer = read_table(spark, sf_dir, "customer")
    per_key = count_rows(orders, ["c_custkey"])
    return carry_up(per_key, customer, "c_custkey", ["c_custkey", "c_name", "c_nationkey"], ["cnt"])


@_query("""
    SELECT * FROM (
        SELECT c_custkey, c_name, n_name, count(*) AS cnt, rank() OVER (ORDER BY count(*) DESC) AS rnk
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY c_custkey, c_name, n_name
    ) AS ranked WHERE rnk <= 10
""")
def q2_topk_with_ties(spark, sf_dir):
    nation = read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    counts = _orders_per_customer(spark, sf_dir).join(nation, "c_nationkey")
    ranked = top_k(counts.select("c_custkey", "c_name", "n_name", "cnt"), "cnt", 10, "rank", "rnk")
    return ranked.orderBy("rnk", "c_custkey")


@_query("""
    SELECT c_custkey, c_name, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name ORDER BY cnt DESC, c_custkey LIMIT 10
""")
def topk_limit(spark, sf_dir):
    counts = _orders_per_customer(spark, sf_dir).drop("c_nationkey")
    return top_k_cut(counts, "cnt", 10, ["c_custkey"])


@_query("""
    SELECT c_custkey, c_name, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name ORDER BY cnt DESC, c_custkey LIMIT 1
""")
def top1_limit(spark, sf_dir):
    counts = _orders_per_customer(spark, sf_dir).drop("c_nationkey")
    return top_k_cut(counts, "cnt", 1, ["c_custkey"])


@_query("""
    SELECT * FROM (
        SELECT n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amt,
               rank() OVER (ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC) AS rnk
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY n_nationkey, n_name
    ) AS ranked WHERE rnk = 1
""")
def q3_top_category_by_amount(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), cents(F.col("l_extendedprice")).alias("amt")
    )
    supplier = read_table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    nation = read_table(spark, sf_dir, "nation")
    sums = add_up(lines, ["s_suppkey"], ["amt"]).select("s_suppkey", from_cents(F.col("amt")).alias("amt"))
    sums = carry_up(sums, supplier, "s_suppkey", ["n_nationkey"], ["amt"])
    sums = carry_up(sums, nation, "n_nationkey", ["n_nationkey", "n_name"], ["amt"])
    sums = sums.select("n_name", F.col("amt").cast("decimal(28,2)").alias("amt"))
    return top_k(sums, "amt", 1, "rank", "rnk")


@_query("""
    SELECT o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_orderkey IS NULL
""")
def q4_anti_left_outer(spark, sf_dir):
    orders, lines = (read_table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    missing = without_match(orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey")
    return missing.orderBy("o_orderkey")


@_query("""
    SELECT o_orderkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) ORDER BY 1
""")
def q4_anti_not_exists(spark, sf_dir):
    return spark.sql(
        """
        SELECT o_orderkey FROM {orders}
        WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT DISTINCT l_orderkey FROM {lines}) WHERE l_orderkey = o_orderkey
        ) ORDER BY 1
        """,
        orders=read_table(spark, sf_dir, "orders"),
        lines=read_table(spark, sf_dir, "lineitem"),
    )


@_query("""
    SELECT * FROM (
        SELECT s_suppkey, s_name, count(*) AS cnt, dense_rank() OVER (ORDER BY count(*) DESC) AS rnk
        FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON l_suppkey = s_suppkey
        WHERE p_type = 'ECONOMY' GROUP BY s_suppkey, s_name
    ) AS ranked WHERE rnk <= 3
""")
def q5_top3_dense_rank(spark, sf_dir):
    part, lines, supplier = (read_table(spark, sf_dir, t) for t in ("part", "lineitem", "supplier"))
    wanted = part.where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("l_partkey"))
    sold = lines.select("l_partkey", F.col("l_suppkey").alias("s_suppkey")).join(wanted, "l_partkey")
    counts = carry_up(
        count_rows(sold, ["s_suppkey"]), supplier, "s_suppkey", ["s_suppkey", "s_name"], ["cnt"]
    )
    return top_k(counts, "cnt", 3, "dense_rank", "rnk").orderBy("rnk", "s_suppkey")


@_query("""
    SELECT n_nationkey, n_name, CAST(sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS active_cnt,
           CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS inactive_cnt
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name
""")
def q6_active_inactive(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"), F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("active")
    )
    counts = ["active_cnt", "inactive_cnt"]
    sums = customer.groupBy("n_nationkey").agg(
        F.sum("active").alias("active_cnt"), flag_count(F.col("active") == 0).alias("inactive_cnt")
    )
    nation = read_table(spark, sf_dir, "nation")
    sums = carry_up(sums, nation, "n_nationkey", ["n_nationkey", "n_name"], counts)
    return sums.orderBy(F.desc("inactive_cnt"), "n_nationkey")


def _returned_lines(spark, sf_dir):
    """Lines that count as returned; an 'N' line is still out."""
    lines = read_table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") != "N")
    return lines.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_shipdate"
    )


@_query("""
    WITH spent AS (
        SELECT p_type, r_name, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS days
        FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE l_returnflag <> 'N'
    ), per_group AS (
        SELECT 'regions like a%' AS title, p_type AS name, sum(days) AS total
        FROM spent WHERE lower(r_name) LIKE 'a%' GROUP BY p_type
        UNION ALL
        SELECT 'regions like % %', p_type, sum(days) FROM spent WHERE r_name LIKE '% %' GROUP BY p_type
    )
    SELECT title, name FROM (
        SELECT title, name, rank() OVER (PARTITION BY title ORDER BY total DESC) AS rnk FROM per_group
    ) AS ranked WHERE rnk = 1
""")
def q7_longest_by_pattern(spark, sf_dir):
    t = read_tables(spark, sf_dir, ("region", "nation", "customer", "orders", "part"))
    name = F.col("r_name")
    patterns = {
        "regions like a%": starts_with_ignoring_case(name, "a"),
        "regions like % %": contains_text(name, " "),
    }
    tagged = tag_rows(t["region"], patterns, "title").select(F.col("r_regionkey").alias("n_regionkey"), "title")
    tagged = tagged.join(t["nation"].select("n_nationkey", "n_regionkey"), "n_regionkey")
    tagged = tagged.withColumnRenamed("n_nationkey", "c_nationkey")
    tagged = t["customer"].select("c_custkey", "c_nationkey").join(tagged, "c_nationkey")
    tagged = tagged.withColumnRenamed("c_custkey", "o_custkey").select("o_custkey", "title")
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate").join(tagged, "o_custkey")
    spent = (
        _returned_lines(spark, sf_dir)
        .join(orders, "o_orderkey")
        .select("p_partkey", "title", whole_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))
    )
    sums = add_up(spent, ["p_partkey", "title"], ["days"])
    part = t["part"].select("p_partkey", F.col("p_type").alias("name"))
    sums = carry_up(sums, part, "p_partkey", ["name"], ["days"], keep=["title"])
    return leaders_per_group(sums, "days", "title", few_groups=True).select("title", "name")


@_query("""
    SELECT p_type, CAST(sum(date_diff('second', o_orderdate, l_shipdate)) AS BIGINT) AS seconds
    FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag <> 'N' GROUP BY p_type
""")
def sum_duration_seconds(spark, sf_dir):
    orders, part = (read_table(spark, sf_dir, t) for t in ("orders", "part"))
    spent = (
        _returned_lines(spark, sf_dir)
        .join(orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
        .select("p_partkey", exact_seconds(F.col("o_orderdate"), F.col("l_shipdate")).alias("seconds"))
    )
    sums = add_up(spent, ["p_partkey"], ["seconds"])
    sums = carry_up(sums, part, "p_partkey", ["p_type"], ["seconds"])
    return sums.select("p_type", F.col("seconds").cast("bigint").alias("seconds"))


# --- single operators -----------------------------------------------------------------------


@_query("""
    SELECT n_nationkey AS nationkey, n_name, c_custkey, c_mktsegment
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""", name="join_using")
def join_using_key(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    nation = read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nationkey")
    joined = join_using(customer, nation, "nationkey")
    return joined.select("nationkey", "n_name", "c_custkey", "c_mktsegment")


@_query("""
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def left_outer_keep_nulls(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = read_table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return left_outer(orders, lines, "o_orderkey", "l_orderkey").drop("l_orderkey")


@_query("""
    SELECT n_name, r_name, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name
""")
def star_join_broadcast(spark, sf_dir):
    t = read_tables(spark, sf_dir, ("lineitem", "supplier", "nation", "region"))
    fact = t["lineitem"].select(F.col("l_suppkey").alias("s_suppkey"), money(F.col("l_quantity")).alias("quantity"))
    sums = star_sum(
        fact,
        [
            (t["supplier"].withColumnRenamed("s_nationkey", "n_nationkey"), "s_suppkey", ["n_nationkey"]),
            (t["nation"].withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey", ["n_name", "r_regionkey"]),
            (t["region"], "r_regionkey", ["r_name"]),
        ],
        "s_suppkey",
        ["quantity"],
        ["n_name", "r_name"],
    )
    return sums.select("n_name", "r_name", F.col("quantity").cast("decimal(28,2)").alias("quantity"))


@_query("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) LIKE 'a%'")
def like_prefix(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customer.where(starts_with_ignoring_case(F.col("c_mktsegment"), "a"))


@_query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '%-H%'")
def like_contains(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.where(contains_text(F.col("o_orderpriority"), "-H"))


@_query("""
    SELECT 'customer' AS kind, c_name AS name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL
    SELECT 'supplier', s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def union_all_labelled(spark, sf_dir):
    t = read_tables(spark, sf_dir, ("customer", "supplier", "nation"))
    parts = {}
    for kind in ("customer", "supplier"):
        prefix = kind[0]
        joined = t[kind].join(t["nation"], F.col(f"{prefix}_nationkey") == F.col("n_nationkey"))
        parts[kind] = joined.select(F.col(f"{prefix}_name").alias("name"), "n_name")
    return union_labelled(parts, "kind")


@_query("SELECT count(*) AS cnt FROM lineitem")
def count_all(spark, sf_dir):
    return count_rows(read_table(spark, sf_dir, "lineitem"))


@_query("SELECT DISTINCT user_id, event_type FROM events")
def dedupe_rows(spark, sf_dir):
    return distinct_rows(read_table(spark, sf_dir, "events").select("user_id", "event_type"))


@_query("SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_violations(spark, sf_dir):
    return repeated_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("""
    SELECT 'max_length' AS rule, 'text' AS column_name, count(*) AS n_rows
    FROM documents WHERE length(text) > 255 HAVING count(*) > 0
    UNION ALL
    SELECT 'max_length', 'lang', count(*) FROM documents WHERE length(lang) > 1 HAVING count(*) > 0
    UNION ALL
    SELECT 'not_null', 'doc_id', count(*) FROM documents WHERE doc_id IS NULL HAVING count(*) > 0
    UNION ALL
    SELECT 'unique', 'source,n_chars', CAST(sum(n) AS BIGINT)
    FROM (SELECT count(*) AS n FROM documents GROUP BY source, n_chars HAVING count(*) > 1) HAVING sum(n) > 0
""")
def rule_violations(spark, sf_dir):
    rules = schemas.Rules(("source", "n_chars"), ("doc_id",), {"text": 255, "lang": 1})
    return violations(read_table(spark, sf_dir, "documents"), rules)


REFERENCES = (
    schemas.Reference("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    schemas.Reference("orders", ("o_custkey",), "customer", ("c_custkey",)),
    schemas.Reference("orders", ("o_orderkey",), "lineitem", ("l_orderkey",)),
    schemas.Reference("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    schemas.Reference("lineitem", ("l_partkey",), "part", ("p_partkey",)),
    schemas.Reference("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    schemas.Reference("part", ("p_partkey",), "lineitem", ("l_partkey",)),
    schemas.Reference("events", ("user_id",), "supplier", ("s_suppkey",)),
    schemas.Reference("documents", ("doc_id",), "labels", ("doc_id",)),
)


def _referred(spark, sf_dir):
    return read_tables(spark, sf_dir, sorted({t for r in REFERENCES for t in (r.table, r.target)}))


_ORPHANS = " UNION ALL ".join(
    f"""
    SELECT '{r.table}' AS table_name, '{r.name}' AS column_name, '{r.target}' AS target, CAST({r.name} AS VARCHAR) AS key, count(*) AS n_rows
    FROM {r.table} WHERE {r.name} NOT IN (SELECT {r.target_columns[0]} FROM {r.target}) GROUP BY {r.name}
    """
    for r in REFERENCES
)


@_query(_ORPHANS, name="orphan_keys")
def lost_references(spark, sf_dir):
    """Keys without their row in the referred table, for all references by one shuffle; some references are broken by nature of the data."""
    return orphan_keys(_referred(spark, sf_dir), REFERENCES)


@_query(f"""
    SELECT 'reference' AS rule, table_name, column_name, count(*) AS n_keys, CAST(sum(n_rows) AS BIGINT) AS n_rows
    FROM ({_ORPHANS}) GROUP BY table_name, column_name
""", name="reference_violations")
def broken_references(spark, sf_dir):
    return reference_violations(_referred(spark, sf_dir), REFERENCES)


# --- scans and calendars --------------------------------------------------------------------


@_query("SELECT * FROM supplier")
def scan_table(spark, sf_dir):
    return read_table(spark, sf_dir, "supplier")


@_query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def catalog_tables(spark, sf_dir):
    """Every table the folder holds, with its number of rows."""
    parts = {t: count_rows(read_table(spark, sf_dir, t), name="n_rows") for t in folder_tables(spark, sf_dir)}
    return union_labelled(parts, "table_name")


@_query(f"""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE CAST(o_orderdate AS DATE) = DATE '{ORDER_DAY}'
""")
def scan_orders_for_day(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.where(on_day(F.col("o_orderdate"), ORDER_DAY)).select("o_orderkey", "o_custkey", "o_totalprice")


@_query("""
    SELECT CAST(day AS DATE) AS report_date, event_id, user_id
    FROM generate_series(DATE '2024-01-20', DATE '2024-02-03', INTERVAL 1 DAY) AS days(day)
    LEFT JOIN events ON CAST(ts AS DATE) = CAST(day AS DATE)
""")
def date_range_events(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("ts", "event_id", "user_id")
    return rows_of_days(events, "ts", "2024-01-20", "2024-02-03").drop("ts")


@_query("""
    SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE)
           AS report_date FROM events
""", name="date_spine")
def spine_of_events(spark, sf_dir):
    return spine_of(read_table(spark, sf_dir, "events"), "ts")


@_query("""
    SELECT CAST(day AS DATE) AS report_date
    FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) AS days(day)
    WHERE CAST(day AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
""")
def missing_days(spark, sf_dir):
    spine = date_spine(spark, "1995-01-01", "2001-12-31")
    return days_without_rows(spine, read_table(spark, sf_dir, "orders"), "o_orderdate")


@_query("""
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date,
           CAST(isodow(o_orderdate) AS SMALLINT) AS day_of_week, isodow(o_orderdate) IN (6, 7) AS is_holiday
    FROM orders
""")
def dim_dates_build(spark, sf_dir):
    return build_dates(read_table(spark, sf_dir, "orders"), "o_orderdate")


@_query("""
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date,
           CAST(isodow(o_orderdate) AS SMALLINT) AS day_of_week, isodow(o_orderdate) IN (6, 7) AS is_holiday
    FROM orders
""")
def dim_dates_upsert(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    existing = build_dates(orders.where(F.col("o_orderdate") < F.to_date(F.lit("1998-01-01"))), "o_orderdate")
    return existing.unionByName(new_dates(existing, build_dates(orders, "o_orderdate")))


# --- formats --------------------------------------------------------------------------------


@_query("SELECT * FROM documents")
def csv_round_trip(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents.csv")
    write_csv(documents, path)
    return read_csv(spark, path, documents.schema)


@_query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_pipe_round_trip(spark, sf_dir):
    supplier = read_table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier.csv")
    write_csv(supplier, path, sep="|")
    return read_csv(spark, path, supplier.schema, sep="|", multi_line=False)


@_query("""
    SELECT event_id, epoch_us(ts) + event_id AS with_zone, epoch_us(ts) + event_id AS without_zone, 'csv' AS kind FROM events
    UNION ALL SELECT event_id, epoch_us(ts) + event_id, epoch_us(ts) + event_id, 'json' FROM events
    UNION ALL SELECT DISTINCT event_id, epoch_us(ts) + event_id, epoch_us(ts) + event_id, 'silver' FROM events
""")
def csv_moments_round_trip(spark, sf_dir):
    """Moments that differ by microseconds, through CSV, JSON and the silver stage."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id")
    events = read_table(spark, sf_dir, "events").select("event_id", F.timestamp_micros(micros).alias("with_zone"))
    events = events.withColumn("without_zone", F.col("with_zone").cast("timestamp_ntz"))
    layout, path = _layout(spark), scratch_path(spark, "moments.json")
    medallion.land_table(events, layout.bronze, "moments", EVENT_DAY)
    write_json(events, path)
    parts = {
        "csv": read_snapshot(spark, layout.bronze, "moments", EVENT_DAY, events.schema, "|"),
        "json": read_json_objects(spark, path, events.schema),
        "silver": medallion.snapshot_to_silver(spark, layout, "moments", EVENT_DAY, events.schema),
    }
    moments = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("with_zone", "without_zone")]
    return union_labelled({k: df.select("event_id", *moments) for k, df in parts.items()}, "kind")


@_query("SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events")
def csv_single_column_nulls(spark, sf_dir):
    """Rows that hold nothing but a null come back."""
    events = read_table(spark, sf_dir, "events")
    users = events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    path = scratch_path(spark, "users.csv")
    write_csv(users, path)
    return read_csv(spark, path, users.schema)


@_query("""
    SELECT o_orderpriority, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amt,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS from_cents
    FROM (SELECT o_orderpriority, CAST((CASE WHEN o_custkey % 2 = 0 THEN '-' ELSE '' END) || o_custkey || '.'
                 || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS DECIMAL(18,3)) AS amount FROM orders)
    GROUP BY o_orderpriority
""")
def money_of_three_decimals(spark, sf_dir):
    """Amounts between two cents are rounded alike, summed as decimals or as whole cents."""
    sign = F.when(F.col("o_custkey") % 2 == 0, "-").otherwise("")
    thousandths = F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    amount = F.concat(sign, F.col("o_custkey").cast("string"), F.lit("."), thousandths).cast("decimal(18,3)")
    amounts = read_table(spark, sf_dir, "orders").select(
        "o_orderpriority", money(amount).alias("amt"), cents(amount).alias("from_cents")
    )
    sums = add_up(amounts, ["o_orderpriority"], ["amt", "from_cents"])
    total = from_cents(F.col("from_cents")).cast("decimal(28,2)").alias("from_cents")
    return sums.select("o_orderpriority", F.col("amt").cast("decimal(28,2)").alias("amt"), total)


@_query("SELECT * FROM part")
def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "part")
    write_parquet(read_table(spark, sf_dir, "part"), path)
    return spark.read.parquet(path)


@_query("SELECT user_id FROM events")
def json_int_array_explode(spark, sf_dir):
    """Payloads of objects, flattened to bare ids, landed and read as rows."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    payload = as_array_documents(events, ["event_id", "user_id"])
    items = payload.select(F.from_json("value", "array<struct<user_id: bigint>>").alias("items"))
    path = scratch_path(spark, "ids.json")
    write_documents(items.select(F.to_json(field_of_objects("items", "user_id")).alias("value")), path)
    return read_json_numbers(spark, path, "user_id")


@_query("SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_objects_to_rows(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    rows = events.select("event_id", "user_id", F.from_json("props", "k bigint")["k"].alias("k"))
    path = scratch_path(spark, "events.json")
    write_documents(as_array_documents(rows, rows.columns, per_document=1), path)
    return read_json_objects(spark, path, rows.schema)


@_query(f"""
    SELECT DATE '{EVENT_DAY}' AS report_date, * FROM supplier
    UNION ALL SELECT DATE '{NEXT_DAY}', c_custkey, c_name, c_nationkey, c_acctbal FROM customer
""", name="read_snapshots")
def read_two_days(spark, sf_dir):
    """Two landed days of one table, read at once with the day from the path."""
    root = scratch_path(spark, "bronze")
    first = read_table(spark, sf_dir, "supplier")
    customer = read_table(spark, sf_dir, "customer")
    second = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").toDF(*first.columns)
    for day, rows in ((EVENT_DAY, first), (NEXT_DAY, second)):
        medallion.land_table(rows, root, "people", day)
    return read_history(spark, root, "people", EVENT_DAY, NEXT_DAY, first.schema, "|")


@_query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier", name="read_snapshot")
def read_one_snapshot(spark, sf_dir):
    root, supplier = scratch_path(spark, "bronze"), read_table(spark, sf_dir, "supplier")
    write_csv(supplier, day_path(root, "supplier", EVENT_DAY))
    return read_snapshot(spark, root, "supplier", EVENT_DAY, supplier.schema)


@_query(f"""
    WITH good AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 3)
    SELECT 'good' AS kind, o_orderkey, o_custkey, o_orderpriority, CAST(NULL AS VARCHAR) AS record FROM good
    UNION ALL
    SELECT 'bad', NULL, NULL, NULL, o_orderkey || ',x' || o_custkey || ',' || o_orderpriority FROM orders WHERE o_orderkey % 10 = 3
""")
def csv_quarantine(spark, sf_dir):
    """A tenth of the lines has a letter in a number; they are set aside, the others are read."""
    orders, path = read_table(spark, sf_dir, "orders"), scratch_path(spark, "orders.csv")
    customer = F.concat(F.when(F.col("o_orderkey") % 10 == 3, "x").otherwise(""), F.col("o_custkey").cast("string"))
    write_csv(orders.select("o_orderkey", customer.alias("o_custkey"), "o_orderpriority"), path)
    columns = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    parsed = read_csv_apart(spark, path, columns.schema, most_bad=0.2)
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in columns.schema]
    parts = {"good": parsed.good.withColumn("record", F.lit(None).cast("string")), "bad": parsed.bad.select(*blanks, "record")}
    return union_labelled(parts, "kind")


@_query("""
    SELECT event_id, user_id, event_type, props, '}, {' || event_type || '"}],' AS odd_text, [{'k': event_id}, {'k': user_id}]::VARCHAR AS pairs
    FROM events
""")
def json_array_split(spark, sf_dir):
    """All events as one array in one file, read by as many tasks as the file has splits; texts and nested objects hold braces."""
    events, path = read_table(spark, sf_dir, "events"), scratch_path(spark, "events.json")
    odd = F.concat(F.lit("}, {"), "event_type", F.lit('"}],'))
    pairs = F.array(*(F.struct(F.col(c).alias("k")) for c in ("event_id", "user_id")))
    rows = events.select("event_id", "user_id", "event_type", "props", odd.alias("odd_text"), pairs.alias("pairs"))
    write_array_document(rows, path)
    pair = F.transform("pairs", lambda p: F.concat(F.lit("{'k': "), p["k"].cast("string"), F.lit("}")))
    text = F.concat(F.lit("["), F.array_join(pair, ", "), F.lit("]"))
    return read_json_array(spark, path, rows.schema).withColumn("pairs", text)


@_query("""
    SELECT source AS table_name, column_name, CASE
               WHEN n_filled = 0 THEN 'string'
               WHEN n_boolean = n_filled THEN 'boolean'
               WHEN n_whole = n_filled THEN 'bigint'
               WHEN n_point = n_filled THEN 'decimal(' || (greatest(left_digits, 1) + right_digits) || ',' || right_digits || ')'
               WHEN n_float = n_filled THEN 'double'
               WHEN n_day = n_filled THEN 'date'
               WHEN n_moment = n_filled THEN 'timestamp'
               ELSE 'string' END AS type, n_rows, n_filled
    FROM (
        SELECT source, column_name, count(*) AS n_rows, count(value) AS n_filled,
               count(*) FILTER (regexp_matches(value, '^(true|false)$')) AS n_boolean,
               count(*) FILTER (regexp_matches(value, '^[+-]?[0-9]{1,18}$')) AS n_whole,
               count(*) FILTER (regexp_matches(value, '^[+-]?[0-9]{1,38}([.][0-9]{1,38})?$')) AS n_point,
               count(*) FILTER (regexp_matches(value, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$')) AS n_float,
               count(*) FILTER (try_cast(value AS DATE) IS NOT NULL AND length(value) = 10) AS n_day,
               count(*) FILTER (try_cast(value AS TIMESTAMP) IS NOT NULL) AS n_moment,
               coalesce(max(length(regexp_extract(value, '^[+-]?0*([0-9]*)', 1))) FILTER (regexp_matches(value, '^[+-]?[0-9]{1,38}([.][0-9]{1,38})?$')), 0) AS left_digits,
               coalesce(max(length(regexp_extract(value, '[.]([0-9]+)$', 1))) FILTER (regexp_matches(value, '^[+-]?[0-9]{1,38}([.][0-9]{1,38})?$')), 0) AS right_digits
        FROM (
            SELECT 'events' AS source, unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props', 'day', 'noisy']) AS column_name,
                   unnest([event_id::VARCHAR, ts::VARCHAR, user_id::VARCHAR, event_type, value::VARCHAR, props, ts::DATE::VARCHAR,
                           CASE WHEN event_id % 1000 = 7 THEN value::VARCHAR ELSE user_id::VARCHAR END]) AS value FROM events
            UNION ALL
            SELECT 'documents', unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']),
                   unnest([doc_id::VARCHAR, text, lang, source, n_chars::VARCHAR]) FROM documents
        ) GROUP BY ALL
    )
""", name="profile_types")
def types_of_texts(spark, sf_dir):
    """Types of columns that are given as texts; one column holds whole numbers but for a few amounts."""
    events, documents = (read_table(spark, sf_dir, t) for t in ("events", "documents"))
    noisy = F.when(F.col("event_id") % 1000 == 7, F.col("value").cast("string")).otherwise(F.col("user_id").cast("string"))
    events = events.select("*", F.col("ts").cast("date").alias("day"), noisy.alias("noisy"))
    parts = {"events": events, "documents": documents}
    texts = {name: df.select(*(F.col(c).cast("string").alias(c) for c in df.columns)) for name, df in parts.items()}
    return union_labelled({name: profile_types(df) for name, df in texts.items()}, "table_name")


# --- pipeline -------------------------------------------------------------------------------


def _layout(spark) -> Layout:
    root = scratch_path(spark, "lake")
    return Layout(f"{root}/bronze", f"{root}/silver", f"{root}/gold")


def _orders(spark, sf_dir):
    """Order lines in the shape of the shop's orders table."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("client_id"),
        F.col("l_linenumber").cast("bigint").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_shipdate").alias("order_date"),
    )


def _event_amounts(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("report_date"), "user_id", "event_type", money(F.col("value")).alias("value")
    )


EVENT_KEYS = ("user_id", "event_type")


@_query("SELECT DISTINCT user_id, event_type FROM events")
def silver_snapshot(spark, sf_dir):
    layout, events = _layout(spark), read_table(spark, sf_dir, "events").select(*EVENT_KEYS)
    medallion.land_table(events, layout.bronze, "events", EVENT_DAY)
    return medallion.snapshot_to_silver(spark, layout, "events", EVENT_DAY, events.schema)


@_query("SELECT DISTINCT user_id AS product_id FROM events")
def silver_oos(spark, sf_dir):
    layout = _layout(spark)
    events = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("product_id"))
    write_json(events, day_path(layout.bronze, "out-of-stock", EVENT_DAY, "json"))
    return medallion.payload_to_silver(spark, layout, EVENT_DAY)


@_query("SELECT c_custkey AS id, c_name AS fullname, CAST(c_nationkey AS BIGINT) AS location_area_id FROM customer")
def load_dimension(spark, sf_dir):
    layout = _layout(spark)
    clients = read_table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("location_area_id"),
        F.col("c_name").alias("fullname"),
        F.col("c_custkey").alias("id"),
    )
    for _ in range(2):  # a second load replaces the first
        medallion.load_dimension(layout, "clients", clients)
    return spark.read.parquet(layout.gold_table("dim_clients"))


@_query(f"""
    SELECT DATE '{ORDER_DAY}' AS report_date, product_id, client_id, store_id, CAST(sum(quantity) AS BIGINT) AS quantity
    FROM (
        SELECT DISTINCT l_orderkey, l_partkey AS product_id, l_suppkey AS client_id,
               CAST(l_linenumber AS BIGINT) AS store_id, CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '{ORDER_DAY}'
    ) GROUP BY product_id, client_id, store_id
""")
def load_fact_orders(spark, sf_dir):
    """One day through all three zones."""
    layout = _layout(spark)
    day = orders_of_day(_orders(spark, sf_dir), ORDER_DAY)
    medallion.land_table(day, layout.bronze, "orders", ORDER_DAY)
    silver = medallion.snapshot_to_silver(spark, layout, "orders", ORDER_DAY, schemas.SHOP["orders"])
    medallion.load_orders_day(spark, layout, silver, ORDER_DAY)
    return read_days(spark, layout.gold_table("fact_orders"), ORDER_DAY, ORDER_DAY).select(
        *schemas.GOLD["fact_orders"].names
    )


_DAY_SUMS = """
    SELECT CAST(ts AS DATE) AS report_date, user_id, event_type,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS value
    FROM events {where} GROUP BY CAST(ts AS DATE), user_id, event_type
"""


@_query(_DAY_SUMS.format(where=f"WHERE CAST(ts AS DATE) = DATE '{EVENT_DAY}'"))
def fact_orders_day(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").where(on_day(F.col("ts"), EVENT_DAY))
    amounts = events.select(*EVENT_KEYS, money(F.col("value")).alias("value"))
    return medallion.roll_up_day(amounts, EVENT_DAY, EVENT_KEYS, "value")


@_query(_DAY_SUMS.format(where=""))
def fact_orders_range(spark, sf_dir):
    return medallion.roll_up_days(_event_amounts(spark, sf_dir), EVENT_KEYS, "value")


@_query(f"""
    SELECT DISTINCT DATE '{EVENT_DAY}' AS report_date, user_id AS product_id
    FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '{EVENT_DAY}'
""")
def fact_oos_day(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    errors = events.where(on_day(F.col("ts"), EVENT_DAY) & (F.col("event_type") == "error"))
    missing = distinct_rows(errors.select(F.col("user_id").alias("product_id")))
    return medallion.out_of_stock_day(missing, EVENT_DAY)


@_query("SELECT DISTINCT CAST(ts AS DATE) AS report_date, user_id AS product_id FROM events WHERE event_type = 'error'")
def fact_oos_range(spark, sf_dir):
    errors = read_table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return distinct_rows(errors.select(F.col("ts").cast("date").alias("report_date"), F.col("user_id").alias("product_id")))


@_query(_DAY_SUMS.format(where=f"WHERE CAST(ts AS DATE) BETWEEN DATE '{EVENT_DAY}' AND DATE '{NEXT_DAY}'"))
def fact_day_reload(spark, sf_dir):
    """Two days, then the first again: the reload leaves it as it was."""
    root = scratch_path(spark, "fact")
    events = read_table(spark, sf_dir, "events")
    for day in (EVENT_DAY, NEXT_DAY, EVENT_DAY):
        rows = events.where(on_day(F.col("ts"), day))
        amounts = rows.select(*EVENT_KEYS, money(F.col("value")).alias("value"))
        reload_day(medallion.roll_up_day(amounts, day, EVENT_KEYS, "value"), root, day)
    return read_days(spark, root, EVENT_DAY, NEXT_DAY)


@_query(_DAY_SUMS.format(where=f"WHERE CAST(ts AS DATE) = DATE '{NEXT_DAY}'"))
def fact_day_pruned_read(spark, sf_dir):
    """All days written by one job, one of them read."""
    root = scratch_path(spark, "fact")
    facts = medallion.roll_up_days(_event_amounts(spark, sf_dir), EVENT_KEYS, "value")
    reload_days(facts, root, days_between(EVENTS_FROM, EVENTS_TO))
    return read_days(spark, root, NEXT_DAY, NEXT_DAY)


CORRECTED_FROM = 330


@_query(f"""
    WITH late AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE value >= {CORRECTED_FROM}),
    lines AS (SELECT DISTINCT event_id, CAST(ts AS DATE) AS report_date, user_id AS product_id, length(event_type) AS client_id,
                     event_id % 3 AS store_id, CAST(floor(value) AS BIGINT) + CASE WHEN value >= {CORRECTED_FROM} THEN 1000 ELSE 0 END AS quantity
              FROM events)
    SELECT report_date, product_id, client_id, store_id, CAST(sum(quantity) AS BIGINT) AS quantity,
           CAST(1 + (report_date IN (SELECT day FROM late))::INTEGER AS BIGINT) AS loads
    FROM lines GROUP BY report_date, product_id, client_id, store_id
""")
def backfill_changed_days(spark, sf_dir):
    """All days loaded; some rows corrected and everything landed again, in another order; only the days with a correction are loaded.

    ``loads`` is how often a day was loaded.
    """
    layout, events = _layout(spark), read_table(spark, sf_dir, "events")
    value = F.floor("value").cast("bigint")
    corrected = value + F.when(F.col("value") >= CORRECTED_FROM, 1000).otherwise(0)
    loads = []
    for quantity, order in ((value, "event_id"), (corrected, "user_id")):
        lines = events.select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("product_id"),
            F.length("event_type").cast("bigint").alias("client_id"),
            (F.col("event_id") % 3).alias("store_id"),
            quantity.alias("quantity"),
            F.col("ts").cast("date").alias("report_date"),
        )
        medallion.land_days(lines.repartition(order), layout.bronze, "orders")
        days = medallion.backfill_orders(spark, layout, EVENTS_FROM, EVENTS_TO, missing="skip", changed_only=True)
        loads += days
    facts = read_days(spark, layout.gold_table("fact_orders"), EVENTS_FROM, EVENTS_TO)
    loaded = spark.range(1).select(F.explode(F.array(*map(F.lit, loads))).alias("report_date"))
    return join_using(facts, count_rows(loaded, ["report_date"], "loads"), "report_date")


@_query("""
    WITH snapshots AS (
        SELECT DISTINCT CAST(ts AS DATE) - DATE '2024-01-01' AS place, user_id, event_type FROM events
    ), runs AS (
        SELECT *, place - row_number() OVER (PARTITION BY user_id, event_type ORDER BY place) AS run FROM snapshots
    )
    SELECT user_id, event_type, DATE '2024-01-01' + min(place)::INTEGER AS valid_from,
           CASE WHEN max(place) < 29 THEN DATE '2024-01-01' + max(place)::INTEGER END AS valid_to
    FROM runs GROUP BY user_id, event_type, run
""")
def dimension_history(spark, sf_dir):
    """Which kinds of events each user had, day by day, as intervals of validity."""
    events = read_table(spark, sf_dir, "events")
    snapshots = events.select(F.col("ts").cast("date").alias("report_date"), "user_id", "event_type")
    return validity(snapshots, days_between(EVENTS_FROM, EVENTS_TO))


@_query("""
    SELECT CAST(ts AS DATE) AS report_date, user_id AS product_id, CAST(count(*) AS BIGINT) AS quantity
    FROM events WHERE isodow(ts) >= 6 GROUP BY CAST(ts AS DATE), user_id
""", name="weekend_quantities")
def quantities_of_weekends(spark, sf_dir):
    """Facts of all days in gold; the date dimension tells at run time which folders are read."""
    layout, events = _layout(spark), read_table(spark, sf_dir, "events")
    facts = events.select(F.col("ts").cast("date").alias("report_date"), F.col("user_id").alias("product_id"), F.lit(1).cast("bigint").alias("quantity"))
    days = days_between(EVENTS_FROM, EVENTS_TO)
    reload_days(medallion.roll_up_days(facts, ["product_id"]), layout.gold_table("fact_orders"), days)
    medallion.ensure_dates(spark, layout, days)
    return star.weekend_quantities(spark, layout)


@_query("""
    SELECT o_orderpriority, l_returnflag, count(*) AS cnt, CAST(sum(l_linenumber) AS BIGINT) AS line_sum
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
""")
def bucketed_join(spark, sf_dir):
    """Orders and their lines laid out by order, then joined where they lie."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_returnflag", "l_linenumber")
    laid = []
    for name, df in (("orders", orders), ("lines", lines)):
        table = f"{name}_{uuid.uuid4().hex}"
        write_bucketed(df, table, scratch_path(spark, name), "orderkey", 16)
        laid.append(spark.table(table))
    joined = join_using(*laid, "orderkey").groupBy("o_orderpriority", "l_returnflag")
    return joined.agg(F.count(F.lit(1)).alias("cnt"), F.sum("l_linenumber").alias("line_sum"))


# --- the questions on rental frames -----------------------------------------------------------


class _Rental(dict):
    """Parts as films, brands as categories, suppliers as actors, order lines as rentals.

    A copy in the inventory is a part at a supplier. Only the frames a question asks for are
    built.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.table = partial(read_table, spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self, name)()
        return self[name]

    @staticmethod
    def _brand():
        return F.substring("p_brand", 7, 9).cast("int").alias("category_id")

    @staticmethod
    def _copy():
        return (F.col("l_partkey") * 1_000_000_000 + F.col("l_suppkey")).alias("inventory_id")

    @staticmethod
    def _line():
        return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("rental_id")

    def category(self):
        return self.table("part").select(self._brand(), F.col("p_brand").alias("name")).distinct()

    def film(self):
        return self.table("part").select(F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"))

    def film_category(self):
        return self.table("part").select(F.col("p_partkey").alias("film_id"), self._brand())

    def _pairs(self):
        """Parts and their suppliers. Both frames made of them filter nulls here, so that they share one shuffle."""
        pairs = self.table("lineitem").select("l_partkey", "l_suppkey")
        return pairs.where("l_partkey IS NOT NULL AND l_suppkey IS NOT NULL").distinct()

    def film_actor(self):
        return self._pairs().select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id"))

    def actor(self):
        name = F.split("s_name", "#")
        return self.table("supplier").select(
            F.col("s_suppkey").alias("actor_id"), name[0].alias("first_name"), name[1].alias("last_name")
        )

    def inventory(self):
        return self._pairs().select(self._copy(), F.col("l_partkey").alias("film_id"))

    def rental(self):
        lines, orders = self.table("lineitem"), self.table("orders")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            self._line(),
            self._copy(),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("rental_date"),
            F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("return_date"),
        )

    def payment(self):
        return self.table("lineitem").select(self._line(), money(F.col("l_extendedprice")).alias("amount"))

    def customer(self):
        active = F.when(F.col("c_mktsegment") == "BUILDING", 2).when(F.col("c_acctbal") >= 0, 1).otherwise(0)
        key = F.col("c_custkey")
        return self.table("customer").select(key.alias("customer_id"), key.alias("address_id"), active.alias("active"))

    def address(self):
        return self.table("customer").select(
            F.col("c_custkey").alias("address_id"), F.col("c_nationkey").alias("city_id")
        )

    def city(self):
        """Names such as "ASIA 4" and "AFRICA-12"."""
        number = F.replace(F.replace("n_name", F.lit("NATION_"), F.lit(" ")), F.lit(" 1"), F.lit("-1"))
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("city_id"), F.concat("r_name", number).alias("city")
        )


_RENTAL_SQL = """
    WITH category AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_brand AS name FROM part),
    film AS (SELECT p_partkey AS film_id, p_name AS title FROM part),
    film_category AS (SELECT p_partkey AS film_id, CAST(substr(p_brand, 7) AS INTEGER) AS category_id FROM part),
    film_actor AS (SELECT DISTINCT l_partkey AS film_id, l_suppkey AS actor_id FROM lineitem),
    actor AS (SELECT s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name,
                     split_part(s_name, '#', 2) AS last_name FROM supplier),
    inventory AS (SELECT DISTINCT l_partkey * 1000000000 + l_suppkey AS inventory_id, l_partkey AS film_id FROM lineitem),
    rental AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rental_id, l_partkey * 1000000000 + l_suppkey AS inventory_id,
                      o_custkey AS customer_id, o_orderdate AS rental_date,
                      CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS return_date
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    payment AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rental_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
                FROM lineitem),
    client AS (SELECT c_custkey AS customer_id, c_custkey AS address_id,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN 2 WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS active
               FROM customer),
    address AS (SELECT c_custkey AS address_id, c_nationkey AS city_id FROM customer),
    city AS (SELECT n_nationkey AS city_id,
                    r_name || replace(replace(n_name, 'NATION_', ' '), ' 1', '-1') AS city
             FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


def _rental_query(name: str, plan: Callable[..., DataFrame], sql: str, **options) -> None:
    def run(spark, sf_dir):
        return plan(_Rental(spark, sf_dir), **options)

    _query(_RENTAL_SQL + sql, name=name)(run)


_rental_query(
    "rental_films_per_category",
    rental.films_per_category,
    """
    SELECT name, count(*) AS cnt FROM film JOIN film_category USING (film_id) JOIN category USING (category_id)
    GROUP BY category_id, name
    """,
)

_ACTOR_COUNTS = """
    , per_actor AS (
        SELECT actor_id, first_name, last_name, count(*) AS rental_cnt
        FROM rental JOIN inventory USING (inventory_id) JOIN film USING (film_id)
        JOIN film_actor USING (film_id) JOIN actor USING (actor_id)
        GROUP BY actor_id, first_name, last_name
    )
"""
_MOST_RENTED = _ACTOR_COUNTS + """
    SELECT first_name, last_name, rental_cnt, actor_rental_rank FROM (
        SELECT *, rank() OVER (ORDER BY rental_cnt DESC) AS actor_rental_rank FROM per_actor
    ) AS ranked WHERE actor_rental_rank <= 10
"""
_rental_query("rental_most_rented_actors", rental.most_rented_actors, _MOST_RENTED)


@_query(_RENTAL_SQL + _MOST_RENTED, name="rental_from_snapshots")
def rental_from_snapshots(spark, sf_dir):
    """Whole rental tables landed as CSV, with columns that no question uses, then loaded and asked."""
    root, given = scratch_path(spark, "bronze"), _Rental(spark, sf_dir)
    schemas_of = {}
    for table in ("rental", "inventory", "film", "film_actor", "actor"):
        df = given[table]
        schemas_of[table] = df.schema
        more = df.select(F.lit("x|y").alias("remark"), "*", F.lit(None).cast("string").alias("last_update"))
        medallion.land_table(more, root, table, EVENT_DAY)
    return rental.most_rented_actors(read_snapshots(spark, root, schemas_of, EVENT_DAY, "|"))


_rental_query(
    "rental_most_rented_actors_cut",
    rental.most_rented_actors,
    _ACTOR_COUNTS
    + "SELECT first_name, last_name, rental_cnt FROM per_actor ORDER BY rental_cnt DESC, actor_id LIMIT 10",
    keep_ties=False,
)
_rental_query(
    "rental_top_category_by_amount",
    rental.top_category_by_amount,
    """
    SELECT * FROM (
        SELECT name, CAST(sum(amount) AS DECIMAL(28,2)) AS amt, rank() OVER (ORDER BY sum(amount) DESC) AS category_amt_rank
        FROM rental JOIN inventory USING (inventory_id) JOIN payment USING (rental_id) JOIN film USING (film_id)
        JOIN film_category USING (film_id) JOIN category USING (category_id)
        GROUP BY category_id, name
    ) AS ranked WHERE category_amt_rank = 1
    """,
)
_ACTORS_OF_CATEGORY = """
    SELECT * FROM (
        SELECT first_name, last_name, count(*) AS actor_film_cnt, dense_rank() OVER (ORDER BY count(*) DESC) AS actor_rank
        FROM category JOIN film_category USING (category_id) JOIN film USING (film_id)
        JOIN film_actor USING (film_id) JOIN actor USING (actor_id)
        WHERE name = 'Brand#7' GROUP BY actor_id, first_name, last_name
    ) AS ranked WHERE actor_rank <= 3
"""
_rental_query(
    "rental_top_actors_of_category",
    partial(rental.top_actors_of_category, category="Brand#7"),
    _ACTORS_OF_CATEGORY,
)
_rental_query(
    "rental_top_actors_reduced",
    partial(rental.top_actors_of_category, category="Brand#7"),
    _ACTORS_OF_CATEGORY,
    reduce=True,
)
_CITY_COUNTS = """
    SELECT city, CAST(sum(active) AS BIGINT) AS active_cnt,
           CAST(sum(CASE WHEN active {rule} THEN 1 ELSE 0 END) AS BIGINT) AS inactive_cnt
    FROM city JOIN address USING (city_id) JOIN client USING (address_id) GROUP BY city_id, city
"""
_rental_query("rental_customers_per_city", rental.customers_per_city, _CITY_COUNTS.format(rule="= 0"))
_rental_query(
    "rental_customers_per_city_not_one",
    rental.customers_per_city,
    _CITY_COUNTS.format(rule="<> 1"),
    inactive="not_one",
)
_CITY_TIMES = """
    , spent AS (
        SELECT name, city, {measure} AS spent
        FROM category JOIN film_category USING (category_id) JOIN inventory USING (film_id)
        JOIN rental USING (inventory_id) JOIN client USING (customer_id)
        JOIN address USING (address_id) JOIN city USING (city_id)
        WHERE return_date IS NOT NULL
    ), per_group AS (
        SELECT 'most popular category for A% cities:' AS title, name, sum(spent) AS total
        FROM spent WHERE lower(city) LIKE 'a%' GROUP BY name
        UNION ALL
        SELECT 'most popular category for %-% cities:', name, sum(spent) FROM spent WHERE city LIKE '%-%' GROUP BY name
    )
    SELECT title, name FROM (
        SELECT title, name, rank() OVER (PARTITION BY title ORDER BY total DESC) AS rnk FROM per_group
    ) AS ranked WHERE rnk = 1
"""
_rental_query(
    "rental_longest_in_cities",
    rental.longest_rented_categories,
    _CITY_TIMES.format(measure="date_diff('microsecond', rental_date, return_date)"),
)
_rental_query(
    "rental_longest_reduced",
    rental.longest_rented_categories,
    _CITY_TIMES.format(measure="date_diff('microsecond', rental_date, return_date)"),
    reduce=True,
)
_rental_query(
    "rental_longest_in_cities_days",
    rental.longest_rented_categories,
    _CITY_TIMES.format(measure="CAST(return_date AS DATE) - CAST(rental_date AS DATE)"),
    measure="days",
)


@_query("""
    SELECT o_orderpriority AS title FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def rental_films_without_inventory(spark, sf_dir):
    """Orders as films: parts all have lines, while some orders have none."""
    orders, lines = (read_table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    return rental.films_without_inventory(
        {
            "film": orders.select(F.col("o_orderkey").alias("film_id"), F.col("o_orderpriority").alias("title")),
            "inventory": lines.select(F.col("l_orderkey").alias("film_id")),
        }
    )


# --- driver contract --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The seven-table question of the rental plans, on the smallest tables."""
    return q7_longest_by_pattern(spark, "/root/testdata/sf0.001")


def own_queries() -> dict[str, Query]:
    """The queries of this module, without those of the corpus subpackage."""
    return dict(_QUERIES)


def _corpus(attribute: str) -> dict:
    """What the corpus subpackage and the corpus pipeline add, where they are installed."""
    found = {}
    subpackage = importlib.util.find_spec("lakeshelf.llm")
    if subpackage and subpackage.origin:  # an empty folder has none
        found |= getattr(importlib.import_module("lakeshelf.llm.queries"), attribute)
        if importlib.util.find_spec("corpus_pipeline"):
            pipeline = importlib.import_module("corpus_pipeline")
            found |= {"QUERIES": {"pipeline": pipeline.run}, "SQL": {"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {}}[attribute]
    return found


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_corpus("QUERIES")}


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **_corpus("SQL")}
