"""Snapshots as validity intervals."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_plans import final_plan

from lakeshelf.operators.history import as_of, validity

DAYS = [dt.date(2021, 1, 1) + dt.timedelta(n) for n in (0, 1, 2, 5, 6, 9)]


def history(spark, rows):
    return spark.createDataFrame([(DAYS[d], *rest) for d, *rest in rows], "report_date date, id int, name string")


def plain(rows):
    out = []
    for row in {r[1:] for r in rows}:
        on = {r[0] for r in rows if r[1:] == row}
        for place in sorted(on):
            if place - 1 not in on:
                end = place
                while end + 1 in on:
                    end += 1
                out.append((*row, DAYS[place], None if end == len(DAYS) - 1 else DAYS[end]))
    return Counter(out)


def test_changes_deletions_and_returns(spark):
    rows = [(0, 1, "a"), (1, 1, "a"), (2, 1, "b"), (3, 1, "a"), (4, 1, "a"), (5, 1, "a"), (0, 2, None), (2, 2, None), (2, 2, None), (5, 3, "z"), (3, None, "n")]
    got = validity(history(spark, rows), DAYS)
    assert Counter(map(tuple, got.collect())) == plain(rows)
    assert sorted((r.id, r.name) for r in as_of(got, DAYS[2]).collect()) == [(1, "b"), (2, None)]


def test_random_histories(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(6), rnd.randrange(12), rnd.choice("ab")) for _ in range(150)]
    got = validity(history(spark, rows).withColumnRenamed("name", "valid from"), DAYS)
    assert Counter(map(tuple, got.collect())) == plain(rows)
    for day in DAYS:
        want = {(r[1], r[2]) for r in rows if DAYS[r[0]] == day}
        assert {tuple(r) for r in as_of(got, day).collect()} == want


def test_days_that_were_never_landed_end_nothing(spark):
    rows = [(0, 1, "a"), (2, 1, "a"), (5, 1, "a")]
    got = validity(history(spark, rows), [DAYS[0], DAYS[2], DAYS[5]])
    assert [tuple(r) for r in got.collect()] == [(1, "a", DAYS[0], None)]
    assert validity(history(spark, rows).limit(0), DAYS).count() == 0
    # Rows of days outside of the list are left out; the last landed day may be empty.
    assert [tuple(r) for r in validity(history(spark, rows), DAYS[:2]).collect()] == [(1, "a", DAYS[0], DAYS[0])]
    with pytest.raises(ValueError):
        validity(history(spark, rows), [])


def test_hot_key_is_combined_before_the_one_shuffle(spark):
    """One row that a third of all landed rows repeat travels as one short list a task."""
    rows = spark.range(120_000).select(
        F.element_at(F.array(*map(F.lit, DAYS)), (F.col("id") % 6 + 1).cast("int")).alias("report_date"),
        F.when(F.col("id") % 18 < 6, -1).otherwise(F.col("id") % 500).alias("id"),
    )
    got = validity(rows, DAYS)
    plan = final_plan(got)
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "partial_collect_set" in plan
    assert [tuple(r)[1:] for r in got.where("id = -1").collect()] == [(DAYS[0], None)]
