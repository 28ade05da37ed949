"""Replacing folders: whatever dies, old or new rows are there."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeshelf.session import scratch_path
from lakeshelf.sinks import swap
from lakeshelf.sinks.days import read_days, reload_day, reload_days
from lakeshelf.sinks.files import write_parquet
from lakeshelf.sources.files import exists

DAYS = [dt.date(2021, 1, d) for d in (1, 2, 3)]


class Died(Exception):
    pass


def numbers(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("n"))


def found(spark, root, day=DAYS[0]):
    return sorted(r.n for r in read_days(spark, root, day, day).collect())


def aside(root):
    return [n for n in os.listdir(root.removeprefix("file:")) if n.startswith(("_new.", "_old."))]


def failing(df, after):
    """The write fails in a task after another one has written its file."""
    return df.repartition(4).withColumn("n", F.when(F.col("n") == after, F.raise_error(F.lit("no disk")).cast("bigint")).otherwise(F.col("n")))


def test_write_that_fails_leaves_the_old_rows(spark):
    root = scratch_path(spark, "fact")
    reload_day(numbers(spark, 0, 5), root, DAYS[0])
    with pytest.raises(Exception, match="no disk"):
        reload_day(failing(numbers(spark, 0, 1000), 999), root, DAYS[0], files=4)
    # Twenty tasks on eight cores: several have written their file when the last one fails.
    rows = spark.range(0, 1000, 1, 20).select(F.when(F.col("id") == 999, F.raise_error(F.lit("no disk")).cast("bigint")).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="no disk"):
        swap.replace_folder(spark, f"{root}/report_date={DAYS[0]}", lambda staged: rows.write.parquet(staged))
    assert found(spark, root) == list(range(5))
    reload_day(numbers(spark, 7, 9), root, DAYS[0])
    assert found(spark, root) == [7, 8] and aside(root) == []


def test_whole_table_that_fails_stays(spark):
    path = scratch_path(spark, "dim")
    write_parquet(numbers(spark, 0, 5), path)
    with pytest.raises(Exception, match="no disk"):
        write_parquet(failing(numbers(spark, 0, 1000), 999), path, 4)
    assert spark.read.parquet(path).count() == 5
    write_parquet(spark.read.parquet(path).where("n > 2"), path)  # a table may be rewritten from itself
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [3, 4]


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_death_at_each_step_of_the_swap(spark, monkeypatch, dies_at):
    """1: before the first rename, 2: between the renames, 3: before the old folder is removed."""
    root = scratch_path(spark, "fact")
    reload_day(numbers(spark, 0, 5), root, DAYS[0])
    reload_day(numbers(spark, 50, 52), root, DAYS[1])
    steps = []

    def step(function):
        def run(*args):
            steps.append(function.__name__)
            if len(steps) >= dies_at:
                raise Died
            return function(*args)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(swap, "rename", step(swap.rename))
        patch.setattr(swap, "remove", step(swap.remove))
        with pytest.raises(Died):
            reload_day(numbers(spark, 10, 13), root, DAYS[0])
    live = exists(spark, f"{root}/report_date={DAYS[0]}")
    assert live == (dies_at != 2) and aside(root)
    assert found(spark, root) == (list(range(5)) if dies_at == 1 else [10, 11, 12])
    assert found(spark, root, DAYS[1]) == [50, 51]
    reload_day(numbers(spark, 20, 21), root, DAYS[0])
    assert found(spark, root) == [20] and aside(root) == []


def test_unfinished_folder_is_never_put_in_place(spark):
    root = scratch_path(spark, "fact")
    live = f"{root}/report_date={DAYS[0]}"
    reload_day(numbers(spark, 0, 5), root, DAYS[0])
    numbers(spark, 10, 12).write.parquet(f"{root}/_new.report_date-{DAYS[0]}.abc")
    os.remove(f"{root}/_new.report_date-{DAYS[0]}.abc/_SUCCESS".removeprefix("file:"))
    with pytest.raises(OSError, match="not a finished write"):
        swap.swap(spark, f"{root}/_new.report_date-{DAYS[0]}.abc", live)
    swap.rename(spark, live, f"{root}/_old.report_date-{DAYS[0]}.abc")
    assert found(spark, root) == list(range(5))


def test_reader_that_finishes_a_swap_does_no_harm(spark, monkeypatch):
    root = scratch_path(spark, "fact")
    reload_day(numbers(spark, 0, 5), root, DAYS[0])
    real, calls = swap.rename, []

    def rename(spark_, source, target):
        calls.append(target)
        if len(calls) == 2:  # between the writer's renames
            monkeypatch.setattr(swap, "rename", real)
            assert found(spark, root) == [10, 11]
        real(spark_, source, target)

    monkeypatch.setattr(swap, "rename", rename)
    reload_day(numbers(spark, 10, 12), root, DAYS[0])
    assert found(spark, root) == [10, 11] and aside(root) == []


def test_range_that_fails_leaves_every_day(spark):
    root = scratch_path(spark, "fact")
    rows = spark.range(90).select(F.element_at(F.array(*map(F.lit, DAYS)), (F.col("id") % 3 + 1).cast("int")).alias("report_date"), F.col("id").alias("n"))
    reload_days(rows, root, DAYS)
    with pytest.raises(Exception, match="no disk"):
        reload_days(failing(rows, 89), root, DAYS)
    with pytest.raises(Exception, match="none of the days"):
        reload_days(rows, root, DAYS[:2])
    assert [len(found(spark, root, day)) for day in DAYS] == [30, 30, 30]
    reload_days(rows.where("n < 2"), root, DAYS)
    assert [found(spark, root, day) for day in DAYS] == [[0], [1], []]
