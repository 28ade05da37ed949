"""JSON payloads of the out-of-stock service: arrays of objects, or of bare product ids.

A document that does not parse raises. The permissive default would turn a whole day into one
row of nulls, or into no row at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lakeshelf.llm.stored import ship_package
from lakeshelf.schemas import OUT_OF_STOCK


def read_json_objects(
    spark: SparkSession, path: str, schema: StructType = OUT_OF_STOCK, multi_line: bool = False
) -> DataFrame:
    """Rows of JSON documents, each an object or an array of objects.

    There is one document per line, or with ``multi_line`` one per file. Fields outside the
    schema are not read; single-quoted text is accepted.
    """
    return spark.read.schema(schema).options(mode="FAILFAST", multiLine=multi_line).json(path)


def read_json_numbers(
    spark: SparkSession, path: str, name: str = "product_id", multi_line: bool = False
) -> DataFrame:
    """Rows of documents that hold a bare array of numbers, one per line or one per file."""
    numbers = F.from_json("value", "array<bigint>", {"mode": "FAILFAST"})
    return spark.read.text(path, wholetext=multi_line).select(F.explode(numbers).alias(name))


def field_of_objects(items: str, field: str) -> Column:
    """The array of one field's values from an array of objects."""
    return F.transform(F.col(items), lambda item: item[field])


def read_json_array(spark: SparkSession, path: str, schema: StructType = OUT_OF_STOCK, file: str | None = None) -> DataFrame:
    """Rows of files that each hold one JSON array of objects, of any size and spread over lines in any way, read by many tasks.

    A file is cut at every closing brace, so Spark's own splits of a text apply, and the records are put together again. Whether
    a brace ends a record depends on all text before it: it must be outside of quotes and close the outermost object. So each split
    first tells what it would do to quotes and depth for either state it may begin in, a window over these few sums (one row a
    split) gives every split its state, and then each split finds its own records. Only the texts at the two ends of a split
    leave it, to be joined with those of its neighbours; records are not shuffled, the text is read three times instead. Objects, arrays and
    braces inside of records may be nested and quoted at will.

    One split is handled by one task (``spark.sql.files.maxPartitionBytes``), and a record by one row. What does not parse raises, as does a
    file that holds anything else than one array of objects. With ``file`` a last column of that name has the path of each row's file.
    """
    ship_package(spark)
    split = ["file", "block"]
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # The last piece of a file gets a brace that is not there; ``wrong`` below knows.
        F.concat("value", F.lit("}")).alias("piece"),
    )
    sums = pieces.mapInArrow(_split_sums, "file string, block bigint, odd bigint, change0 bigint, change1 bigint")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("state", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    own = F.when(F.col("state") == 0, F.col("change0")).otherwise(F.col("change1"))
    sums = sums.select(*split, "state", F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("depth"))
    # One row a split.
    known = pieces.join(F.broadcast(sums), split).select(*split, "piece", "state", "depth")
    inner, rest = (
        known.mapInArrow(partial(_split_records, inside=inside), "file string, block bigint, nth int, piece string, ends int") for inside in (True, False)
    )
    stitch = Window.partitionBy("file").orderBy("block", "nth").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("run", F.coalesce(F.sum("ends").over(stitch), F.lit(0)))
    listed = F.sort_array(F.collect_list(F.struct("block", "nth", "piece")))
    rest = rest.groupBy("file", "run").agg(listed.alias("pieces"), F.max("ends").alias("ends"))
    rest = rest.withColumn("piece", F.array_join(F.transform("pieces", lambda p: p["piece"]), ""))
    # What follows the last record lies here, too; a file without that ends too early.
    rest = rest.withColumn("closed", F.min("ends").over(Window.partitionBy("file")) == 0)
    records = inner.select("file", "piece", "ends", F.lit(True).alias("closed"))
    records = records.unionByName(rest.select("file", "piece", "ends", "closed"))
    head = F.regexp_replace("piece", r"^\s*[\[,]?\s*", "")
    wrong = F.raise_error(F.lit("a file does not hold one array of objects"))
    record = F.when(~F.col("closed"), wrong).when((F.col("ends") == 1) & head.startswith("{"), head)
    record = record.when((F.col("ends") == 0) & F.col("piece").rlike(r"^\s*(\[\s*)?\]\s*\}$"), F.lit(None)).otherwise(wrong)
    rows = records.select("file", record.alias("record")).where("record IS NOT NULL")
    rows = rows.select("file", F.from_json("record", schema, {"mode": "FAILFAST"}).alias("row"))
    return rows.select("row.*", *([F.col("file").alias(file)] if file else []))


_QUOTE, _SLASH, _CLOSE = b'"\\}'
_CHANGE = np.zeros(256, np.int64)
_CHANGE[list(b"{[")], _CHANGE[list(b"}]")] = 1, -1


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where quotes, braces and brackets stand that no backslash precedes, and which; a closing brace always counts, as files are cut there."""
    at = np.flatnonzero((_CHANGE[data] != 0) | (data == _QUOTE))
    slashes = np.flatnonzero(data == _SLASH)
    if len(slashes):
        begins = np.append(True, np.diff(slashes) != 1)
        begin = slashes[np.maximum.accumulate(np.where(begins, np.arange(len(slashes)), 0))]
        escaped = np.zeros(len(data) + 1, bool)
        escaped[slashes[(slashes - begin) % 2 == 0] + 1] = True
        at = at[~escaped[at] | (data[at] == _CLOSE)]
    return at, data[at]


def _by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch, np.ndarray]]:
    """(file, block), a first row, and the bytes of all pieces; a task has the pieces of a split in order, in one batch or several."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, text = batch.column(0), batch.column(1).to_numpy(), batch.column(2).cast(pa.large_string())
        change = (block[1:] != block[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset :]
        data = np.frombuffer(text.buffers()[2], np.uint8)
        for low, high in zip(bounds, bounds[1:]):
            yield (file[low].as_py(), int(block[low])), batch.slice(low, 1), data[offsets[low] : offsets[high]]


def _split_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split its quotes, and the change of depth if it begins outside of quotes or inside."""
    sums: dict[tuple[str, int], list[int]] = {}
    for key, _, data in _by_split(batches):
        odd, change0, change1 = sums.get(key, (0, 0, 0))
        _, char = _marks(data)
        quotes = char == _QUOTE
        inside = (np.cumsum(quotes) - quotes + odd) % 2
        change = _CHANGE[char]
        sums[key] = [odd + int(quotes.sum()), change0 + int(change[inside == 0].sum()), change1 + int(change[inside == 1].sum())]
    yield pa.RecordBatch.from_pylist(
        [{"file": f, "block": b, "odd": odd, "change0": c0, "change1": c1} for (f, b), (odd, c0, c1) in sums.items()],
        pa.schema({"file": pa.string(), "block": pa.int64(), "odd": pa.int64(), "change0": pa.int64(), "change1": pa.int64()}),
    )


def _split_records(batches: Iterable[pa.RecordBatch], inside: bool) -> Iterator[pa.RecordBatch]:
    """The records that lie in a split, or if not ``inside`` the texts up to the end of its first record and behind its last one."""

    def rows(nth: int, texts: pa.Array, ends: int) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.repeat(pa.scalar(key[0], pa.string()), n), pa.repeat(pa.scalar(key[1], pa.int64()), n), pa.repeat(pa.scalar(nth, pa.int32()), n)]
        return pa.RecordBatch.from_arrays([*columns, texts, pa.repeat(pa.scalar(ends, pa.int32()), n)], ["file", "block", "nth", "piece", "ends"])

    def texts(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
        buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers).cast(pa.string())

    key, held, seen, odd, depth = None, [], False, 0, 0

    def tail() -> Iterator[pa.RecordBatch]:
        if not inside and sum(map(len, held)):
            data = np.concatenate(held)
            yield rows(2, texts(data, np.array([0, len(data)])), 0)

    for split, row, data in _by_split(batches):
        if split != key:
            yield from tail()
            key, held, seen = split, [], False
            odd, depth = row.column(3)[0].as_py(), row.column(4)[0].as_py()
        at, char = _marks(data)
        quotes = char == _QUOTE
        outside = (np.cumsum(quotes) - quotes + odd) % 2 == 0
        depths = depth + np.cumsum(np.where(outside, _CHANGE[char], 0))
        odd, depth = odd + int(quotes.sum()), int(depths[-1])
        ends = at[(char == _CLOSE) & outside & (depths == 1)] + 1
        if not len(ends):
            held.append(data.copy())
            continue
        before = sum(map(len, held))
        found = texts(np.concatenate([*held, data[: ends[-1]]]), np.append(0, ends + before))
        if not seen and not inside:
            yield rows(0, found[:1], 1)
        found = found if seen else found[1:]
        if inside and len(found):
            yield rows(1, found, 1)
        held, seen = [data[ends[-1] :].copy()], True
    yield from tail()


def read_number_array(spark: SparkSession, path: str, name: str = "product_id", file: str | None = None) -> DataFrame:
    """Rows of files that each hold one array of bare whole numbers, cut at commas and so read by many tasks."""
    value = F.regexp_replace("value", r"^[\s\[]+|[\s\]]+$", "")
    number = value.try_cast("bigint")
    wrong = F.raise_error(F.concat(F.lit("not a whole number: "), value)).cast("bigint")
    items = spark.read.option("lineSep", ",").text(path).where(value != "")
    number = F.when(number.isNotNull() | (value == "null"), number).otherwise(wrong)
    return items.select(number.alias(name), *([F.col("_metadata.file_path").alias(file)] if file else []))
