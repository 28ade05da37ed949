"""License scans by diagonal voting.

All rolling two-word hashes of every text are joined with the positions at which license templates
hold the same two words. A hit votes for its diagonal, the offset between its place in the document
and its place in the template. Where all of a template's hashes meet on one diagonal, its words
stand there consecutively. Neighbouring diagonals are merged, so a template with a few words put in
or left out still gathers its votes; a merged span is verified by the share of the template's
hashes it holds and by its length.

The join is a broadcast of the template table, whose size is fixed by the templates given. Only
hits and one row per document are shuffled.

Defined cases: null and empty texts have no words and no labels; rows that repeat a document are
scanned one by one; any id, null included, is returned as it is; an empty table gives an empty
result. Columns other than ``doc_id`` and ``text`` are ignored. ``docs`` must give the same rows in
the same order when a task is repeated, as a table does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType
from pyspark.sql.window import Window

from lakeshelf.llm.words import NOT_ALNUM, Words, by_bytes, window_hashes


class Template(NamedTuple):
    label: str
    words: str
    #: Words must stand exactly like this; otherwise a merged span may differ a little.
    exact: bool = False


# Fixed phrases and labels.
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
MORE = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc", "this work is licensed under a creative commons attribution license"),
)
TEMPLATES = BASE + MORE
K = 2
#: Diagonals this near to the last one belong to the same span.
NEAR = 3
#: Share of a template's hashes that a merged span must hold.
COVER = 0.75


def _template_table(spark, templates: Sequence[Template]) -> DataFrame:
    words = Words(pa.array([t.words for t in templates]), NOT_ALNUM, lower=True)
    starts = words.window_starts(K)
    grams = window_hashes(words.hashes(), starts, K).astype(np.int64)
    owner = words.owners()[starts]
    at = starts - words.first[owner]
    size = words.counts[owner] - K + 1
    rows = [(int(g), int(o), int(a), int(s), templates[o].exact, templates[o].label) for g, o, a, s in zip(grams, owner, at, size)]
    return spark.createDataFrame(rows, "gram bigint, template int, at bigint, size bigint, exact boolean, label string")


def rolling_grams(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, place, gram): each two-word hash of each text; a text without any has one row with nulls."""
    schema = StructType(
        [
            StructField("row", LongType()),
            StructField("doc_id", docs.schema["doc_id"].dataType),
            StructField("n_words", LongType()),
            StructField("grams", ArrayType(LongType())),
        ]
    )

    def read(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 2):
                words = Words(batch.column(2), NOT_ALNUM, lower=True)
                starts = words.window_starts(K)
                grams = pa.array(window_hashes(words.hashes(), starts, K).astype(np.int64))
                bounds = np.append(0, np.cumsum(np.maximum(words.counts - K + 1, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), grams)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(words.counts.astype(np.int64)), lists], ["row", "doc_id", "n_words", "grams"]
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(read, schema)
    return rows.select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("place", "gram"))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, spans.

    ``spans`` is a list of (label, exact, start, end, share): words from ``start`` to ``end``
    (exclusive) that hold ``share`` of the template's hashes. Exact templates are listed only where complete.
    """
    table = F.broadcast(_template_table(docs.sparkSession, templates))  # a row per word of the templates
    hits = rolling_grams(docs).join(table, "gram", "left")
    # The first row of each text stays also without a hit, so that no text is lost.
    hits = hits.where("template IS NOT NULL OR place IS NULL OR place = 0").repartition("row")
    keys = ["row", "doc_id", "n_words", "template", "size", "exact", "label"]
    diagonals = hits.groupBy(*keys, (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count("template").alias("votes"), F.min("place").alias("low"), F.max("place").alias("high")
    )
    along = Window.partitionBy(*keys).orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > NEAR) | F.col("exact")
    spans = diagonals.withColumn("fresh", F.coalesce(apart, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy(*keys, "span").agg(F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"))
    share = F.when(F.col("votes") > 0, F.least(F.col("votes") / F.col("size"), F.lit(1.0)))
    fits = F.when(F.col("exact"), F.col("votes") == F.col("size")).otherwise(
        (share >= COVER) & (F.col("high") - F.col("low") < 2 * F.col("size"))
    )
    found = F.struct("label", "exact", F.col("low").alias("start"), (F.col("high") + K).alias("end"), share.alias("share"))
    return merged.groupBy("row", "doc_id", "n_words").agg(
        F.sort_array(F.collect_list(F.when(fits, found))).alias("spans"), F.max(share).alias("best")
    ).drop("row")
