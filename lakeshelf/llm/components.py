"""Connected components of a link table, by contraction.

Each task first contracts the links it reads: every node of a local component is tied to the smallest
one, which shortens paths and drops all other links. Where that does not leave stars, a round hangs each node's
larger neighbours on its smallest one, then each node and its smaller neighbours on the smallest of
these, and tasks contract again. Rounds are joins and grouped minima over edges, written to the
shared scratch folder, so no group is ever held by one task: a node with very many neighbours is
reduced map-side to its minimum, and the join with it is one that Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.stored import stored

#: Links that a task holds at once.
CHUNK = 4_000_000


def _local(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component), without the smallest ones themselves."""
    ids, of = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = of[: len(a)], of[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for ends in (a, b, root[a], root[b]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    tied = np.flatnonzero(root != np.arange(len(ids)))
    return ids[tied], ids[root[tied]]


def _contracted(edges: DataFrame) -> DataFrame:
    def read(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tied() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _local(table.column(0).to_numpy(), table.column(1).to_numpy())], ["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > CHUNK:
                yield tied()
                held.clear()
        if held:
            yield tied()

    return edges.select("u", "v").mapInArrow(read, "u bigint, v bigint")


def _least(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest v per u. Grouping by a hash as well makes Spark shuffle the result for the join, which it can then split."""
    return edges.groupBy("u", F.xxhash64("u").alias("_hash")).agg(F.min("v").alias("least")).drop("_hash")


def _are_stars(edges: DataFrame) -> bool:
    """Is every node tied to one other only, and no node both tied and a centre?"""
    ends = edges.select(F.col("u").alias("id"), "v").unionByName(edges.select(F.col("v").alias("id"), F.lit(None).cast("bigint").alias("v")))
    seen = ends.groupBy("id").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count_if(F.col("v").isNull()).alias("centre"))
    return seen.where("low != high OR (low IS NOT NULL AND centre > 0)").isEmpty()


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    hung = large.join(_least(large), "u")
    small = hung.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return small.unionByName(hung.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id it is connected with."""
    edges = links.select(F.col("a").cast("bigint").alias("u"), F.col("b").cast("bigint").alias("v")).where("u != v")
    edges = stored(_contracted(edges), "edges")
    for _ in range(max_rounds):
        if _are_stars(edges):
            break
        edges = stored(_contracted(_round(edges)), "edges")
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    tied = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return tied.unionByName(centres).distinct()
