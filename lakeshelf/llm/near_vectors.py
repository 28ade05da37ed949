"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are scaled to length one, where a cosine bound is a distance bound. A table hashes a vector
by quantised random projections; vectors of one label that agree in all projections of a table
share a bucket. The number of projections grows with the logarithm of the largest label, so that
chance brings few vectors together, and the number of tables follows from the chance of missing a
pair exactly at the bound. Buckets are then checked by exact cosines in double precision.

Projections are whole numbers (scaled vectors and directions are rounded first), so every task works out the same
codes, in whatever batches. A pair that meets in several tables is counted in the first of them,
which both vectors' codes tell without comparing notes.

Equal vectors are one node with a number of copies. Buckets with more than ``BLOCK`` nodes are cut
into blocks of pairs of chunks, so that a bucket with a third of all vectors is checked by many
tasks; tasks return counts and one edge per node, never the pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, vectors
with a null label, and rows with a null id are linked with nothing; vectors of different length are
never linked; rows that repeat an id count as vectors of their own, in one component if equal; an
empty table gives an empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.components import components
from lakeshelf.llm.stored import stored
from lakeshelf.llm.words import mixed

COSINE = 0.93
#: Width of a quantisation step, in units of the sphere's radius.
WIDTH = 2.0
#: Chance of missing a pair exactly at the bound.
MISSED = 1e-6
#: Nodes that chance may bring into a vector's bucket.
MATES = 16
#: Nodes that one task compares with one another or with as many others.
BLOCK = 1024
_U = np.uint64


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection agrees for two points at a distance."""
    c = width / distance
    tail = 0.5 * math.erfc(c / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


@dataclass(frozen=True)
class Hashing:
    projections: int
    tables: int
    width: float = WIDTH
    seed: int = 7

    @classmethod
    def for_size(cls, n: int, cosine: float = COSINE) -> Hashing:
        near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
        projections = max(4, math.ceil(math.log(max(n / MATES, 1)) / -math.log(far)))
        return cls(projections, math.ceil(math.log(MISSED) / math.log1p(-(near**projections))))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per row and table for vectors of one length."""
        dim = vectors.shape[1]
        rng = np.random.default_rng([self.seed, dim])
        directions = np.rint(rng.standard_normal((dim, self.tables * self.projections)) * 2**12)
        shifts = np.rint(rng.uniform(0, self.width, self.tables * self.projections) * 2**32)
        unit = np.rint(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * 2**20)
        # Products and sums stay below 2 ** 53, so that doubles are exact in any order of summing.
        steps = np.floor((unit @ directions + shifts) / (self.width * 2**32)).astype(np.int64).astype(_U)
        steps = steps.reshape(len(vectors), self.tables, self.projections)
        state = np.full((len(vectors), self.tables), dim, _U)
        for i in range(self.projections):
            state = mixed((state ^ steps[:, :, i]) * _U(0x9FB21C651E98DF25) + _U(1))
        return state


def usable(vector: str) -> Column:
    """Not null or empty, all components finite, not all zero."""
    column = F.col(vector)
    finite = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _by_length(column: pa.Array) -> Iterator[np.ndarray]:
    sizes = np.asarray(column.value_lengths())
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def with_buckets(nodes: DataFrame, hashing: Hashing) -> DataFrame:
    """(node, label, dim, table, bucket) for each node and table."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                for rows in _by_length(part.column(2)):
                    own = part.take(pa.array(rows))
                    codes = hashing.codes(matrix(own.column(2))).astype(np.int64)
                    bounds = np.arange(len(rows) + 1, dtype=np.int32) * codes.shape[1]
                    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(codes.ravel()))
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), lists], ["node", "label", "codes"])

    label = nodes.schema["label"].dataType.simpleString()
    coded = nodes.select("node", "label", "embedding").mapInArrow(read, f"node bigint, label {label}, codes array<bigint>")
    return coded.select("node", F.posexplode("codes").alias("table", "code"), "label").select(
        "node", "table", F.xxhash64("label", "code").alias("bucket")
    )


def _compare(batches, hashing: Hashing, cosine: float) -> Iterator[pa.RecordBatch]:
    """Sorted block rows in; per node and block its links and one edge out."""
    held: list[pa.RecordBatch] = []

    def finished(table: pa.Table, last: bool) -> tuple[list, pa.Table]:
        keys = [table.column(c).to_numpy() for c in ("table", "bucket", "low", "high")]
        change = np.zeros(len(table), bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        starts = np.append(0, np.flatnonzero(change)) if len(table) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(table))
        n = len(starts) if last else len(starts) - 1
        return [(int(a), int(b)) for a, b in zip(starts[:n], ends[:n])], table.slice(int(starts[n])) if n < len(starts) else table.slice(len(table))

    def judged(table: pa.Table, runs: list) -> pa.RecordBatch:
        node, chunk, copies, low, high, order = (table.column(c).to_numpy() for c in ("node", "chunk", "copies", "low", "high", "table"))
        vectors = table.column("embedding").combine_chunks()
        labels = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        pairs = [np.zeros((2, 0), np.int64)]
        for rows in _by_length(vectors):
            x = matrix(vectors.take(pa.array(rows)))
            norm = np.sqrt((x * x).sum(axis=1))
            place = np.full(len(table), -1)
            place[rows] = np.arange(len(rows))
            # Runs of one size are compared together; one with vectors of several lengths is a clash of hashes only.
            by_size: dict[int, list[int]] = {}
            for first, end in runs:
                if end - first > 1 and place[first] >= 0 and (place[first:end] >= 0).all():
                    by_size.setdefault(end - first, []).append(first)
            for size, firsts in by_size.items():
                at_once = max(1, (1 << 20) // (size * size))
                for cut in range(0, len(firsts), at_once):
                    at = np.array(firsts[cut : cut + at_once])[:, None] + np.arange(size)
                    own = place[at]
                    near = np.matmul(x[own], x[own].transpose(0, 2, 1)) >= cosine * (norm[own][:, :, None] * norm[own][:, None, :])
                    run, i, j = np.nonzero(near & np.triu(np.ones((size, size), bool), 1))
                    pairs.append(np.stack([at[run, i], at[run, j]]))
        i, j = np.concatenate(pairs, axis=1)
        # In a block of two chunks, pairs within a chunk belong to other blocks.
        keep = (labels[i] == labels[j]) & ((low[i] == high[i]) | (chunk[i] != chunk[j]))
        i, j = i[keep], j[keep]
        if len(i):
            some, of = np.unique(np.append(i, j), return_inverse=True)
            codes = np.zeros((len(some), hashing.tables), np.uint64)
            for rows in _by_length(vectors.take(pa.array(some))):
                codes[rows] = hashing.codes(matrix(vectors.take(pa.array(some[rows]))))
            fresh = np.ones(len(i), bool)
            for cut in range(0, len(i), 1 << 14):
                part = slice(cut, cut + (1 << 14))
                same = codes[of[: len(i)][part]] == codes[of[len(i) :][part]]
                fresh[part] = ~(same & (np.arange(hashing.tables) < order[i[part], None])).any(axis=1)
            i, j = i[fresh], j[fresh]
        links = np.bincount(i, copies[j], len(table)) + np.bincount(j, copies[i], len(table))
        root = np.arange(len(table))
        while True:  # smallest row reachable inside the block
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            new = new[new]
            if (new == root).all():
                break
            root = new
        found = np.flatnonzero(links)
        columns = node[found], links[found].astype(np.int64), node[root[found]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "other"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < 8192:
            continue
        table = pa.Table.from_batches(held)
        runs, rest = finished(table, False)
        yield judged(table, runs)
        held = rest.combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield judged(table, finished(table, True)[0])


def links_of_nodes(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(node, links, other): links found per node and block, and a node it is connected with.

    ``nodes`` (node, label, embedding, copies) is a stored table of distinct vectors.
    """
    most = nodes.groupBy("label", F.size("embedding")).count().agg(F.max("count")).first()[0] or 0
    hashing = Hashing.for_size(most, cosine)
    rows = with_buckets(nodes, hashing)
    # Most buckets hold one vector. Grouping by a hash as well lets Spark split the join at a crowded bucket.
    sizes = rows.groupBy("table", "bucket", F.xxhash64("bucket", "table").alias("_hash")).agg(F.count(F.lit(1)).alias("n")).drop("_hash")
    rows = rows.join(sizes.where("n > 1"), ["table", "bucket"])
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.select("node", "table", "bucket", F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"), chunks.alias("chunks"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    rows = rows.select("node", "table", "bucket", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    rows = rows.join(nodes, "node").select("table", "bucket", "low", "high", "chunk", "node", "label", "copies", "embedding")
    blocks = rows.repartition("table", "bucket", "low", "high").sortWithinPartitions("table", "bucket", "low", "high", "node")
    return blocks.mapInArrow(lambda batches: _compare(batches, hashing, cosine), "node bigint, links bigint, other bigint")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    valid = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    nodes = rows.where(valid).groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes, "nodes")
    found = stored(links_of_nodes(nodes, cosine), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "node")
    result = nodes.join(links, "node", "left").join(member, "node", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("root")
    )
    # Copies of one vector may be a third of all rows: an outer join of two shuffled inputs can be split.
    joined = rows.join(stored(result, "results"), ["label", "embedding"], "left")
    root = F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("root")), F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("vec_id") == root, F.lit(True)).alias("kept"),
    )
