"""Hard negatives for contrastive training, scored exactly by Kronecker-packed products.

Components are whole numbers (``floor(256 * x)``). A block of candidates is packed: the components
of several candidates, each raised by a bias so that none is negative, lie in separate fields of one wide
integer per dimension. One multiplication per anchor component and integer then serves all candidates in it,
and the sums of the products are unpacked into exact scores, from which the biases' known share is taken off.
Fields are wide enough for the largest possible sum, so none runs into the next. An integer has up to 53 bits, which a
double holds exactly: as nothing is negative, every partial sum stays below 2 ** 53 in whatever order
a matrix product adds. Where one field alone needs more, Python's unbounded integers take over.

Anchors are a stated query set and meet all rows, in blocks: rows are dealt by a hash of their id, and each block of rows
meets each block of anchors in a task of its own, twice. The first pass finds each anchor's
positives among the rows of its label, the second the negatives between the bounds that each positive sets. A task returns the
best few per anchor (or positive), and a ranking that cuts before its shuffle merges blocks. No label, however common, is a key.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no part;
rows meet rows of their vector length only, also of length 0 (score 0); equal scores rank by id; rows that repeat an anchor's id are one
anchor, by the smallest of (label, vector), and never its partners; rows that repeat another id are rows of their own and may fill
several places, as positives too; an anchor without positives, or a positive without negatives, has no rows; a score
that does not fit 64 bits raises. Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshelf.llm.stored import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these shares of the positive's, in hundredths.
EASIEST, HARDEST = 30, 90
ROW_BYTES, ANCHOR_BYTES = 16 << 20, 4 << 20
EXACT_BITS = 53
#: Scores held at a time.
AT_ONCE = 1 << 20


class Packed:
    """Candidates (rows of whole numbers) packed for products with anchors whose components lie in ``low`` to ``high``."""

    def __init__(self, rows: np.ndarray, low: int, high: int):
        self.n, self.dim = rows.shape
        least = int(rows.min()) if rows.size else 0
        most = int(rows.max()) if rows.size else 0
        self.row_bias, self.anchor_bias = max(0, -least), max(0, -low)
        top = max(1, self.dim * (most + self.row_bias) * (high + self.anchor_bias))
        self.width = top.bit_length()
        exact = self.width <= EXACT_BITS and rows.dtype != object
        self.kind = np.float64 if exact else object
        rows = rows if exact else rows.astype(object)
        self.fields = EXACT_BITS // self.width if exact else 4
        biased = np.zeros((-(-self.n // self.fields) * self.fields, self.dim), np.int64 if exact else object)
        biased[: self.n] = rows + self.row_bias
        words = np.zeros((len(biased) // self.fields, self.dim), biased.dtype)
        for field in range(self.fields):
            words += biased[field :: self.fields] * (1 << (field * self.width))
        self.words = words.astype(self.kind).T
        self.share = self.anchor_bias * rows.sum(axis=1) + self.dim * self.row_bias * self.anchor_bias

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """The inner product of each anchor with each candidate, as 64-bit integers."""
        anchors = anchors if self.kind is not object else anchors.astype(object)
        products = (anchors + self.anchor_bias).astype(self.kind) @ self.words
        if self.kind is not object:
            products = products.astype(np.int64)
        out = np.empty((len(anchors), products.shape[1] * self.fields), products.dtype)
        for field in range(self.fields):
            out[:, field :: self.fields] = (products >> (field * self.width)) & ((1 << self.width) - 1)
        out = out[:, : self.n] - self.share - self.row_bias * anchors.sum(axis=1)[:, None]
        if out.dtype == object and out.size and max(abs(int(out.max())), abs(int(out.min()))) >= 1 << 63:
            raise OverflowError("a score does not fit 64 bits")
        return out.astype(np.int64)


def whole(vectors: pa.ListArray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of each component of equally long vectors, as 64-bit integers or, beyond those, Python's."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.size and np.abs(flat).max() * scale >= 1 << 31:
        ratios = (x.as_integer_ratio() for x in flat.tolist())
        numbers = np.array([above * scale // below for above, below in ratios], object)
    else:
        numbers = np.floor(flat * scale).astype(np.int64)
    return numbers.reshape(len(vectors), -1) if numbers.size else np.zeros((len(vectors), 0), np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest allowed scores, best first, equal ones in the order of their places."""
    places = np.flatnonzero(allowed)
    own = scores[places]
    if len(own) > k:
        near = own >= np.partition(own, len(own) - k)[len(own) - k]
        places, own = places[near], own[near]
    return places[np.lexsort((places, -own))[:k]]


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _met(rows: pa.Table, anchors: pa.Table, scale: int) -> tuple[Iterator[np.ndarray], np.ndarray, np.ndarray]:
    """Each anchor's scores with the rows in the order of their ids, and that order's ids and labels."""
    rows = rows.sort_by([("vec_id", "ascending"), ("label", "ascending")])
    ids, labels = _columns(rows, "vec_id", "label")
    own = whole(anchors.column("embedding").combine_chunks(), scale)
    low, high = (int(own.min()), int(own.max())) if own.size else (0, 0)
    packed = Packed(whole(rows.column("embedding").combine_chunks(), scale), low, high)
    step = max(1, AT_ONCE // len(ids))
    return (s for at in range(0, len(own), step) for s in packed.scores(own[at : at + step])), ids, labels


_SCORED = "anchor_id bigint, vec_id bigint, score bigint"
_HARD = "anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
_ARROW = {"bigint": pa.int64(), "int": pa.int32()}


def _table(columns: list, schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    filled = zip(*columns) if columns else [[] for _ in fields]
    return pa.table([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(filled, fields)], names=[name for name, _ in fields])


def finite(vector: str) -> Column:
    """Not null, and no component is null or not finite."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
    easiest: int = EASIEST,
    hardest: int = HARDEST,
) -> DataFrame:
    """``rows`` (vec_id, label, embedding): the hard negatives of each anchor's ``positives`` best rows of its label.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor and positive the first
    ``negatives`` rows of another label whose score lies between ``easiest`` and ``hardest`` hundredths of the positive's.
    """
    used = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").alias("embedding"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    used = used.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding"))
    used = used.withColumn("dim", F.size("embedding"))
    anchors = used.where("asks").groupBy("vec_id").agg(F.min(F.struct("label", "dim", "embedding")).alias("own"))
    anchors = stored(anchors.select(F.col("vec_id").alias("anchor_id"), "own.*"), "anchors")
    n, longest = used.agg(F.count(F.lit(1)), F.max("dim")).first()
    asking = anchors.count()
    vector_bytes = 8 * max(1, longest or 1)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(least, -(-n * vector_bytes // ROW_BYTES))
    anchor_blocks = max(1, -(-asking * vector_bytes // ANCHOR_BYTES))

    def every(name: str, blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)

    def block(key: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")

    keys = ["dim", "row_block", "anchor_block"]
    left = used.select("dim", block("vec_id", row_blocks).alias("row_block"), "vec_id", "label", "embedding", every("anchor_block", anchor_blocks))

    def meet(asked: DataFrame, function, schema: str) -> DataFrame:
        right = asked.select("*", block("anchor_id", anchor_blocks).alias("anchor_block"), every("row_block", row_blocks))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(function, schema)

    def near(table: pa.Table, asked: pa.Table) -> pa.Table:
        if not table.num_rows or not asked.num_rows:
            return _table([], _SCORED)
        scores, ids, labels = _met(table, asked, scale)
        out = []
        for own, anchor, label in zip(scores, *_columns(asked, "anchor_id", "label")):
            chosen = best(own, (labels == label) & (ids != anchor), positives)
            out += [(anchor, ids[at], own[at]) for at in chosen]
        return _table(out, _SCORED)

    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = meet(anchors, near, _SCORED).withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    lists = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives"))
    asked = stored(anchors.join(lists, "anchor_id"), "positives")

    def hard(table: pa.Table, asked: pa.Table) -> pa.Table:
        if not table.num_rows or not asked.num_rows:
            return _table([], _HARD)
        scores, ids, labels = _met(table, asked, scale)
        out = []
        lists = asked.column("positives").to_pylist()
        for own, anchor, label, wanted in zip(scores, *_columns(asked, "anchor_id", "label"), lists):
            other = (labels != label) & (ids != anchor)
            for p in wanted:
                low, high = -(-easiest * p["score"] // 100), hardest * p["score"] // 100
                if low <= high:
                    found = best(own, other & (own >= low) & (own <= high), negatives)
                    out += [(anchor, p["place"], p["vec_id"], p["score"], ids[at], own[at]) for at in found]
        return _table(out, _HARD)

    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = meet(asked, hard, _HARD).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
