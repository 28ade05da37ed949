"""Approximate search by largest inner product, with low-dimensional stable projections.

Vectors get one more component that makes all of them equally long (the greatest length, which one
aggregation finds), queries a zero: the largest inner product is then the smallest distance. Eight
Gaussian projections of these vectors are indexed by a kd-tree per block of rows. A query takes the
leaves in the order of their projected distance, in rounds of growing length, and verifies their vectors by exact inner products.
A vector at distance d has a projected distance whose square is d * d times a chi-square variable of
eight degrees, so the search ends at projected distance r when a vector as near as the k-th best one so far
would have been met before r with probability ``SURE``.

Every row is indexed; queries are a stated set and go to all blocks, in blocks of their own. A
task holds one block of rows and one of queries, returns the best k per query, and a ranking
that cuts to k before its shuffle merges blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with
a null id take no part; a query meets only vectors of its length, and not the rows of its own id; equal
scores rank by id; rows that repeat a query's id are one query, by the smallest of their vectors;
rows that repeat another id may fill several ranks; without queries or candidates the result is empty. Columns other than those
named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshelf.llm.near_vectors import matrix, usable
from lakeshelf.llm.stored import stored

PROJECTIONS, SURE, LEAF = 8, 0.99, 64
ROWS, QUERIES = 16_384, 1_024
#: Leaves of the first round of a search; each round is twice as long as the one before, and some more.
FIRST = 4
NEIGHBOURS = 20


def chi_square(x: np.ndarray, degrees: int = PROJECTIONS) -> np.ndarray:
    """Distribution function for an even number of degrees."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """The leaves of a kd-tree as row numbers: cut at the median of the widest axis."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            done.append(np.sort(rows))
            continue
        own = points[rows]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        split = np.argpartition(own[:, axis], len(rows) // 2)
        todo += [rows[split[: len(rows) // 2]], rows[split[len(rows) // 2 :]]]
    return done


def _verify(vectors, ids, members, queries, own, who, margins, best, best_ids) -> None:
    """Put the ``members`` that are among the best of the queries ``who`` into ``best`` and ``best_ids``."""
    # A matrix product finds what can be among the best; its rounding differs from the sums' below by far less than the margin.
    near = queries[who] @ vectors[members].T >= (best[who, -1] - margins[who])[:, None]
    near &= own[who, None] != ids[members]
    better = near.any(axis=1)
    who, near = who[better], near[better]
    if not len(who):
        return
    # Sums in one fixed order, so that equal vectors have equal scores.
    at, of = np.nonzero(near)
    scores = np.full(near.shape, -np.inf)
    scores[at, of] = np.einsum("nd,nd->n", queries[who[at]], vectors[members[of]], optimize=False)
    k = best.shape[1]
    all_scores = np.hstack([best[who], scores])
    all_ids = np.hstack([best_ids[who], np.broadcast_to(ids[members], scores.shape)])
    rank = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
    best[who] = np.take_along_axis(all_scores, rank, axis=1)
    best_ids[who] = np.take_along_axis(all_ids, rank, axis=1)


def search_block(
    vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, longest: float, sure: float = SURE
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and inner products of each query's best k among ``vectors``, best first; unused places have score -inf.

    ``own`` is the id that a query must not meet.
    """
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    dim = vectors.shape[1]
    directions = np.random.default_rng([11, dim]).standard_normal((dim + 1, PROJECTIONS))
    rest = np.sqrt(np.maximum(longest**2 - (vectors * vectors).sum(axis=1), 0))
    points = np.hstack([vectors, rest[:, None]]) @ directions
    asked = queries @ directions[:dim]
    groups = leaves(points)
    low = np.stack([points[g].min(axis=0) for g in groups])
    high = np.stack([points[g].max(axis=0) for g in groups])
    bound = np.zeros((len(queries), len(groups)))
    for axis in range(PROJECTIONS):
        gap = np.maximum(low[:, axis] - asked[:, axis, None], asked[:, axis, None] - high[:, axis])
        bound += np.maximum(gap, 0) ** 2
    way = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, way, axis=1)
    lengths = (queries * queries).sum(axis=1)
    margins = 1e-12 * np.sqrt(lengths) * longest
    best = np.full((len(queries), k), -np.inf)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    active = np.arange(len(queries))
    # In rounds of doubling length, so that the queries that turn to one leaf in a round are compared with it together.
    low, high = 0, FIRST
    while low < len(groups) and len(active):
        kth = best[active, -1]
        squared = np.maximum(lengths[active] + longest**2 - 2 * kth, 1e-300)[:, None]  # infinite while fewer than k are known
        with np.errstate(invalid="ignore"):
            goes_on = ~(chi_square(bound[active, low:high] / squared) >= sure)
        place, nth = np.nonzero(goes_on)
        who, at = active[place], way[active[place], low + nth]
        active = active[goes_on[:, 0]]
        turn = np.argsort(at, kind="stable")
        who, at = who[turn], at[turn]
        cuts = np.flatnonzero(np.diff(at)) + 1
        for some, leaf in zip(np.split(who, cuts), at[np.append(0, cuts)] if len(at) else []):
            _verify(vectors, ids, groups[leaf], queries, own, some, margins, best, best_ids)
        low, high = high, 2 * high + FIRST
    return best_ids, best


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, sure: float = SURE) -> DataFrame:
    """``vectors`` (vec_id, embedding): query_id, rank, vec_id, score for each row for which ``is_query`` holds."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = stored(rows.where(usable("embedding") & F.col("vec_id").isNotNull()).withColumn("dim", F.size("embedding")), "vectors")
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    n, asking, longest = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.sqrt(F.max(squares))).first()
    row_blocks, query_blocks = max(1, -(-n // ROWS)), max(1, -(-asking // QUERIES))
    queries = rows.where("asks").groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))

    def placed(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.select("dim", block, "vec_id", "embedding", every)

    left = placed(rows, "row_block", row_blocks, "query_block", query_blocks)
    right = placed(queries, "query_block", query_blocks, "row_block", row_blocks)
    keys = ["dim", "row_block", "query_block"]

    def find(table: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        types = [pa.int64(), pa.int64(), pa.float64()]
        if not table.num_rows or not asked.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        x, q = (matrix(t.column("embedding").combine_chunks()) for t in (table, asked))
        own = asked.column("vec_id").to_numpy()
        ids, scores = search_block(x, table.column("vec_id").to_numpy(), q, own, k, longest, sure)
        used = scores > -np.inf
        columns = np.repeat(own, used.sum(axis=1)), ids[used], scores[used]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
