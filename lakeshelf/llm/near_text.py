"""Near-duplicate documents by a MinHash LSH forest.

A document is the set of its distinct five-word shingles. Documents with equal sets are one node.
A node's signature has 128 minima; each of 32 orders starts with its own four of them and goes on
with the next ones. Nodes are sorted along every order (a range partitioning over the whole key, so
that even a crowded region is spread over tasks). Neighbours in an order that share at least the
first four values are candidates, up to ``NEAR`` on either side; where more share them, only the nearest one is, which has the
longest common prefix, so that the depth adapts to the region.

A pair at similarity 0.75 stays unseen in all orders with a chance of 5e-6. Candidates are
confirmed on full sets: first each node's most frequent partners; then of the other candidates
all those that are not yet in one component. What joins no two components cannot change the result.
Then nodes whose region was crowded are compared by all their minima with many more neighbours, as far
as these are in other components; the likeliest pairs of two components are confirmed, and again with
the new components as long as that finds links. What is still in different components of one crowded area
is compared in full: sets that reach 0.75 share one of their rarest shingles (a prefix filter), so the pairs that
do are all confirmed, however far apart they are in the orders.

Defined cases: null texts and texts without words have an empty set and are linked with nothing;
texts of fewer than five words are one shingle; a row with a null id is linked with nothing, kept, and has no
component; rows that repeat an id are versions of one document, each with the component of its own
text; an empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshelf.llm.components import components
from lakeshelf.llm.stored import stored
from lakeshelf.llm.words import Words, by_bytes, mixed, window_hashes

SHINGLE, PERCENT = 5, 75
ORDERS, PREFIX, DEPTH = 32, 4, 12
NEAR = 6
#: Partners per node that are confirmed first.
FIRST = 2
#: In crowded regions: nodes before a node that are compared by their minima, equal minima of 128 that
#: call for a full comparison (0.6, four standard deviations below 0.75), and pairs of two components per order and batch.
REACH, LIKELY, MOST = 256, 77, 8
#: Sets with one shingle that a task compares with as many others, and pairs from which on a sample of them is confirmed first.
BLOCK, MANY = 512, 200_000
_U = np.uint64
_MULTIPLIERS = np.random.default_rng(20240229).integers(0, 2**63, (2, ORDERS * PREFIX), dtype=np.uint64) * _U(2) + _U(1)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted per text, and the first one of each text (and the end)."""
    words = Words(texts, lower=True)
    hashes, owners = words.hashes(), words.owners()
    starts = words.window_starts(SHINGLE)
    found, of = [window_hashes(hashes, starts, SHINGLE)], [owners[starts]]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == n)
        found.append(window_hashes(hashes, words.first[short], n))
        of.append(short)
    values, owner = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(words.n_texts + 1))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, signature) per row; the last two are null for an empty set or a null id."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 1):
                values, first = shingles(batch.column(1))
                sizes = np.diff(first)
                some = np.flatnonzero((sizes > 0) & np.asarray(batch.column(0).is_valid()))
                parts = np.empty((len(some), ORDERS * PREFIX), np.uint16)
                if len(some):
                    bounds = np.stack([first[some], first[some + 1]], 1).ravel()
                    padded = np.append(values, _U(0))  # lets the last bound be the end
                    for i, (a, b) in enumerate(_MULTIPLIERS.T):
                        parts[:, i] = mixed(np.minimum.reduceat(padded * a + b, bounds)[::2]) >> _U(48)
                digests: list[bytes | None] = [None] * batch.num_rows
                marks: list[bytes | None] = [None] * batch.num_rows
                for row, i in enumerate(some.tolist()):
                    digests[i] = hashlib.blake2b(values[first[i] : first[i + 1]].tobytes(), digest_size=16).digest()
                    # Highest byte first, so that sorting bytes sorts the values.
                    marks[i] = parts[row].astype(">u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes.astype(np.int64)), pa.array(digests, pa.binary()), pa.array(marks, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "signature"],
                )

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def _sorted_orders(sets: DataFrame, depth: int, *more: str) -> DataFrame:
    """Each node once per order, sorted along the orders (by ``depth`` values) over all partitions."""
    twice = F.concat("signature", "signature")
    tree = sets.select("node", *more, "signature", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"))
    key = F.substring(twice, F.col("tree") * (2 * PREFIX) + 1, F.lit(2 * depth))
    rows = tree.select(F.col("tree").cast("int").alias("tree"), key.alias("key"), "node", *more)
    return rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")


def _prefix_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logical_and.accumulate(a == b, axis=1).sum(axis=1)


def neighbours(sets: DataFrame) -> DataFrame:
    """(a, b, depth, crowded): candidate pairs of nodes, a < b, once per order that finds them.

    ``crowded`` tells that a node has more than ``NEAR`` others before it that share the first values; it is paired with the nearest
    of them only, and left to ``foreign_neighbours`` otherwise.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy()
            key = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, DEPTH)
            node = batch.column(2).to_numpy()
            new = len(tree)
            if held is not None:
                tree, key, node = (np.concatenate(x) for x in zip(held, (tree, key, node)))
            old = len(tree) - new
            out = []
            many = np.zeros(len(tree), bool)
            for back in range(NEAR + 1, 0, -1):
                at = np.arange(max(old, back), len(tree))
                depth = np.where(tree[at] == tree[at - back], _prefix_length(key[at], key[at - back]), 0)
                at, depth = at[depth >= PREFIX], depth[depth >= PREFIX]
                if back > NEAR:
                    many[at] = True
                    head = at[~many[at - 1]]  # ties the nodes that begin a region to it
                    for step in range(1, NEAR + 2):
                        out.append((node[head], node[head - step], _prefix_length(key[head], key[head - step]), many[head]))
                    continue
                own = ~many[at] | ((back == 1) & many[at - 1])  # of a crowded region only the nearest one
                at, depth = at[own], depth[own]
                out.append((node[at], node[at - back], depth, many[at]))
            a, b, depth, crowded = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(depth.astype(np.int32)), pa.array(crowded)],
                ["a", "b", "depth", "crowded"],
            )
            held = tree[-NEAR - 1 :], key[-NEAR - 1 :], node[-NEAR - 1 :]

    return _sorted_orders(sets, DEPTH).mapInArrow(read, "a bigint, b bigint, depth int, crowded boolean").where("a < b")


def foreign_neighbours(sets: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes of different ``component`` that look similar by all their minima.

    In each order a node is compared with the ``REACH`` nodes before it that share the first
    values. Of two components the ``MOST`` most similar pairs that a batch of nodes holds are
    returned.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, node, component = (batch.column(i).to_numpy() for i in (0, 2, 3))
            key = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").astype(np.uint16).reshape(-1, ORDERS * PREFIX)
            new = len(tree)
            if held is not None:
                tree, key, node, component = (np.concatenate(x) for x in zip(held, (tree, key, node, component)))
            old = len(tree) - new
            fresh = np.ones(len(tree), bool)
            fresh[1:] = (tree[1:] != tree[:-1]) | (key[1:, :PREFIX] != key[:-1, :PREFIX]).any(axis=1)
            region = np.cumsum(fresh)
            found = []
            for back in range(1, min(REACH, len(tree) - 1) + 1):
                at = np.arange(max(old, back), len(tree))
                at = at[(region[at] == region[at - back]) & (component[at] != component[at - back])]
                if len(at):
                    same = (key[at] == key[at - back]).sum(axis=1)
                    likely = same >= LIKELY
                    found.append((at[likely], at[likely] - back, same[likely]))
            i, j, same = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
            ends = np.sort(np.stack([component[i], component[j]]), axis=0)
            order = np.lexsort((-same, ends[1], ends[0], region[i]))
            i, j, ends, where = i[order], j[order], ends[:, order], region[i[order]]
            change = np.ones(len(i), bool)
            change[1:] = (where[1:] != where[:-1]) | (ends[:, 1:] != ends[:, :-1]).any(axis=0)
            starts = np.flatnonzero(change)
            sizes = np.diff(np.append(starts, len(i)))
            rank = np.arange(len(i)) - np.repeat(starts, sizes)
            i, j = i[rank < MOST], j[rank < MOST]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], ["a", "b"])
            held = tree[-REACH:], key[-REACH:], node[-REACH:], component[-REACH:]

    return _sorted_orders(sets, ORDERS * PREFIX, "component").mapInArrow(read, "a bigint, b bigint").distinct()


def _splittable(groups: DataFrame, key: str, *sums) -> DataFrame:
    """Aggregates per ``key``, shuffled once more for a join with a hot key, which Spark can then split."""
    return groups.groupBy(key, F.xxhash64(key).alias("_hash")).agg(*sums).drop("_hash")


def mixed_areas(crowded: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component) of the nodes in crowded areas that hold several components.

    ``crowded`` has the pairs (a, b) that tie an area; where it holds several components, each of them is an end of a pair of two.
    """
    pairs = stored(_by_component(crowded, found), "areas")
    mixed = pairs.where("ca != cb").select(F.explode(F.array("ca", "cb")).alias("component")).distinct()
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("ca").alias("component")), F.struct(F.col("b").alias("node"), F.col("cb").alias("component"))))
    nodes = pairs.select(ends.alias("_end")).select("_end.*").distinct()
    return nodes.join(mixed, "component").select("node", "component")


def sharing_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): all pairs of ``nodes`` (node, component) of different components that can be similar enough.

    Of a set with n shingles any similar one has 3n/4 or more. Ordered by frequency, the shingles that
    occur in one component only left out, two similar sets share one of the first ones of both; and
    behind the first that they share there are enough others. Frequent shingles are cut into blocks.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 2, 1 << 20):
                values, first = shingles(batch.column(2))
                digests = [hashlib.blake2b(values[i:j].tobytes(), digest_size=16).digest() for i, j in zip(first, first[1:])]
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(digests, pa.binary()), lists], ["node", "component", "digest", "shingles"])

    rows = texts.withColumnRenamed("doc_id", "node").join(nodes.hint("merge"), "node").select("node", "component", "text")
    sets = rows.mapInArrow(read, "node bigint, component bigint, digest binary, shingles array<bigint>")
    sets = stored(sets.dropDuplicates(["node", "digest"]), "shingles")
    size = F.size("shingles").cast("bigint").alias("n")
    rows = sets.select("node", "component", F.xxhash64("node", "digest").alias("set"), size, F.explode("shingles").alias("shingle"))
    ends = F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("often")
    kinds = _splittable(rows, "shingle", *ends).where("_low != _high").select("shingle", "often")
    own = Window.partitionBy("set")
    rows = rows.join(kinds.hint("merge"), "shingle")
    rows = rows.withColumn("place", F.row_number().over(own.orderBy("often", "shingle"))).withColumn("rest", F.count(F.lit(1)).over(own) - F.col("place"))
    rows = stored(rows.where("rest + 1 >= (3 * n + 3) div 4").drop("often", "place"), "prefixes")
    kinds = _splittable(rows, "shingle", *ends).where("_low != _high")
    blocks = kinds.select("shingle", F.ceil(F.col("often") / BLOCK).alias("_blocks"))
    rows = rows.join(blocks.hint("merge"), "shingle").withColumn("_block", F.pmod(F.xxhash64("set"), "_blocks"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)))
    a, b = (
        rows.select("shingle", F.col(i).alias("_i"), F.col(j).alias("_j"), F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("component", "n", "rest")))
        for c, i, j in (("a", "_block", "_other"), ("b", "_other", "_block"))
    )
    near = a.hint("merge").join(b, ["shingle", "_i", "_j"]).where("a < b AND component_a != component_b AND 7 * (1 + least(rest_a, rest_b)) >= 3 * (n_a + n_b)")
    return near.select("a", "b").distinct()


def _joined_in_full(found: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``found`` after all of ``pairs`` (a, b) that still join two components are confirmed; of very many a sample goes first."""
    for part in (64, 8, 1):
        pairs = stored(_by_component(pairs, found).where("ca != cb").select("a", "b"), "far")
        n = pairs.count()
        if not n:
            break
        some = F.pmod(F.xxhash64("a", "b"), F.lit(part if n > MANY else 1)) == 0
        new = stored(confirmed(pairs.where(some), texts), "links")
        if not new.isEmpty():
            found = _merged(found, new)
        if n <= MANY:
            break
        pairs = pairs.where(~some)
    return found


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 2, 1 << 20):
                sides = [shingles(batch.column(i)) for i in (2, 3)]
                sizes = [np.diff(first) for _, first in sides]
                owner = np.concatenate([np.repeat(np.arange(batch.num_rows), n) for n in sizes])
                values = np.concatenate([v for v, _ in sides])
                order = np.lexsort((values, owner))
                owner, values = owner[order], values[order]
                both = np.bincount(owner[1:][(owner[1:] == owner[:-1]) & (values[1:] == values[:-1])], minlength=batch.num_rows)
                linked = 100 * both >= percent * (sizes[0] + sizes[1] - both)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(linked)) for i in (0, 1)], ["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    # Always by shuffles: the same plan, and the same growth, at every size.
    rows = pairs.select("a", "b").hint("merge").join(left, "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(read, "a bigint, b bigint")


def _by_component(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``pairs`` with the components of their ends in ``found`` (id, component); a node that is not there is its own."""
    a, b = (found.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    rows = pairs.join(a, "a", "left").join(b, "b", "left")
    return rows.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` after adding links between its components: only these few are contracted again."""
    joined = components(_by_component(links, found).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    new = joined.select(F.col("id").alias("component"), F.col("component").alias("_root"))
    old = found.join(new, "component", "left").select("id", F.coalesce("_root", "component").alias("component"))
    alone = joined.join(found, "id", "left_anti").select("id", "component")
    return stored(old.unionByName(alone), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable by links; one row per component has kept (of rows that repeat that id, all).
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = stored(signatures(docs), "signatures")
    sets = marked.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    sets = stored(sets, "sets")
    seen = neighbours(sets).groupBy("a", "b").agg(F.count(F.lit(1)).alias("orders"), F.max("depth").alias("depth"), F.max("crowded").alias("crowded"))
    pairs = stored(seen, "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = stored(docs.join(nodes.hint("merge"), "doc_id", "left_semi"), "texts")
    best = Window.partitionBy("at").orderBy(F.desc("orders"), F.desc("depth"), "a", "b")
    ranked = pairs.select("*", F.explode(F.array("a", "b")).alias("at")).withColumn("place", F.row_number().over(best))
    first = stored(ranked.where(F.col("place") <= FIRST).select("a", "b").distinct(), "first")
    found = stored(components(stored(confirmed(first, texts), "links")), "components")
    others = _by_component(pairs.join(first, ["a", "b"], "left_anti"), found).where("ca != cb").select("a", "b")
    others = stored(others, "others")
    tried = first.unionByName(others)
    new = stored(confirmed(others, texts), "links")
    if not new.isEmpty():
        found = _merged(found, new)
    crowded = stored(pairs.where("crowded").select(F.explode(F.array("a", "b")).alias("node")).distinct(), "crowded")
    while not crowded.isEmpty():
        rest = sets.join(crowded, "node").join(found.withColumnRenamed("id", "node"), "node", "left")
        rest = rest.select("node", "signature", F.coalesce("component", "node").alias("component"))
        fresh = stored(foreign_neighbours(rest).join(tried, ["a", "b"], "left_anti"), "fresh")
        new = stored(confirmed(fresh, texts), "links")
        tried = tried.unionByName(fresh)
        if new.isEmpty():
            break
        found = _merged(found, new)
    if not crowded.isEmpty():
        areas = stored(mixed_areas(pairs.where("crowded").select("a", "b"), found), "areas")
        if not areas.isEmpty():
            far = sharing_pairs(areas, texts).join(tried, ["a", "b"], "left_anti")
            found = _joined_in_full(found, far, texts)
    classes = sets.join(found.withColumnRenamed("id", "node"), "node", "left")
    classes = stored(classes.select("digest", F.coalesce("component", "node").alias("_class")), "classes")
    # Copies of one set may be a third of the rows: an outer join of two shuffled inputs can be split.
    out = marked.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.coalesce("_class", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
