"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to); a flow then routes
each pattern's words to the quotas of its sources. A pattern offers its words once per allowed
repetition, and every further repetition costs more, so repeats are spread evenly over patterns
before any is repeated twice. The amount routed from a pattern is taken from its documents in the
order of a seeded hash: whole rounds first, then the documents up to the remainder.

Only one row per pattern reaches the driver. The cut within a pattern is found by two histograms
of the hash (4096 buckets each) and one ordering inside a single bucket of the second, so no task
sees all documents of a source, however large it is.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own,
last in order; rows that repeat a document are mixed one by one; an empty table gives an empty
result. Columns other than those named are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WEIGHTS = (5, 2, 1)
REPEATS = 3
BITS = 12
#: Patterns are held by the driver and broadcast; a mix with more is refused, not cut.
MAX_PATTERNS = 100_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets_by_weight(sizes: Sequence[int], weights: Sequence[int], repeats: int = REPEATS) -> list[float]:
    """Shares of ``sum(sizes)`` by weight; none above ``repeats`` times its size, the excess reshared by weight."""
    free, left = set(range(len(sizes))), sum(sizes)
    out = [0.0] * len(sizes)
    while free:
        weight = sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * left > repeats * sizes[i] * weight}
        if not full:
            for i in free:
                out[i] = float(weights[i] * left) / weight
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
        left -= sum(repeats * sizes[i] for i in full)
        free -= full
    return out


def route(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], repeats: int = REPEATS) -> list[int]:
    """Min-cost flow from patterns to quotas: the words to take from each pattern.

    Copy ``c`` of a pattern's words costs ``c * (c - 1) / 2`` a word, which is convex. Shortest
    augmenting paths are searched from all patterns with a copy left to any quota that is open;
    potentials keep reduced costs from falling below zero.
    """
    n, m = len(capacity), len(quota)
    flow: dict[tuple[int, int], int] = {(p, s): 0 for p in range(n) for s in members[p]}
    of_source: list[list[int]] = [[] for _ in range(m)]
    for p, s in flow:
        of_source[s].append(p)
    taken, open_quota = [0] * n, list(quota)

    def next_copy(p: int) -> tuple[int, int] | None:
        """Cost of the next word of a pattern, and how many words cost that."""
        copy = taken[p] // capacity[p] if capacity[p] else repeats
        return None if copy >= repeats else (copy * (copy + 1) // 2, (copy + 1) * capacity[p] - taken[p])

    # Arcs between patterns and sources are free, so a path costs what its first pattern costs:
    # the cheapest pattern that reaches an open quota at all is the shortest path's start.
    queue = [(next_copy(p)[0], p) for p in range(n) if next_copy(p)]
    heapq.heapify(queue)
    while queue:
        cost, p = heapq.heappop(queue)
        copy = next_copy(p)
        if copy is None:
            continue
        if copy[0] != cost:
            heapq.heappush(queue, (copy[0], p))
            continue
        back: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None}
        line, end = [("p", p)], None
        for node in line:
            kind, i = node
            if kind == "p":
                steps = [("s", s) for s in members[i]]
            elif open_quota[i] > 0:
                end = node
                break
            else:
                steps = [("p", q) for q in of_source[i] if flow[q, i] > 0]
            for step in steps:
                if step not in back:
                    back[step] = node
                    line.append(step)
        if end is None:
            continue  # no open quota can be reached from here, now or later
        path, node = [], end
        while node is not None:
            path.append(node)
            node = back[node]
        path.reverse()
        room = min(copy[1], open_quota[end[1]])
        for a, b in zip(path, path[1:]):
            if a[0] == "s":
                room = min(room, flow[b[1], a[1]])
        for a, b in zip(path, path[1:]):
            if a[0] == "p":
                flow[a[1], b[1]] += room
            else:
                flow[b[1], a[1]] -= room
        taken[p] += room
        open_quota[end[1]] -= room
        if next_copy(p):
            heapq.heappush(queue, (next_copy(p)[0], p))
    return taken


def seeded(doc_id: str, seed: int) -> Column:
    """A document's place in the seeded order: 60 bits of an MD5, the same in any engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def mix(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = 0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``sized`` (doc_id, size, sources) mixed: doc_id, size, sources, copies and the ``keep`` columns, per row.

    ``sources`` is the array of a document's sources; they are weighted in code point order, null
    last, ``weights`` repeating. ``sized`` is read four times, so pass a stored table. Words of an
    overlapping document count to each of its sources when targets are set.
    """
    spark = sized.sparkSession
    rows = sized.select(
        *(c for c in keep if c not in ("doc_id", "size", "sources")),
        "doc_id", "size", "sources", F.array_sort(F.array_distinct("sources")).alias("_pattern"), seeded("doc_id", seed).alias("_at"),
    )
    patterns = rows.where("_pattern IS NOT NULL").groupBy("_pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; name the sources more coarsely")
    names = sorted({s for r in patterns for s in r["_pattern"]}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for r in patterns:
        for s in r["_pattern"]:
            sizes[number[s]] += r["size"]
    targets = targets_by_weight(sizes, [weights[i % len(weights)] for i in range(len(names))], repeats)
    taken = route([r["size"] for r in patterns], [[number[s] for s in r["_pattern"]] for r in patterns], [round(t) for t in targets], repeats)
    plan = spark.createDataFrame(
        [
            (r["_pattern"], i, t // r["size"] if r["size"] else 0, t % r["size"] if r["size"] else 0,
             [sizes[number[s]] for s in r["_pattern"]], [targets[number[s]] for s in r["_pattern"]])
            for i, (r, t) in enumerate(zip(patterns, taken))
        ],
        "_pattern array<string>, _p int, _rounds bigint, _rest bigint, source_sizes array<bigint>, targets array<double>",
    )
    # At most MAX_PATTERNS rows each.
    rows = rows.join(F.broadcast(plan), F.col("sources").isNotNull() & rows["_pattern"].eqNullSafe(plan["_pattern"]), "left").drop("_pattern")
    rows = rows.withColumn("_first", F.shiftright("_at", 60 - BITS).cast("int")).withColumn(
        "_second", F.shiftright("_at", 60 - 2 * BITS).cast("int")
    )
    first = _cut(rows, "_first", F.lit(0).cast("bigint"), "_cut1", "_base1")
    rows = rows.join(F.broadcast(first), "_p", "left")
    second = _cut(rows.where("_first = _cut1"), "_second", F.first("_base1"), "_cut2", "_base2")
    rows = rows.join(F.broadcast(second), "_p", "left")
    # Rows of the bucket that holds the cut are put in order; there is one such bucket in 2 ** 24 per pattern.
    at_cut = (F.col("_first") == F.col("_cut1")) & (F.col("_second") == F.col("_cut2"))
    before = Window.partitionBy("_p").orderBy("_at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(at_cut).withColumn("_before", F.col("_base2") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    inner = rows.where(~F.coalesce(at_cut, F.lit(False))).withColumn("_before", F.lit(None).cast("bigint"))
    below = F.col("_cut1").isNull() | (F.col("_first") < F.col("_cut1")) | (
        (F.col("_first") == F.col("_cut1")) & (F.col("_second") < F.col("_cut2"))
    )
    # The document over the cut is taken if that comes nearer to the amount asked for.
    chosen = F.when(F.col("_before").isNull(), below).otherwise(2 * F.col("_before") + F.col("size") <= 2 * F.col("_rest"))
    copies = F.coalesce(F.col("_rounds"), F.lit(0)) + (chosen & (F.coalesce("_rest", F.lit(0)) > 0)).cast("bigint")
    return edge.unionByName(inner).select(
        *(c for c in keep if c not in ("doc_id", "size", "sources")),
        "doc_id", "size", "sources", F.least(copies, F.lit(repeats)).alias("copies"), "source_sizes", "targets",
    )


def _cut(rows: DataFrame, bucket: str, base: Column, name: str, base_name: str) -> DataFrame:
    """Per pattern the bucket in which the running size passes the remainder, and the size before it."""
    sums = rows.where("_rest > 0").groupBy("_p", bucket).agg(
        F.sum("size").alias("_size"), F.first("_rest").alias("_rest"), base.alias("_start")
    )
    before = Window.partitionBy("_p").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_sum", F.col("_start") + F.coalesce(F.sum("_size").over(before), F.lit(0)))
    holds = (F.col("_sum") <= F.col("_rest")) & (F.col("_rest") < F.col("_sum") + F.col("_size"))
    return sums.where(holds).select("_p", F.col(bucket).alias(name), F.col("_sum").alias(base_name))
