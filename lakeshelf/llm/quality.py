"""Quality scores by a generalised additive model with pairwise interactions.

A document's features are counts and shares over its whole text, made by one pass over Arrow
batches. Training takes a sample of at most ``SAMPLE`` labelled rows, the lowest of a seeded hash,
to the driver: shallow regression trees are boosted in turn over one feature after the other (then
over the pairs that explain most of what is left), and each tree is added to its feature's lookup
table. Scoring is a sum of table entries by bin, so it needs no tree.

Only texts are inputs: labels are targets, ids only choose and join training rows.

Defined cases: null and empty texts have the features of an empty text and get a score; a label
that is null or not 0 or 1 trains nothing; without training rows, or with one class only, every
score is the smoothed share of 1; rows that repeat a document are scored one by one; a null id is
neither held out nor a training row.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeshelf.llm.words import WHITE, Words, by_bytes

#: Labelled rows used for fitting.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 60, 40, 0.15
THRESHOLD = 0.3

FEATURES = (
    "log_words", "log_bytes", "mean_word", "spread_word", "longest_word", "distinct_words", "top_word", "adjacent_repeats",
    "distinct_pairs", "upper", "digits", "symbols", "stops", "other_bytes", "symbol_ends", "log_lines", "distinct_lines",
    "mean_line", "stopped_lines", "bars",
)


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | _class("abcdefghijklmnopqrstuvwxyz")
DIGIT = _class("0123456789")
STOP = _class(".,;:!?'\"()-")
BAR = _class("|<>{}[]=\\/")
OTHER = np.arange(256) >= 128
SYMBOL = ~(LETTER | DIGIT | STOP | OTHER | WHITE)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Distinct values per owner."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    return np.bincount(o[new], minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    size = np.diff(bounds)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(table[data], dtype=np.int64))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    words = Words(texts)
    owner, total = words.owners(), words.counts
    lengths = np.fromiter(map(len, words.vocabulary), np.int64, len(words.vocabulary))
    symbol_end = np.fromiter((SYMBOL[w[-1]] or w[-1] == 0x21 for w in words.vocabulary), bool, len(words.vocabulary))
    length = lengths[words.ids] if len(words.ids) else np.zeros(0, np.int64)
    mean = _share(np.bincount(owner, length, n), total)
    square = _share(np.bincount(owner, length.astype(float) ** 2, n), total)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    ids = words.ids.astype(np.int64)
    order = np.lexsort((ids, owner))
    o, v = owner[order], ids[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    starts = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, o[starts], np.diff(np.append(starts, len(o))))
    same = owner[1:] == owner[:-1]
    pair_owner, pairs = owner[1:][same], (ids[:-1] << 32 | ids[1:])[same]
    lines = Words(texts, _class("\n"))
    line_size = np.fromiter(map(len, lines.vocabulary), np.int64, len(lines.vocabulary))
    stopped = np.fromiter((x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines.vocabulary), bool, len(lines.vocabulary))
    line_owner, line_ids = lines.owners(), lines.ids.astype(np.int64)
    letters = count(LETTER)
    columns = (
        np.log1p(total), np.log1p(size), mean, np.sqrt(np.maximum(square - mean**2, 0)), np.log1p(longest),
        _share(np.bincount(o[new], minlength=n), total), _share(top, total),
        _share(np.bincount(pair_owner, (pairs >> 32) == (pairs & 0xFFFFFFFF), n), total - 1),
        _share(_distinct(pair_owner, pairs, n), total - 1),
        _share(count(UPPER), letters), _share(count(DIGIT), size), _share(count(SYMBOL), size), _share(count(STOP), size),
        _share(count(OTHER), size), _share(np.bincount(owner, symbol_end[words.ids] if len(ids) else None, n), total),
        np.log1p(lines.counts), _share(_distinct(line_owner, line_ids, n), lines.counts),
        _share(np.bincount(line_owner, line_size[line_ids] if len(line_ids) else None, n), lines.counts),
        _share(np.bincount(line_owner, stopped[line_ids] if len(line_ids) else None, n), lines.counts),
        _share(count(BAR), size),
    )
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` (text and any other columns) with one double column per feature in place of the text."""
    rest = docs.drop("text")

    def read(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 0):
                table = features(batch.column(0))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], *(pa.array(np.ascontiguousarray(c)) for c in table.T)], [*batch.schema.names[1:], *FEATURES]
                )

    schema = StructType([*rest.schema.fields, *(StructField(f, DoubleType()) for f in FEATURES)])
    return docs.select("text", *(f"`{c}`" for c in rest.columns)).mapInArrow(read, schema)


@dataclass
class Additive:
    """``base`` plus a table entry per feature bin and per pair of coarse bins."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for i, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, i], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf_values(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """A regression tree over ordered bins as one value per bin (gradient and curvature sums in)."""
    value = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1)
        gain[(left_h < 2) | (h.sum() - left_h < 2)] = -1
        at = int(np.argmax(gain)) + 1
        if gain[at - 1] > g.sum() ** 2 / (h.sum() + 1):
            value[:at] = _leaf_values(g[:at], h[:at], depth - 1)
            value[at:] = _leaf_values(g[at:], h[at:], depth - 1)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best tree that cuts one axis and then the other on each side, as a table; and its gain."""
    best, gain_of = np.zeros_like(g), 0.0
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for at in range(1, len(gg)):
            out = np.empty_like(gg)
            gain = -(g.sum() ** 2) / (h.sum() + 1)
            for rows in (slice(0, at), slice(at, None)):
                a, b = gg[rows].sum(0), hh[rows].sum(0)
                out[rows] = _leaf_values(a, b, 1)
                values, weight = out[rows][0], b
                for v in np.unique(values):
                    part = values == v
                    gain += a[part].sum() ** 2 / (weight[part].sum() + 1)
            if gain > gain_of:
                best, gain_of = (out if axis == 0 else out.T).copy(), gain
    return best, gain_of


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting of the log-odds of ``y`` (0 or 1)."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    width = len(FEATURES)
    if not len(y) or y.min() == y.max():
        return Additive(base, [np.zeros(0)] * width, [np.zeros(1)] * width, [np.zeros(0)] * width, [], [])
    edges = [_edges(x[:, i], BINS) for i in range(width)]
    bins = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i in range(width):
            g, h = gradients()
            step = RATE * _leaf_values(*(np.bincount(bins[i], s, len(tables[i])) for s in (g, h)), 2)
            tables[i] += step
            total += step[bins[i]]
    coarse = [_edges(x[:, i], PAIR_BINS) for i in range(width)]
    low = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(coarse)]

    def grid(a, b, s):
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(low[a] * shape[1] + low[b], s, shape[0] * shape[1]).reshape(shape)

    g, h = gradients()
    gains = {(a, b): _quadrants(grid(a, b, g), grid(a, b, h))[1] for a in range(width) for b in range(a + 1, width)}
    pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(pairs, pair_tables):
            g, h = gradients()
            step = RATE * _quadrants(grid(a, b, g), grid(a, b, h))[0]
            table += step
            total += step[low[a], low[b]]
    return Additive(base, edges, tables, coarse, pairs, pair_tables)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def is_training(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def train(featured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """The model of at most ``sample`` rows of ``featured`` (doc_id, features) joined with ``labels`` (doc_id, quality)."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("double").alias("_y"))
    rows = featured.where(is_training()).join(known, "doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "_y", *FEATURES).limit(sample)
    table = rows.select("_y", *FEATURES).toArrow()
    x = np.stack([table.column(f).to_numpy() for f in FEATURES], axis=1) if table.num_rows else np.zeros((0, len(FEATURES)))
    return fit(x, table.column("_y").to_numpy())


def score(featured: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """``featured`` with ``score`` and ``predicted`` in place of the features."""
    rest = featured.drop(*FEATURES)
    shared = featured.sparkSession.sparkContext.broadcast(model)  # a few tables of at most BINS entries

    def predict(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy() for i in range(len(FEATURES))], axis=1)
            p = shared.value(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[len(FEATURES) :], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                [*batch.schema.names[len(FEATURES) :], "score", "predicted"],
            )

    schema = StructType(list(rest.schema.fields)).add("score", "double").add("predicted", "integer")
    return featured.select(*FEATURES, *(f"`{c}`" for c in rest.columns)).mapInArrow(predict, schema)
