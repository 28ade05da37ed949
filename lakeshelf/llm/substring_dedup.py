"""Removal of repeated word windows, found by level-wise doubling.

Windows of seven words come first. Only windows that repeat at that length are extended to twice
that length, cut off at the thirteen words asked for, and no other window is looked at again. Two
equal long windows share the short window with the smallest hash among those inside them, so the
first level needs only these: a quarter of all positions.

Documents are spread over parts by a hash of their id, each small enough for one task. Per level a
part sends its distinct hashes, packed, to buckets chosen by hash; a bucket sees each hash at most
once per part, however often a passage occurs, and answers with one bit per hash: "repeats" at the
first level, "also starts in a document with a smaller id" at the last. The parts work out the
same hashes in the same order again, so the bits need no keys. Nothing but packed hashes, bits and
one shuffle of the texts is moved.

Long windows are told apart by 96 bits of hash.

Defined cases: a null or empty text has no words; a text shorter than the window keeps all words;
rows that repeat a document id are the same document (none is smaller than the other); a null id is neither smaller nor
larger than any, so such a row keeps all words; an empty table gives an empty result. Columns other
than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.stored import parts_for
from lakeshelf.llm.words import Words, window_hashes

WINDOW = 13
_U = np.uint64

_ANSWERS = "part bigint, bucket bigint, level int, bits binary"


def _bits(values: np.ndarray) -> bytes:
    return np.packbits(values).tobytes()


def _unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse; pairs are sorted by column, which is much faster than as records."""
    if keys.dtype.names is None:
        return np.unique(keys, return_inverse=True)
    order = np.lexsort((keys["b"], keys["a"]))
    a, b = keys["a"][order], keys["b"][order]
    new = np.ones(len(keys), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return keys[order[new]], of


class Level:
    """The distinct keys of one part at one level, sorted by bucket and key."""

    def __init__(self, keys: np.ndarray, buckets: int):
        """``keys``: structured or plain array of the keys of all candidate windows."""
        self.distinct, self.of = _unique(keys)
        plain = self.distinct if self.distinct.dtype.names is None else self.distinct["a"]
        bucket = (plain % _U(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.buckets, starts = np.unique(bucket[self.order], return_index=True)
        self.bounds = np.append(starts, len(self.order))

    def slices(self):
        for bucket, low, high in zip(self.buckets.tolist(), self.bounds[:-1], self.bounds[1:]):
            yield bucket, self.order[low:high]

    def answered(self, bits: dict[int, bytes]) -> np.ndarray:
        """One truth value per distinct key from the buckets' answers."""
        out = np.zeros(len(self.distinct), bool)
        for bucket, at in self.slices():
            out[at] = _unbits(bits[bucket], len(at))
        return out


class Part:
    """The windows of one part's documents."""

    def __init__(self, table: pa.Table, window: int, buckets: int):
        ids = table.column("doc_id").combine_chunks()
        self.ids, self.known = ids, np.asarray(ids.is_valid())
        number = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        self.words = Words(table.column("text"))
        self.hashes = self.words.hashes()
        owner = self.words.owners()
        starts = self.words.window_starts(window)
        self.starts = starts[self.known[owner[starts]]] if len(starts) else starts
        self.docs = number[owner[self.starts]] if len(starts) else np.zeros(0, np.int64)
        self.window, self.n_buckets = window, buckets
        short = (window + 1) // 2
        n = len(self.hashes) - window + 1
        if n > 0:
            hashes = window_hashes(self.hashes, np.arange(len(self.hashes) - short + 1), short)
            least = hashes[:n]
            for step in range(1, window - short + 1):
                least = np.minimum(least, hashes[step : step + n])
            least = least[self.starts]
        else:
            least = np.zeros(0, _U)
        # Neighbouring windows mostly have the same smallest hash, so runs are sorted instead of windows.
        fresh = np.ones(len(least), bool)
        fresh[1:] = (least[1:] != least[:-1]) | (self.docs[1:] != self.docs[:-1])
        self.first = Level(least[fresh], buckets)
        self.run_docs = self.docs[fresh]
        self.first_of = self.first.of[np.cumsum(fresh) - 1] if len(least) else self.first.of

    def repeated_here(self) -> np.ndarray:
        """Per distinct short hash: does it occur in two documents of this part?"""
        low = np.full(len(self.first.distinct), np.iinfo(np.int64).max)
        high = np.full(len(self.first.distinct), np.iinfo(np.int64).min)
        np.minimum.at(low, self.first.of, self.run_docs)
        np.maximum.at(high, self.first.of, self.run_docs)
        return low < high

    def extend(self, bits: dict[int, bytes]) -> Level:
        """The long windows whose short window repeats."""
        self.candidates = np.flatnonzero(self.first.answered(bits)[self.first_of]) if len(self.first_of) else np.zeros(0, np.int64)
        starts = self.starts[self.candidates]
        keys = np.empty(len(starts), [("a", _U), ("b", np.uint32)])
        keys["a"] = window_hashes(self.hashes, starts, self.window, seed=1)
        keys["b"] = window_hashes(self.hashes, starts, self.window, seed=2) >> _U(32)
        level = Level(keys, self.n_buckets)
        self.lowest = np.full(len(level.distinct), np.iinfo(np.int64).max)
        np.minimum.at(self.lowest, level.of, self.docs[self.candidates])
        self.last = level
        return level

    def removed(self, bits: dict[int, bytes]) -> np.ndarray:
        """Per word: is it covered by a window that also starts in a smaller document?"""
        level = self.last
        elsewhere = level.answered(bits)
        hit = elsewhere[level.of] | (self.docs[self.candidates] > self.lowest[level.of]) if len(level.of) else np.zeros(0, bool)
        starts = self.starts[self.candidates][hit]
        depth = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + self.window, -1)
        return np.cumsum(depth)[:-1] > 0


def _answers(table: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {1: {}, 2: {}}
    for bucket, level, bits in zip(*(table.column(c).to_pylist() for c in ("bucket", "level", "bits"))):
        out[level][bucket] = bits
    return out


def _table(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def repeated_words(docs: DataFrame, window: int = WINDOW, parts: int | None = None, with_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 [, text of the kept words].

    ``kept_sha256`` is the digest of the kept words joined by one blank.
    """
    n = parts or parts_for(docs)
    # Rows without an id are spread by their text, so that they do not meet in one part.
    spread = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    placed = docs.select(F.pmod(spread, F.lit(n)).alias("part"), "doc_id", "text")

    def send_short(key: tuple, table: pa.Table) -> pa.Table:
        part = Part(table, window, n)
        here = part.repeated_here()
        rows = [(b, key[0].as_py(), part.first.distinct[at].tobytes(), _bits(here[at])) for b, at in part.first.slices()]
        return _table(rows, ("bucket", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("flags", pa.binary()))

    def judge_short(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, _U) for k in table.column("keys").to_pylist()]
        flags = [_unbits(f, len(k)) for f, k in zip(table.column("flags").to_pylist(), keys)]
        distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
        repeats = counts > 1
        repeats[np.searchsorted(distinct, np.concatenate([k[f] for k, f in zip(keys, flags)]))] = True
        rows = [(p, key[0].as_py(), 1, _bits(repeats[np.searchsorted(distinct, k)])) for p, k in zip(table.column("part").to_pylist(), keys)]
        return _table(rows, ("part", pa.int64()), ("bucket", pa.int64()), ("level", pa.int32()), ("bits", pa.binary()))

    def send_long(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            rows = []
        else:
            part = Part(table, window, n)
            level = part.extend(_answers(answers)[1])
            rows = [(b, key[0].as_py(), level.distinct[at].tobytes(), part.lowest[at].tobytes()) for b, at in level.slices()]
        return _table(rows, ("bucket", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("lowest", pa.binary()))

    def judge_long(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, [("a", _U), ("b", np.uint32)]) for k in table.column("keys").to_pylist()]
        lowest = [np.frombuffer(x, np.int64) for x in table.column("lowest").to_pylist()]
        distinct, of = _unique(np.concatenate(keys))
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        own = np.concatenate(lowest)
        np.minimum.at(least, of, own)
        smaller = np.split(least[of] < own, np.cumsum([len(k) for k in keys])[:-1])
        rows = [(p, key[0].as_py(), 2, _bits(s)) for p, s in zip(table.column("part").to_pylist(), smaller)]
        return _table(rows, ("part", pa.int64()), ("bucket", pa.int64()), ("level", pa.int32()), ("bits", pa.binary()))

    out = docs.select("doc_id").schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    out = out.add("text", "string") if with_text else out

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        bits = _answers(answers)
        part = Part(table, window, n)
        part.extend(bits[1])
        gone = part.removed(bits[2])
        words, first = part.words, part.words.first
        removed = np.append(0, np.cumsum(gone))
        bounds = first - removed[first]
        left = words.words.filter(pa.array(~gone)).cast(pa.binary())
        kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), left), b" ").to_pylist()
        digests = [hashlib.sha256(x).hexdigest() for x in kept]
        texts = [x.decode() for x in kept] if with_text else []
        n_removed = removed[first[1:]] - removed[first[:-1]]
        columns = [part.ids, pa.array(words.counts.astype(np.int64)), pa.array(n_removed.astype(np.int64)), pa.array(digests, pa.string())]
        return pa.table(columns + [pa.array(texts, pa.string())] * with_text, names=out.names)

    packed = "bucket bigint, part bigint, keys binary, "
    short = placed.groupBy("part").applyInArrow(send_short, packed + "flags binary")
    first_answers = short.groupBy("bucket").applyInArrow(judge_short, _ANSWERS)
    long = placed.groupBy("part").cogroup(first_answers.groupBy("part")).applyInArrow(send_long, packed + "lowest binary")
    last_answers = long.groupBy("bucket").applyInArrow(judge_long, _ANSWERS)
    answers = first_answers.unionByName(last_answers)
    return placed.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(finish, out)
