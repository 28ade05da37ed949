"""Words of many texts at once: numpy over Arrow buffers, no loop over rows.

Words are runs of bytes outside a separator class. All separators used here are ASCII, which never
occurs inside a multi-byte UTF-8 character, so bytes and characters give the same words.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


WHITE = separators((0x09, 0x0D), (0x20, 0x20))
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Words:
    """The words of an Arrow text column (null: no words).

    ``ids`` numbers each word by ``vocabulary`` (list of bytes); the words of text ``i`` are
    ``ids[first[i]:first[i + 1]]``, and the same slice of the Arrow array ``words``. With ``breaks``, some of the separators
    also end a piece of the text: ``pieces`` numbers the piece of each word over all texts.
    """

    def __init__(
        self, texts: pa.Array | pa.ChunkedArray, separator: np.ndarray = WHITE, lower: bool = False, breaks: np.ndarray | None = None
    ):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]] if len(texts) else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0] if len(texts) else np.zeros(1, np.int64)
        if lower:
            data = np.frombuffer(data.tobytes().translate(LOWER.tobytes()), np.uint8)
        inside = np.frombuffer(data.tobytes().translate((~separator).tobytes()), bool)
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        starts_here = inside.copy()
        starts_here[1:] &= ~inside[:-1] | edge[1:-1]
        starts = np.flatnonzero(starts_here)
        self.n_texts = len(texts)
        self.first = np.searchsorted(starts, bounds)
        ends_here = inside.copy()
        ends_here[:-1] &= ~inside[1:] | edge[1:-1]
        offsets = np.append(0, np.cumsum(np.flatnonzero(ends_here) + 1 - starts))
        kept = data[inside]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        self.words = words
        coded = words.dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
        self.dictionary = coded.dictionary
        self.counts = np.diff(self.first)
        if breaks is not None:
            ends = np.frombuffer(data.tobytes().translate(breaks.tobytes()), bool)
            # Both terms never fall, so the sum is the same for two words only if both terms are.
            self.pieces = np.cumsum(ends)[starts] + self.owners()

    @cached_property
    def vocabulary(self) -> list[bytes]:
        return self.dictionary.to_pylist()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, in order: a polynomial in the word's bytes, from sums over the whole dictionary."""
        if not len(self.ids):
            return np.zeros(0, _U)
        _, bounds, data = self.dictionary.buffers()
        bounds = np.frombuffer(bounds, np.int64)[: len(self.dictionary) + 1]
        up, down = _powers(int(bounds[-1]))
        sums = np.zeros(bounds[-1] + 1, _U)
        np.cumsum((np.frombuffer(data, np.uint8)[: bounds[-1]].astype(_U) + _U(1)) * up[: bounds[-1]], out=sums[1:])
        table = (sums[bounds[1:]] - sums[bounds[:-1]]) * down[bounds[:-1]]
        return mixed(table ^ (np.diff(bounds).astype(_U) << _U(56)))[self.ids]

    def owners(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(self.n_texts), self.counts)

    def window_starts(self, length: int) -> np.ndarray:
        """Positions (over all words) at which ``length`` words of one text begin."""
        ends = np.repeat(self.first[1:], self.counts)
        return np.flatnonzero(np.arange(len(self.ids)) + length <= ends)


_BASE = 0x9E3779B97F4A7C15 | 2  # odd, and twice odd when lowered by one
_TABLES = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n + 1`` powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_TABLES[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _TABLES[i] = np.cumprod(steps)
    return _TABLES[0], _TABLES[1]


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 2 << 20):
    """Slices of a batch whose texts in ``column`` make about ``limit`` bytes each; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    low, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and held + size > limit:
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += size
    if low < batch.num_rows:
        yield batch.slice(low)


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finishing steps (fixed values of that generator)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def window_hashes(hashes: np.ndarray, starts: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``length`` words from each start; it depends on their order."""
    state = np.full(len(starts), (seed * 0x9E3779B97F4A7C15 + length) & (2**64 - 1), _U)
    # Starts without a gap need no look-up.
    dense = len(starts) > 0 and starts[-1] - starts[0] == len(starts) - 1
    for step in range(length):
        state ^= hashes[starts[0] + step : starts[0] + step + len(starts)] if dense else hashes[starts + step]
        state *= _U(0x9FB21C651E98DF25)
        state ^= state >> _U(29)
    return mixed(state)
