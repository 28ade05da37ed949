"""Bounded-space online packing of documents into sequences of fixed length.

Each partition is read once, as a stream. A document becomes token ids plus one closing id; whole
windows are cut off it, and the rest is placed best-fit into one of a fixed number of open windows.
When it fits in none and no further window may be opened, the fullest window is emitted; a gap of
more than ``max_gap`` ids is first filled by cutting the piece at hand. What is open at the end of
a partition is merged, without cutting, with the leftovers of a few neighbouring partitions.

Token ids never leave the task that made them (unless ``with_ids`` asks for them): the passes
exchange piece descriptions only. The first pass is written to the shared scratch folder, so the
merge and the result read it without tokenising again. ``docs`` must be a table, or another plan
that gives the same partitions whenever a task is repeated.

Defined cases: a null or empty text is its closing id alone; rows that repeat a document are packed
one by one; the strings of special tokens become their ids, as in the library's own default, unless ``special_as_text``
makes them ordinary text; an empty table gives an empty result.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from lakeshelf.llm.stored import stored

LENGTH, END, OPEN, MAX_GAP = 2048, 1, 64, 64
#: Partitions whose leftovers are merged by one task.
MERGED = 4

# Text with other characters goes to the slower tokenizer: splitting classes of newer characters may differ by Unicode version.
_COMMON = re.compile("[^\x00-ɏ‐-‧]").search


class Encoder:
    """Ids of a byte-level BPE file of the ``tokenizers`` library.

    The same vocabulary is also given to a faster byte-pair encoder for text of common characters that
    holds no string of a special token; both give the same ids, which the tests compare.
    """

    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, special_as_text: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = special_as_text
        # Byte-level files write each byte as one printable character: itself, or the next free one from 256 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        special = {t.content for t in self.exact.get_added_tokens_decoder().values()}
        self.special = () if special_as_text else tuple(special)
        ranks = {bytes(byte_of[c] for c in token): i for token, i in self.exact.get_vocab().items() if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=self.SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if (text.isascii() or not _COMMON(text)) and not any(x in text for x in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    key = path, special_as_text
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


class Windows:
    """At most ``limit`` open windows; closed ones are handed to ``emit`` in the order of closing."""

    def __init__(self, emit, length: int, limit: int | None, max_gap: int | None):
        self.emit, self.length, self.limit, self.max_gap = emit, length, limit, max_gap
        self.open: list[list] = []  # [ids held, pieces]

    def place(self, piece: tuple, size: int, cut=None) -> None:
        """``cut(piece, n)`` splits a piece after n ids; without it pieces stay whole."""
        while True:
            best = None
            for window in self.open:
                if window[0] + size <= self.length and (best is None or window[0] > best[0]):
                    best = window
            if best is None and self.limit is not None and len(self.open) >= self.limit:
                fullest = max(self.open, key=lambda w: w[0])
                gap = self.length - fullest[0]
                rest = None
                if cut and gap > self.max_gap:
                    head, rest = cut(piece, gap)
                    fullest[1].append(head)
                self.open.remove(fullest)
                self.emit(fullest[1])
                if rest is not None:
                    piece, size = rest, size - gap
                    continue
            if best is None:
                best = [0, []]
                self.open.append(best)
            best[0] += size
            best[1].append(piece)
            if best[0] == self.length:
                self.open.remove(best)
                self.emit(best[1])
            return


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def pack_schema(docs: DataFrame, with_ids: bool) -> StructType:
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    return StructType(fields + [StructField("ids", ArrayType(IntegerType()))] * with_ids)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end: int = END,
    open_windows: int = OPEN,
    max_gap: int = MAX_GAP,
    with_ids: bool = False,
    special_as_text: bool = False,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids].

    ``tokenizer`` is the path of a byte-level BPE file that exists on every machine.
    """
    result = pack_schema(docs, with_ids)
    first = StructType([*result.fields, StructField("is_open", BooleanType()), StructField("part", LongType())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        yield from _pack_stream(batches, part, tokenizer, length, end, open_windows, max_gap, with_ids, first, special_as_text)

    pieces = stored(docs.select("doc_id", "text").mapInArrow(read, first), "pieces")

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return _merge(key[0].as_py(), table, length, result)

    left = pieces.where("is_open").withColumn("part", F.floor(F.col("part") / MERGED).cast("bigint"))
    merged = left.drop("is_open").groupBy("part").applyInArrow(merge, result)
    return pieces.where("NOT is_open").select(*result.names).unionByName(merged)


def _pack_stream(batches, part, tokenizer, length, end, open_windows, max_gap, with_ids, schema, special_as_text):
    encode, rows, number = encoder(tokenizer, special_as_text), [], part << 32

    def emit(pieces: list, is_open: bool = False) -> None:
        nonlocal number
        offset = 0
        for doc_id, start, ids, total in pieces:
            row = (doc_id, start, len(ids), _crc(ids), total, number, offset)
            rows.append(row + ((ids.astype(np.int32),) if with_ids else ()) + (is_open, part))
            offset += len(ids)
        number += 1

    def cut(piece, n):
        doc_id, start, ids, total = piece
        return (doc_id, start, ids[:n], total), (doc_id, start + n, ids[n:], total)

    windows = Windows(emit, length, open_windows, max_gap)
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids = np.append(encode(text.as_py() or ""), np.uint32(end))
            doc_id, total = doc_id.as_py(), len(ids)
            whole = total - total % length
            for start in range(0, whole, length):
                emit([(doc_id, start, ids[start : start + length], total)])
            if whole < total:
                windows.place((doc_id, whole, ids[whole:].copy(), total), total - whole, cut)
            if len(rows) >= 4096:
                yield _batch(rows, schema)
                rows.clear()
    for _, pieces in windows.open:
        emit(pieces, True)
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def _merge(group: int, table: pa.Table, length: int, schema: StructType) -> pa.Table:
    """Leftover pieces of a few partitions, largest first, each where it fits best."""
    columns = {n: table.column(n).to_pylist() for n in schema.names}
    done: list[list[int]] = []
    windows = Windows(done.append, length, None, None)
    order = sorted(range(table.num_rows), key=lambda i: (-columns["length"][i], columns["sequence_id"][i], columns["offset"][i]))
    for i in order:
        windows.place(i, columns["length"][i])
    done += [pieces for _, pieces in windows.open]
    rows = []
    for n, pieces in enumerate(done):
        offset = 0
        for i in pieces:
            columns["sequence_id"][i], columns["offset"][i] = (1 << 62) | (group << 32) | n, offset
            offset += columns["length"][i]
            rows.append(tuple(columns[c][i] for c in schema.names))
    return pa.Table.from_batches([_batch(rows, schema)])
