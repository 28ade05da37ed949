"""Language identification by interpolated Kneser-Ney character models.

Counting is a Spark aggregation over all training texts: each task counts the five-symbol strings
of its rows per language, one shuffle adds the counts up. A symbol is a lower-cased letter; every
run of other characters is one blank, so digits, markup and punctuation say nothing about the
language. A string is a 60-bit key (12 bits a symbol; letters from U+0C00 on are hashed to 1024
symbols), which makes contexts and suffixes shifts and masks.

Counts of orders below five are continuation counts, so they follow from the five-symbol strings, by
groupings in Spark; discounts come from all strings, too. No string is left out and no count is
clipped, so the model grows with the texts. It is never gathered in one place: strings are cut into
shards by the two symbols before their last one, which all strings and contexts of two symbols and
more that a look-up needs have in common. What is shorter (pairs of symbols and single symbols, at most
4096 squared of them) goes to every shard. Shards are sorted arrays with one log-probability column
per language.

Documents are spread over parts, in compressed bundles. A part asks each shard for the distinct strings of its texts, gets
their log-probabilities back, and adds them up over every position of the whole texts. A text has the
language with the lowest cross-entropy per symbol.

Rejection is calibrated on a tenth of the training texts, which the models do not see: a text is
rejected if its cross-entropy lies further above its language's mean than the ``QUANTILE`` of these
texts do, in units that allow for short texts, times ``SLACK``, and also by ``MARGIN`` nats a symbol; so is a
text without a letter. Texts whose label differs from their prediction calibrate nothing.

Defined cases: text null, empty or without a letter gives ``und`` with score 0, rejected; rows that
repeat a document are scored one by one; a null id counts as neither held out nor training row; without training
rows every text is ``und``, and only one without a letter is rejected. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.stored import parts_for, stored
from lakeshelf.llm.words import by_bytes

ORDER, BITS = 5, 12
MASK = (1 << BITS) - 1
#: Bytes of text in a part, and numbers (strings by languages) that a shard or its answers should hold. They set the
#: sizes of tasks only.
PART, CELLS = 16 << 20, 4_000_000
#: Languages from which on parts get smaller, since each string's answer gets longer.
WIDE = 16
QUANTILE, SLACK, MARGIN = 0.9995, 1.5, 1.25
#: Bytes of text that are worked on at once; several numbers per character are held for them.
SLICE = 1 << 20
#: Rows that are bundled at once.
BUNDLED = 10_000
#: Symbols from which on a longer text makes the decision no surer, for the score only.
SURE = 40

_SYMBOLS: list[np.ndarray] = []


def symbols() -> np.ndarray:
    """Code point to symbol: 0 for what is no letter."""
    if not _SYMBOLS:
        table = np.zeros(0x110000, np.uint16)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                c2 = ord(low) if len(low) == 1 else c
                table[c] = c2 if c2 < 0xC00 else 0xC00 + (c2 * 0x9E3779B1 >> 7) % 0x400
        _SYMBOLS.append(table)
    return _SYMBOLS[0]


def keys_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The five-symbol string that ends at each symbol of each text, and the first position of each text (and the end).

    Before a text stand blanks; a text without a letter has no positions.
    """
    texts = texts.fill_null("")
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    stream = symbols()[points]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    letter = stream > 0
    first = np.ones(len(stream), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~first[1:]
    stream, owner = stream[keep].astype(np.int64), owner[keep]
    counts = np.bincount(owner, minlength=len(sizes))
    bounds = np.append(0, np.cumsum(counts))
    place = np.arange(len(stream)) - np.repeat(bounds[:-1], counts)
    keys = stream.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(stream)
        before[back:] = stream[:-back] if back < len(stream) else stream[:0]
        before[place < back] = 0
        keys |= before << (BITS * back)
    return keys, bounds


def _added(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts added up."""
    if counts is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return keys[starts], np.diff(np.append(starts, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def count_strings(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``train`` (lang, text)."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def gathered(value: str) -> tuple[np.ndarray, np.ndarray]:
            return _added(*(np.concatenate(x) for x in zip(*seen.pop(value))))

        for batch in batches:
            for part in by_bytes(batch, 1, SLICE):
                lang, text = part.columns
                for value in pc.unique(lang).to_pylist():
                    found = seen.setdefault(value, [])
                    found.append(_added(keys_of(text.filter(pc.equal(lang, value)))[0]))
                    if sum(len(k) for k, _ in found) > 2_000_000:
                        keys, n = gathered(value)
                        if len(keys) > 1_000_000:  # hand on what has gathered; the aggregation adds it up
                            yield _counts(value, keys, n)
                        else:
                            seen[value] = [(keys, n)]
        for value in list(seen):
            yield _counts(value, *gathered(value))

    counted = train.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counts(lang: str, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"])


@dataclass(frozen=True)
class Counts:
    """What is learned: the strings (lang, gram, n), shorter ones (level, lang, gram, n), discounts by order and language."""

    languages: list[str]
    strings: DataFrame
    short: DataFrame
    discounts: np.ndarray
    alphabet: int
    n_strings: int


def _suffix(order: int) -> int:
    return (1 << (BITS * order)) - 1


def _discount(ones: float, twos: float) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def continuations(longer: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): in how many strings of the next order each string of ``order`` symbols is the end."""
    gram = F.col("gram").bitwiseAND(F.lit(_suffix(order))).alias("gram")
    return longer.groupBy("lang", gram).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Model:
    """Per order (1 to 5) sorted keys with log-probabilities by language, and sorted contexts with back-off weights."""

    languages: list[str]
    keys: list[np.ndarray]
    probabilities: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    unknown: np.ndarray

    def position_scores(self, grams: np.ndarray) -> np.ndarray:
        """Log-probability of each string's last symbol after the symbols before it, by language."""
        out = np.empty((len(grams), len(self.languages)), np.float32)
        rest, carried = np.arange(len(grams)), None
        for order in range(ORDER, 0, -1):
            key = grams[rest] & ((1 << (BITS * order)) - 1)
            at, hit = _found(self.keys[order - 1], key)
            value = self.probabilities[order - 1][at[hit]]
            out[rest[hit]] = value if carried is None else value + carried[hit]
            rest, key = rest[~hit], key[~hit]
            carried = np.zeros((len(rest), len(self.languages)), np.float32) if carried is None else carried[~hit]
            if not len(rest):
                return out
            at, hit = _found(self.contexts[order - 1], key >> BITS)
            carried[hit] += self.weights[order - 1][at[hit]]
        out[rest] = carried + self.unknown
        return out


def cross_entropies(texts: pa.Array, position_scores: Callable[[np.ndarray], np.ndarray], n_languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols per text, and nats per symbol by language."""
    grams, bounds = keys_of(texts)
    n = np.diff(bounds)
    total = np.zeros((len(n), n_languages))
    step = 1 << 18  # bounds the memory of one look-up, whatever the length of a text
    for low in range(0, len(grams), step):
        part = position_scores(grams[low : low + step])
        inside = np.clip(bounds, low, low + len(part))
        owners = np.repeat(np.arange(len(n)), np.diff(inside))
        for j in range(n_languages):
            total[:, j] -= np.bincount(owners, part[:, j], len(n))
    return n, total / np.maximum(n, 1)[:, None]


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


def build_model(
    strings: dict[str, tuple[np.ndarray, np.ndarray]],
    short: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]] | None = None,
    discounts: np.ndarray | None = None,
    alphabet: int | None = None,
) -> Model:
    """Interpolated Kneser-Ney over the strings of each language (sorted keys, counts); one absolute discount per order and language.

    With ``short`` (orders one and two of all strings), ``discounts`` and ``alphabet`` given, ``strings`` may be those of a shard.
    """
    languages = list(strings)
    grams: list[dict[str, tuple[np.ndarray, np.ndarray]]] = [{} for _ in range(ORDER)]
    for lang, (keys, n) in strings.items():
        grams[ORDER - 1][lang] = keys, n
        for order in range(ORDER - 1, 0, -1):
            suffix, kinds = _added(grams[order][lang][0] & _suffix(order))
            grams[order - 1][lang] = short[order][lang] if short and order in short else (suffix, kinds.astype(np.float64))
    if alphabet is None:
        alphabet = max(2, len(np.unique(np.concatenate([grams[0][lang][0] for lang in languages]))) + 1)
    unknown = np.full(len(languages), 1.0 / alphabet)
    all_keys, logs, all_contexts, log_w, last = [], [], [], [], None
    for order in range(1, ORDER + 1):
        here = grams[order - 1]
        keys = np.unique(np.concatenate([here[lang][0] for lang in languages]))
        contexts = np.unique(keys >> BITS)
        p, w = np.zeros((len(keys), len(languages))), np.ones((len(contexts), len(languages)))
        for j, lang in enumerate(languages):
            own, n = here[lang]
            discount = _discount((n == 1).sum(), (n == 2).sum()) if discounts is None else discounts[order - 1, j]
            context, of = np.unique(own >> BITS, return_inverse=True)
            total = np.bincount(of, n)
            at = np.searchsorted(contexts, context)
            w[at, j] = discount * np.bincount(of) / total
            p[np.searchsorted(keys, own), j] = np.maximum(n - discount, 0) / total[of]
        context = np.searchsorted(contexts, keys >> BITS)
        if order > 1:
            at, hit = _found(all_keys[-1], keys & _suffix(order - 1))  # the suffix of every string is there, since counts come from it
        # A language at a time, and doubles of two orders only: a worker holds no further copies of all numbers.
        for j in range(len(languages)):
            p[:, j] += w[context, j] * (last[at, j] if order > 1 else unknown[j])
        last = p
        all_keys.append(keys), logs.append(_logs(p)), all_contexts.append(contexts), log_w.append(_logs(w))
    return Model(languages, all_keys, logs, all_contexts, log_w, np.log(unknown).astype(np.float32))


def _logs(numbers: np.ndarray) -> np.ndarray:
    """As float32, without a whole copy as doubles."""
    out = np.empty(numbers.shape, np.float32)
    for j in range(numbers.shape[1]):
        out[:, j] = np.log(numbers[:, j])
    return out


def _by_language(table: pa.Table, languages: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and counts of each language."""
    lang, keys, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
    order = np.lexsort((keys, lang))
    lang, keys, n = lang[order], keys[order], n[order].astype(np.float64)
    bounds = np.searchsorted(lang, np.arange(len(languages) + 1))
    return {name: (keys[low:high], n[low:high]) for name, low, high in zip(languages, bounds[:-1], bounds[1:])}


def _shard(grams, shards: int):
    """Shard by the two symbols before the last one; works on columns and on arrays alike (no product passes 2 ** 56)."""
    if isinstance(grams, np.ndarray):
        return ((grams >> BITS & _suffix(2)) * 0x9E3779B1 >> 16) % shards
    pair = F.shiftright(grams, BITS).bitwiseAND(F.lit(_suffix(2)))
    return F.shiftright(pair * F.lit(0x9E3779B1), 16) % F.lit(shards).cast("bigint")


def _checksum(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(_checksum(doc_id) % 3 == 1, F.lit(False))


def use(doc_id: str, lang: str):
    """What a row trains: "fit" the counts, "calibrate" the rejection, or null, nothing."""
    learns = (_checksum(doc_id) % 3 != 1) & F.col(lang).isNotNull()
    return F.when(learns & (F.floor(_checksum(doc_id) / 3) % 10 == 0), "calibrate").when(learns, "fit")


def train(rows: DataFrame) -> Counts | None:
    """What ``rows`` (lang, text) teach; rows without language or text are left out."""
    strings = stored(count_strings(rows.where("lang IS NOT NULL AND text IS NOT NULL")), "strings")
    levels = {ORDER: strings}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = continuations(levels[order + 1], order)

    def levelled(orders) -> DataFrame:
        named = [levels[order].select(F.lit(order).alias("level"), "lang", "gram", "n") for order in orders]
        return reduce(DataFrame.unionByName, named)

    short = stored(levelled((2, 1)), "short")
    every = levelled(range(ORDER, 2, -1)).unionByName(short)
    # Five rows per language.
    known = every.groupBy("level", "lang").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count(F.lit(1))).collect()
    if not known:
        return None
    languages = sorted({lang for _, lang, *_ in known})
    discounts = np.zeros((ORDER, len(languages)))
    place = {lang: j for j, lang in enumerate(languages)}
    for level, lang, ones, twos, _ in known:
        discounts[level - 1, place[lang]] = _discount(ones, twos)
    alphabet = max(2, short.where("level = 1").select("gram").distinct().count() + 1)
    n_strings = sum(kinds for level, *_, kinds in known if level == ORDER)
    return Counts(languages, strings, short, discounts, alphabet, n_strings)


def _judged(others: list, labels: list[str], n: np.ndarray, entropies: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Rows of the result from symbols per text and nats per symbol by language."""
    und = pa.array([*labels, "und"], pa.string())
    best, lowest, sure = np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
    some = (n > 0) & bool(labels)
    if labels:
        best = np.argmin(entropies, axis=1)
        lowest = entropies[np.arange(len(best)), best]
        sure = 1 / np.exp((lowest[:, None] - entropies) * np.minimum(n, SURE)[:, None]).sum(axis=1)
    columns = [und.take(pa.array(np.where(some, best, len(labels)))), pa.array(np.where(some, sure, 0.0)), pa.array(lowest, mask=~some)]
    return pa.RecordBatch.from_arrays([*others, *columns, pa.array(n.astype(np.int64))], names)


def score(docs: DataFrame, model: Counts | None, text: str = "text", spread: str | None = None) -> DataFrame:
    """``docs`` (any columns) with lang_pred, score, entropy (nats a symbol) and n_symbols.

    ``text`` names the text: a column, which the result lacks, or the field of a struct (``a.b``), which stays. ``spread`` names
    a column or field that tells rows apart (an id), so that copies of a text do not meet in one part; rows without it are spread
    by their text.
    """
    inside = text.partition(".")[2]
    rest = [c for c in docs.columns if inside or c != text]
    schema = docs.select(*(F.col(f"`{c}`") for c in rest)).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("entropy", "double"), ("n_symbols", "long")):
        schema = schema.add(name, kind)
    languages = model.languages if model else []
    shards = max(1, -(-model.n_strings * len(languages) // CELLS)) if model else 1
    n_parts = parts_for(docs, text, PART * WIDE // max(WIDE, len(languages)))
    # Neighbouring parts ask together, as many as give a task about as many numbers as a shard has.
    asking = max(1, 2 * CELLS * shards // (min(model.n_strings, 1 << 18) * len(languages))) if model else 1
    blocks = -(-n_parts // asking)
    by = F.xxhash64(F.col(spread), F.when(F.col(spread).isNull(), F.col(text))) if spread else F.xxhash64(F.col(text))
    first = text.partition(".")[0] if inside else text
    placed = docs.select(F.pmod(by, F.lit(n_parts)).alias("_part"), F.col(first), *(F.col(f"`{c}`") for c in rest if c != first))
    order = ["_part", first, *(c for c in rest if c != first)]
    taken = [order.index(c) for c in rest]

    def slices(batches) -> Iterator[tuple[pa.Array, pa.RecordBatch]]:
        """Texts and rows, about ``SLICE`` bytes of text at a time."""
        for whole in batches:
            texts = pc.struct_field(whole.column(1), inside) if inside else whole.column(1)
            both = pa.RecordBatch.from_arrays([texts, *whole.columns], [str(i) for i in range(whole.num_columns + 1)])
            for batch in by_bytes(both, 0, SLICE):
                yield batch.column(0), batch

    def result(batch: pa.RecordBatch, n: np.ndarray, entropies: np.ndarray) -> pa.RecordBatch:
        return _judged([batch.column(1 + i) for i in taken], languages, n, entropies, schema.names)

    if model is None:

        def reject(batches) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for texts, batch in slices([whole]):
                    n = np.diff(keys_of(texts)[1])
                    yield result(batch, n, np.zeros((len(n), 0)))

        return placed.mapInArrow(reject, schema)

    def bundle(batches) -> Iterator[pa.RecordBatch]:
        """The rows of a batch that go to one part, as one compressed value: texts shuffle at a fraction of their size."""
        how = pa.ipc.IpcWriteOptions(compression="zstd")
        for whole in together(batches):
            parts = whole.column(0).to_numpy(zero_copy_only=False)
            by_part = np.argsort(parts, kind="stable")
            numbers, starts = np.unique(parts[by_part], return_index=True)
            for part, at in zip(numbers.tolist(), np.split(by_part, starts[1:])):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, whole.schema, options=how) as writer:
                    writer.write_batch(whole.take(pa.array(at)))
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["_part", "rows"])

    def together(batches) -> Iterator[pa.RecordBatch]:
        """Batches of about ``BUNDLED`` rows, so that bundles do not shrink with Spark's batches."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BUNDLED:
                yield pa.concat_batches(held)
                held = []
        if held:
            yield pa.concat_batches(held)

    def rows_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for rows in table.column("rows"):
            yield from pa.ipc.open_stream(rows.as_buffer())

    def asked(table: pa.Table) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """The distinct strings of a part, and which of them each shard is asked for."""
        found = [np.unique(keys_of(texts)[0]) for texts, _ in slices(rows_of(table))]
        grams = np.unique(np.concatenate(found))
        shard = _shard(grams, shards)
        by_shard = np.argsort(shard, kind="stable")
        numbers, starts = np.unique(shard[by_shard], return_index=True)
        return grams, list(zip(numbers.tolist(), np.split(by_shard, starts[1:])))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams, wanted = asked(table)
        part = key[0].as_py()
        rows = [(shard, part // asking, part, grams[at].tobytes()) for shard, at in wanted]
        columns = list(zip(*rows)) or [()] * 4
        return pa.table([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], names=["shard", "block", "part", "grams"])

    discounts, alphabet = model.discounts, model.alphabet

    def answer(key: tuple, questions: pa.Table, counts: pa.Table) -> pa.Table:
        parts, found = [], []
        if questions.num_rows:
            levels = {level: _by_language(counts.filter(pc.equal(counts.column("level"), level)), languages) for level in (ORDER, 2, 1)}
            model = build_model(levels.pop(ORDER), levels, discounts, alphabet)
            step = max(1, CELLS // len(languages))
            for part, grams in zip(questions.column("part").to_pylist(), questions.column("grams").to_pylist()):
                grams = np.frombuffer(grams, np.int64)
                parts.append(part)
                found.append(b"".join(model.position_scores(grams[low : low + step]).tobytes() for low in range(0, len(grams), step)))
        shard = [key[0].as_py()] * len(parts)
        return pa.table([pa.array(parts, pa.int64()), pa.array(shard, pa.int64()), pa.array(found, pa.binary())], names=["part", "shard", "scores"])

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        grams, wanted = asked(table)
        held = dict(zip(answers.column("shard").to_pylist(), answers.column("scores").to_pylist()))
        scores = np.empty((len(grams), len(languages)), np.float32)
        for shard, at in wanted:
            scores[at] = np.frombuffer(held.pop(shard), np.float32).reshape(len(at), len(languages))
        out = []
        for texts, batch in slices(rows_of(table)):
            n, entropies = cross_entropies(texts, lambda keys: scores[np.searchsorted(grams, keys)], len(languages))
            out.append(result(batch, n, entropies))
        return pa.Table.from_batches(out)

    tasks = F.lit(blocks - 1).cast("bigint")
    number = F.create_map(*(x for lang, j in zip(languages, range(len(languages))) for x in (F.lit(lang), F.lit(j))))[F.col("lang")]
    all_blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), tasks)).alias("block")
    counted = ("level", number.alias("lang"), "gram", "n")
    long = model.strings.withColumn("level", F.lit(ORDER)).select(_shard(F.col("gram"), shards).alias("shard"), all_blocks, *counted)
    all_shards = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard")
    low = model.short.select(all_shards, *counted).select("shard", all_blocks, "level", "lang", "gram", "n")
    bundles = placed.mapInArrow(bundle, "_part bigint, rows binary")
    questions = bundles.groupBy("_part").applyInArrow(ask, "shard bigint, block bigint, part bigint, grams binary")
    answers = questions.groupBy("shard", "block").cogroup(long.unionByName(low).groupBy("shard", "block"))
    answers = answers.applyInArrow(answer, "part bigint, shard bigint, scores binary")
    return bundles.groupBy("_part").cogroup(answers.groupBy("part")).applyInArrow(finish, schema)


def with_rejection(scored: DataFrame) -> DataFrame:
    """``scored`` (a stored table) with ``rejected``.

    Thresholds per language come from its rows with ``use`` "calibrate" and, if it has ``lang``, a prediction that agrees with it.
    """
    known = scored.where("use = 'calibrate' AND n_symbols > 0")
    known = known.where("lang = lang_pred") if "lang" in scored.columns else known
    means = known.groupBy("lang_pred").agg(F.avg("entropy").alias("_mean"))
    above = F.col("entropy") - F.col("_mean")
    scaled = above * F.sqrt(F.least("n_symbols", F.lit(400)))
    # One row per language.
    limits = known.join(F.broadcast(means), "lang_pred").groupBy("lang_pred").agg(
        F.first("_mean").alias("_mean"), F.percentile_approx(scaled, QUANTILE, 10_000).alias("_limit")
    )
    out = scored.join(F.broadcast(limits), "lang_pred", "left")
    far = (above > MARGIN) & (scaled > SLACK * F.greatest("_limit", F.lit(1.0)))
    return out.withColumn("rejected", (F.col("n_symbols") == 0) | F.coalesce(far, F.lit(False))).drop("_mean", "_limit")
