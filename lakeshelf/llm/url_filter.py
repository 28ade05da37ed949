r"""URL filter: rules first, else naive Bayes over the words of host and path, which a unigram model cuts out of joined names.

A url has a host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and a path (then up to ``?``, ``#`` or the end).

* Rules. A rule holds for its host and all subdomains, where the path begins with the rule's; the longest rule wins. Each host is joined
  with rules by its own name and all shorter names at its dots, so a list of any length costs one join.
* Words. Names are the runs of letters in host and path (A-Z lower-cased; longer ones are cut after ``LONGEST_NAME`` letters).
  A name such as ``cheappills`` is split by Viterbi's search for its likeliest words. The unigram model has the words of a corpus, all
  of them: every part of a distinct name meets the table of counts in a join, so the model grows with the corpus and is never
  shipped whole. A word that is not in it is possible too, at a probability that falls tenfold with each letter.
* Naive Bayes. Words of labelled urls are counted per class, each as often as it occurs in the url, and the logarithms of their smoothed ratios
  become whole numbers of millionths, so that sums do not depend on their order. A url is blocked if the sum over its words and
  the prior is above zero.

All costly work is done once per distinct name, host or (host, path).

Defined cases: a null url, or one without ``://``, has an empty host and path; no words leave the prior; a tie allows;
without labelled urls of both classes only rules block; repeated rows are judged alike and counted each in training; empty tables give
empty results or an empty model; of equally long rules the first by text wins. Columns other than those named are kept by
``judge`` under ``row`` and read nowhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.stored import stored
from lakeshelf.llm.words import Words, by_bytes, separators

LONGEST_WORD, LONGEST_NAME = 24, 256
SMOOTHING = 1.0
UNIT = 1_000_000
#: Not letters: all ASCII but A-Z and a-z.
NOT_LETTERS = separators((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path begins with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


BLOCK, ALLOW = "block", "allow"


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.col(url), r"^[\s\S]*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(_first(url, host), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(_first(url, F.regexp_extract(F.col(url), r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def _first(url: str, value: Column) -> Column:
    return F.when(F.col(url).contains("://"), value)


def names_of(*texts: str) -> Column:
    """The runs of letters of some columns, A-Z lower-cased, in pieces of at most ``LONGEST_NAME``."""
    joined = F.translate(F.concat_ws("/", *texts), _UPPER, _LOWER)
    return F.regexp_extract_all(joined, F.lit(rf"[^\x00-\x60\x7B-\x7F]{{1,{LONGEST_NAME}}}"), F.lit(0))


def ruled(pairs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``pairs`` (host, path, ...) with ``rule`` and ``rule_verdict``, null where none holds."""
    spark = pairs.sparkSession
    listed = spark.createDataFrame([(r.host, r.path, r.text, r.verdict) for r in rules], "name string, start string, rule string, verdict string")
    deepest = max((r.host.count(".") + 1 for r in rules), default=1)
    tails = F.array_distinct(F.array(*(F.substring_index("host", ".", -n) for n in range(1, deepest + 1))))
    hosts = pairs.select("host").distinct()
    fitting = hosts.select("host", F.explode(tails).alias("name")).join(listed, "name").groupBy("host")
    lists = fitting.agg(F.collect_list(F.struct((-F.length("rule")).alias("order"), "rule", "start", "verdict")).alias("rules"))
    held = F.filter("rules", lambda r: F.col("path").startswith(r["start"]))
    best = F.array_min(held)
    return pairs.join(lists, "host", "left").select(
        *(F.col(c) for c in pairs.columns), best["rule"].alias("rule"), best["verdict"].alias("rule_verdict")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all of ``texts`` (text): runs of letters, A-Z lower-cased, of at most ``LONGEST_WORD`` bytes."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 0):
                words = Words(part.column(0), NOT_LETTERS, lower=True)
                counts = np.bincount(words.ids, minlength=len(words.dictionary))
                yield pa.RecordBatch.from_arrays([words.dictionary.cast(pa.binary()), pa.array(counts, pa.int64())], ["word", "n"])

    counts = texts.select("text").mapInArrow(read, "word binary, n bigint").where(F.length("word") <= LONGEST_WORD)
    return counts.groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def likeliest(name: str, words: dict[str, int], total: int) -> list[str]:
    """The words of the likeliest split of ``name``; of equally likely ones that with the longer last word."""
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        scores = []
        for start in range(max(0, end - LONGEST_WORD), end):
            n = words.get(name[start:end])
            word = math.log(n / total) if n else math.log(10 / total) - (end - start) * math.log(10)
            scores.append((best[start] + word, -start))
        score, start = max(scores)
        best.append(score)
        cut.append(-start)
    out, end = [], len(name)
    while end:
        out.append(name[cut[end] : end])
        end = cut[end]
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words): each distinct ``name`` split by the unigram ``counts`` (word, n)."""
    starts = F.sequence(F.lit(1), F.length("name"))

    def ends(start: Column) -> Column:
        longest = F.least(F.lit(LONGEST_WORD), F.length("name") - start + 1)
        return F.transform(F.sequence(F.lit(1), longest), lambda size: F.substring(F.col("name"), start, size))

    parts = names.select("name", F.explode(F.array_distinct(F.flatten(F.transform(starts, ends)))).alias("word"))
    known = parts.join(counts, "word").groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))
    total = counts.agg(F.sum("n")).first()[0] or 1

    def split(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [likeliest(name, dict(known or ()), total) for name, known in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return names.join(known, "name", "left").select("name", "known").mapInArrow(split, "name string, words array<string>")


def uses_of(pairs: DataFrame) -> DataFrame:
    """(host, path, name): each name of each distinct (host, path), as often as it occurs."""
    return pairs.select("host", "path", F.explode(names_of("host", "path")).alias("name"))


@dataclass(frozen=True)
class Model:
    """``weights`` (word, weight) in millionths, that of an unseen word, and the prior."""

    weights: DataFrame
    unseen: int
    prior: int


def train(labelled: DataFrame, words: DataFrame) -> Model | None:
    """Naive Bayes from ``labelled`` (host, path, n, bad) and the ``words`` (name, words) of their names; None without both classes."""
    prior = {r.bad: r.n for r in labelled.groupBy("bad").agg(F.sum("n").alias("n")).collect()}
    if not prior.get(True) or not prior.get(False):
        return None
    seen = labelled.select("n", "bad", F.explode(names_of("host", "path")).alias("name"))
    sides = (("b", F.col("bad")), ("a", ~F.col("bad")))
    seen = seen.groupBy("name").agg(*(F.sum(F.when(side, F.col("n")).otherwise(0)).alias(c) for c, side in sides))
    counted = seen.join(words, "name").select("a", "b", F.explode("words").alias("word"))
    counted = stored(counted.groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "words")
    different, a, b = counted.agg(F.count(F.lit(1)), F.sum("a"), F.sum("b")).first()
    a, b = (float((n or 0) + SMOOTHING * (different + 1)) for n in (a, b))
    shift = math.log(a) - math.log(b)
    weight = F.round((F.log(F.col("b") + SMOOTHING) - F.log(F.col("a") + SMOOTHING) + F.lit(shift)) * UNIT).cast("bigint")
    return Model(counted.select("word", weight.alias("weight")), round(shift * UNIT), round(math.log(prior[True] / prior[False]) * UNIT))


def score(pairs: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """``pairs`` (host, path, ...) with ``score`` in millionths; above zero speaks for blocking."""
    weight = F.coalesce("weight", F.lit(model.unseen))
    worth = words.select("name", F.explode("words").alias("word")).join(model.weights, "word", "left")
    worth = worth.groupBy("name").agg(F.sum(weight).alias("worth"))
    sums = uses_of(pairs).join(worth, "name").groupBy("host", "path").agg(F.sum("worth").alias("worth"))
    scored = pairs.join(sums, ["host", "path"], "left")
    return scored.select(*(F.col(c) for c in pairs.columns), (F.coalesce("worth", F.lit(0)) + model.prior).alias("score"))


def judge(urls: DataFrame, texts: DataFrame, rules: list[Rule], bad_words: list[str] | None = None, labels: str | None = None) -> DataFrame:
    """Every row of ``urls`` (url) with host, path, rule, verdict and score, its own columns in ``row``.

    Urls are labelled for training by the boolean column ``labels`` of ``urls`` (null: unlabelled), or else by ``bad_words``: a url
    one of whose words is among them is bad, any other is not. ``texts`` (text) is the corpus of the unigram model; the ``bad_words``
    count once more each.
    """
    if labels is None and bad_words is None:
        raise ValueError("urls have labels, or bad words label them")
    spark = urls.sparkSession
    bad_words = list(bad_words or [])
    label = F.lit(None).cast("boolean") if labels is None else F.col(labels)
    row = F.struct(*(F.col(f"`{c}`") for c in urls.columns))
    parsed = urls.select(row.alias("row"), host_of("url").alias("host"), path_of("url").alias("path"), label.alias("label"))
    pairs = parsed.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("label").alias("n_bad"), F.count_if(~F.col("label")).alias("n_good")
    )
    pairs = stored(pairs, "urls")
    counts = word_counts(texts).unionByName(spark.createDataFrame([(w, 1) for w in bad_words], "word string, n bigint"))
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    names = uses_of(pairs).select("name").distinct()
    words = stored(segmented(names, stored(counts, "counts")), "names")
    if labels is None:
        holding = words.where(F.arrays_overlap("words", F.array(*map(F.lit, bad_words)).cast("array<string>"))).select("name")
        marked = uses_of(pairs).join(holding, "name", "left_semi").select("host", "path").distinct().withColumn("bad", F.lit(True))
        labelled = pairs.join(marked, ["host", "path"], "left").select("host", "path", "n", F.coalesce("bad", F.lit(False)).alias("bad"))
    else:
        bad, good = (
            pairs.select("host", "path", F.col(c).alias("n"), F.lit(is_bad).alias("bad")).where("n > 0")
            for c, is_bad in (("n_bad", True), ("n_good", False))
        )
        labelled = bad.unionByName(good)
    model = train(stored(labelled, "labelled"), words)
    chosen = ruled(pairs.select("host", "path"), rules)
    chosen = chosen.withColumn("score", F.lit(None).cast("bigint")) if model is None else score(chosen, words, model)
    own = F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)
    chosen = stored(chosen.select("host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score"), "verdicts")
    return parsed.join(chosen, ["host", "path"]).select("row", "host", "path", "rule", "verdict", "score")
