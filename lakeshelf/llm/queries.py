"""The queries ``op1_...`` to ``op13_...``: each operator on its whole given table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm import (
    hard_negatives,
    language,
    license_scan,
    mixing,
    near_text,
    near_vectors,
    oracles,
    packing,
    phrases,
    quality,
    secret_scan,
    substring_dedup,
    url_filter,
    vector_search,
)
from lakeshelf.llm.stored import read_table, ship_package, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function):
    @wraps(function)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = query
    if function.__name__ in oracles.SQL:
        SQL[function.__name__] = oracles.SQL[function.__name__]
    return query


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


@_query
def op1_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


@_query
def op2_vector_search(spark, sf_dir):
    return vector_search.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query
def op3_pack_windows(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op4_language(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("use", language.use("doc_id", "lang"))
    model = language.train(docs.where("use = 'fit'"))
    scored = stored(language.score(docs.select("doc_id", "use", "lang", "text"), model, spread="doc_id"), "languages")
    return language.with_rejection(scored).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op5_quality(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    featured = stored(quality.with_features(docs), "features")
    model = quality.train(featured, read_table(spark, sf_dir, "labels"))
    return quality.score(featured, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@_query
def op6_mix_sources(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text", "source")
    sized = stored(docs.select("doc_id", mixing.word_count().alias("size"), F.array("source").alias("sources")), "sizes")
    mixed = mixing.mix(sized)
    return mixed.select(
        "doc_id",
        "size",
        F.col("source_sizes")[0].alias("source_size"),
        F.col("targets")[0].alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@_query
def op7_near_text(spark, sf_dir):
    return near_text.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"))


@_query
def op8_license_diagonals(spark, sf_dir):
    found = license_scan.scan(_documents(spark, sf_dir, "doc_id", "text"))
    exact = F.filter("spans", lambda s: s["exact"])
    starts = F.transform(exact, lambda s: s["start"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(exact).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )


@_query
def op9_repeated_windows(spark, sf_dir):
    return substring_dedup.repeated_words(_documents(spark, sf_dir, "doc_id", "text"))


@_query
def op10_secret_ledger(spark, sf_dir):
    docs = _documents(spark, sf_dir, F.col("doc_id").alias("path"), "text")
    rows, _ = secret_scan.scan_versions(docs)
    found = F.coalesce("found", F.array().cast("array<struct<start:bigint,nth:int,end:bigint,kind:string>>"))
    base = [r.kind for r in secret_scan.BASE_RULES]

    def of_kinds(kinds):
        return F.filter("found", lambda s: s["kind"].isin(kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return rows.withColumn("found", found).select(
        F.col("path").alias("doc_id"),
        *(F.size(of_kinds([k])).cast("bigint").alias(f"n_{k}") for k in base),
        F.sha2(joined(of_kinds(base)), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


@_query
def op12_hard_negatives(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


@_query
def op13_collocations(spark, sf_dir):
    return phrases.mine(_documents(spark, sf_dir, "text", "lang"))


URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]
#: Words that label a url as unwanted, for want of labelled urls among the given tables.
UNWANTED = ["adult", "bet", "casino", "cheap", "crack", "dating", "farm", "loan", "lottery", "pills", "poker", "porn", "sex", "spam", "warez", "xxx"]


@_query
def op11_url_filter(spark, sf_dir):
    judged = url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), _documents(spark, sf_dir, "text"), URL_RULES, UNWANTED)
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "score")
