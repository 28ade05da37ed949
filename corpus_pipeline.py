"""A training corpus from raw documents: each stage takes what the one before it kept.

    language      documents that no learned language explains, or that hold no letter, go
    near_text     of each group of near-duplicate texts the document with the smallest id stays
    secrets       every span that a secret rule finds becomes a mark
    mixing        sources meet their target weights: documents go, stay or are repeated
    packing       pieces of token sequences of one length

All stages but the last return the columns of their input. ``run`` writes each stage's result to
the shared scratch folder and reads it again, so a lost executor repeats part of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm import language, mixing, near_text, packing, secret_scan
from lakeshelf.llm.stored import read_table, ship_package, stored

# Tokens, language models and shares have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def _row(docs: DataFrame) -> DataFrame:
    """Each row as one column, so that no name of the input can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject; it learns from their own ``lang`` labels.

    A null text, or one without a letter, goes; a null ``lang`` teaches nothing. Repeated rows are judged alike; an empty table stays empty.
    """
    ship_package(spark)
    field = F.col("_row").getField
    rows = _row(docs).select("_row", *(field(c).alias(c) for c in ("doc_id", "text", "lang")))
    rows = rows.withColumn("use", language.use("doc_id", "lang"))
    model = language.train(rows.where("use = 'fit'").select("lang", "text"))
    scored = stored(language.score(rows.select("_row", "use", "lang"), model, text="_row.text", spread="_row.doc_id"), "languages")
    return _columns(language.with_rejection(scored).where("NOT rejected"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows without an id have no group and stay.

    Rows that repeat an id stay or go together. Those equal in every column become one row; any that differ in a column stay. Null and empty
    texts are linked with nothing and stay.
    """
    ship_package(spark)
    stay = near_text.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(stay, "doc_id", "left_semi")
    return named.select(*docs.columns).dropDuplicates().unionByName(docs.where("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with each secret span replaced; ``n_chars`` follows the text.

    Every row stays, with its other columns as they were. Null and empty texts stay what they are; equal texts are masked alike.
    """
    ship_package(spark)
    ledger = secret_scan.extend_ledger(docs.select("text"))
    found = secret_scan.findings(ledger).withColumnRenamed("blob", "_blob").withColumnRenamed("found", "_found")
    rows = _row(docs).withColumn("_blob", secret_scan.address("_row.text")).join(found, "_blob", "left")
    field, masked = F.col("_row").getField, secret_scan.redacted(F.col("_found"), F.col("_row.text"))
    # In a column first, as two columns may use it.
    rows = rows.withColumn("_masked", masked)
    changed = {"text": F.col("_masked")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("_found").isNull(), field("n_chars")).otherwise(F.length("_masked").cast(kind))
    return rows.select(*(changed.get(c, field(c)).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as equal rows.

    A null source is a source; documents without words are not taken; repeated rows are documents of their own.
    """
    ship_package(spark)
    field = F.col("_row").getField
    rows = _row(docs).select("_row", *(field(c).alias(c) for c in ("doc_id", "text", "source")))
    sized = stored(rows.select("_row", "doc_id", mixing.word_count().alias("size"), F.array("source").alias("sources")), "sizes")
    mixed = mixing.mix(sized, keep=["_row"]).where("copies > 0")
    return _columns(mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as ``lakeshelf.llm.packing`` describes them.

    A null or empty text is its closing token alone; repeated rows are packed each; an empty table gives no pieces.
    """
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("near_text", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the given documents; an empty table passes through all of them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
