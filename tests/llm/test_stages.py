"""What the pipeline's stages do with repeated ids and clashing names."""

import corpus_pipeline


def test_masking_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "password: hunter22 é", b"\1", "f", "m", "r", 7), (2, "plain", b"\2", None, "m", "r", 5), (3, None, None, "f", None, "r", None)],
        "doc_id bigint, text string, _blob binary, _found string, _masked string, _row string, n_chars bigint",
    )
    rows = sorted(map(tuple, corpus_pipeline.mask_secrets(spark, docs, "").collect()))
    assert rows == [(1, "[secret] é", b"\1", "f", "m", "r", 10), (2, "plain", b"\2", None, "m", "r", 5), (3, None, None, "f", None, "r", None)]


def test_rows_that_repeat_an_id(spark):
    given = [(1, "one two three", "en"), (1, "one two three", "fr"), (1, "one two three", "fr"), (None, "x", None), (None, "x", None)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string, lang string")
    rows = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
    assert rows == [(1, "one two three", "en"), (1, "one two three", "fr"), (None, "x", None), (None, "x", None)]
