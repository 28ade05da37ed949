"""A table without labels keeps its clean documents."""

import corpus_pipeline


def test_unlabelled_documents_stay(spark):
    rows = [(1, "plain words", None), (2, "12 34 !!", None), (3, None, None), (4, "", None), (5, "漢字", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert sorted(tuple(r) for r in kept) == [rows[0], rows[4]]
