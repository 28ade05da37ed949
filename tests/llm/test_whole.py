"""Whole results: what a bound, a cut or a missing part would lose."""

import random

import pytest
from test_methods import text_classes

from lakeshelf.llm import near_text, stored


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    stored.ship_package(spark)


def components_of(spark, docs):
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    return {r.doc_id: r.component_id for r in near_text.near_duplicates(df).collect()}


def test_pairs_beyond_reach(spark, monkeypatch):
    """Variants of one text at about 0.57, each with one partner at 0.77: many of these are next to each other in no order."""
    for name, value in (("NEAR", 1), ("REACH", 1), ("BLOCK", 64), ("MANY", 3)):
        monkeypatch.setattr(near_text, name, value, raising=False)
    rnd = random.Random(6)

    def changed(words, n):
        words = list(words)
        for at in rnd.sample(range(len(words)), n):
            words[at] = f"c{rnd.randrange(10**6)}"
        return words

    base, texts = [f"w{i}" for i in range(240)], []
    for _ in range(250):
        own = changed(base, 7)
        texts += [own, changed(own, 6)]
    rnd.shuffle(texts)
    docs = {i: " ".join(words) for i, words in enumerate(texts)}
    assert components_of(spark, docs) == text_classes(docs)
