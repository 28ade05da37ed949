"""What an executor and its workers hold at once."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakeshelf.llm import language
from lakeshelf.llm.stored import BATCH, ship_package


def test_batches_of_texts_are_bounded(spark):
    """Ten thousand texts of three thousand letters are no longer one batch."""
    name = BATCH[0]
    before = spark.conf.get(name, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    texts = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("a b"), 1000).alias("text"))
    try:
        spark.conf.unset(name)
        ship_package(spark)
        assert max(r.n for r in texts.mapInArrow(sizes, "n bigint").collect()) < 6 << 20
        spark.conf.set(name, "1m")
        ship_package(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)


def test_a_shard_of_the_model_is_not_held_in_copies():
    rnd = np.random.default_rng(1)
    symbols = rnd.integers(1, 40, (60_000, language.ORDER))
    keys = np.unique((symbols << (np.arange(language.ORDER)[::-1] * language.BITS)).sum(axis=1))
    strings = {f"l{j}": (keys, rnd.integers(1, 5, len(keys)).astype(np.float64)) for j in range(24)}
    tracemalloc.start()
    try:
        model = language.build_model(strings)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    numbers = sum(x.size for x in [*model.probabilities, *model.weights])
    assert peak < 19 * numbers
