"""Hard negatives against plain products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshelf.llm import hard_negatives, stored
from lakeshelf.llm.hard_negatives import Packed


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    stored.ship_package(spark)


@pytest.mark.parametrize("most", [0, 1, 40, 3000, 10**7, 2**40])
@pytest.mark.parametrize("sign", [-1, 0, 1])
def test_packed_products_are_exact(most, sign):
    rng = np.random.default_rng(most % 97)
    low, high = {-1: (-most, 0), 0: (-most, most), 1: (0, most)}[sign]
    rows, anchors = (rng.integers(low, high, (n, 5), endpoint=True) for n in (11, 4))
    rows[3], anchors[0] = low, low
    packed = Packed(rows, int(anchors.min()), int(anchors.max()))
    want = [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]
    if max(abs(v) for line in want for v in line) < 2**63:
        assert packed.scores(anchors).tolist() == want
    else:
        with pytest.raises(OverflowError):
            packed.scores(anchors)
    assert packed.fields > 1 or most > 40


def plain(rows, is_anchor, positives, negatives):
    def score(a, b):
        return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b))

    out = []
    for anchor, label, v in rows:
        if not is_anchor(anchor):
            continue
        scored = sorted((-score(v, w), i, m) for i, m, w in rows if i != anchor and len(w) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out += [(anchor, i, rank, j, -p, -s) for rank, (s, j, _) in enumerate(hard, 1)]
    return sorted(out)


def test_same_as_plain_search(spark, monkeypatch):
    """Many blocks, ties (few different components), a label with most rows, vectors of two lengths."""
    monkeypatch.setattr(hard_negatives, "ROW_BYTES", 2000)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 500)
    rng = np.random.default_rng(4)
    rows = [
        (i, int(rng.choice([0, 0, 0, 1, 2])), (rng.integers(-2, 6, 6 if i % 11 else 4) / 16).tolist()) for i in rng.permutation(300).tolist()
    ]
    df = spark.createDataFrame([r + (7, "x") for r in rows], "vec_id bigint, label int, embedding array<float>, place int, dim string")
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, positives=3, negatives=4)
    want = plain(rows, lambda i: i % 10 == 0, 3, 4)
    assert len(want) > 150 and sorted(map(tuple, got.collect())) == want


def test_edges(spark):
    bad = [None, [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0]]
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.0]), (2, 2, [0.5, 0.0]), (3, None, [0.5, 0.0]), (None, 2, [0.5, 0.0])]
    rows += [(10 + i, 2, v) for i, v in enumerate(bad)] + [(20, 2, []), (21, 2, [0.5]), (30, 3, [0.99, 0.0]), (0, 1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    got = hard_negatives.mine(df, F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 2, 65536, 32768)]
    assert hard_negatives.mine(df, F.lit(None).cast("boolean")).count() == 0
    assert hard_negatives.mine(df.limit(0), F.lit(True)).count() == 0
    huge = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1e300])], "vec_id bigint, label int, embedding array<double>")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        hard_negatives.mine(huge, F.col("vec_id") == 0).collect()
