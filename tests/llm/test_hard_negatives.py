import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from commitlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, is_anchor, low=80, n_pos=5, n_neg=5):
    """Every anchor against every row, as the contract says it."""
    def integers(v):
        return [math.floor(256 * float(x)) for x in v]

    def bad(v):
        return v is None or any(x is None or not math.isfinite(x) for x in v)

    best = {}
    for i, v, label in rows:
        if i is not None and label is not None and not bad(v):
            best[i] = min(best.get(i, (label, integers(v))), (label, integers(v)))
    out = []
    for a, (label, v) in best.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in best.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:n_pos]:
            pos = -minus
            fits = [(i, -m) for m, i, other in scored if other != label and low * pos <= -100 * m <= 100 * pos]
            out += [(a, p, r, i, pos, s) for r, (i, s) in enumerate(fits[:n_neg], 1)]
    return sorted(out)


def mined(df, every=10, **options):
    found = hn.mine_hard_negatives(df, F.col("id") % every == 0, F.col("label"), **options)
    return sorted(tuple(r) for r in found.collect())


def vectors(n, dims, labels, seed=3, ties=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] * 0.4 + rng.normal(size=dims) * 0.5
        if ties:
            v = np.round(v * 2) / 2
        rows.append((i, [float(np.float32(x)) for x in v], label))
    return rows


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("block_rows,slice_anchors", [(1 << 14, 1 << 13), (37, 5)])
def test_same_as_scoring_everything(spark, ties, block_rows, slice_anchors):
    rows = vectors(300, 8, 3, ties=ties)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = mined(df, block_rows=block_rows, slice_anchors=slice_anchors)
    assert found == slow(rows, lambda i: i % 10 == 0)
    assert found


def test_common_vector_and_few_rows(spark):
    same = [(i, [0.5, -0.25, 1.0], i % 2) for i in range(120)]
    df = spark.createDataFrame(same, SCHEMA)
    assert mined(df, block_rows=16) == slow(same, lambda i: i % 10 == 0)
    few = same[:3]
    assert mined(spark.createDataFrame(few, SCHEMA)) == slow(few, lambda i: i % 10 == 0)


def test_odd_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 2) + [
        (None, [1.0, 1.0, 1.0, 1.0], 0), (100, None, 0), (110, [1.0, None, 0.0, 0.0], 1), (120, [nan, 0.0, 0.0, 0.0], 1),
        (130, [1.0, inf, 0.0, 0.0], 1), (140, [0.0, 0.0, 0.0, 0.0], 1), (150, [1.0, 1.0], 0), (160, [], 1), (161, [], 0),
        (170, [1.0, 1.0, 1.0, 1.0], None), (0, [2.0, 2.0, 2.0, 2.0], 1), (31, [1.0, -1.0, 0.5, 0.5], 0),
        (31, [1.0, -1.0, 0.5, 0.5], 0), (180, [-1.0, -1.0, -1.0, -1.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit(7) for c in ("id", "anchor", "block", "score", "positive", "windows", "vector")})
    assert mined(df, block_rows=20) == slow(rows, lambda i: i % 10 == 0)
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    # A score of this one might not fit a long: it takes no part.
    huge = spark.createDataFrame([(200, [1e30] * 4, 0)], SCHEMA)
    assert mined(df.select("vec_id", "embedding", "label").unionByName(huge)) == slow(rows, lambda i: i % 10 == 0)


def test_search_stops_early():
    rng = np.random.default_rng(1)
    found = hn.Lists(np.arange(4000), rng.integers(-100, 100, (4000, 3)))
    window = hn.Places(5, -hn._LONG, hn._LONG)
    anchor = np.array([3, -2, 1])
    met = hn.threshold_search(found, anchor, [window], np.zeros(4000, bool))
    scores = found.vectors @ anchor
    assert window.ids.tolist() == np.lexsort((found.ids, -scores))[:5].tolist()
    assert met < 2000
