import numpy as np
import pytest
from pyspark.sql import functions as F

from commitlens.llm.vector_index import CentroidGraph, learn_centroids, lists_of, search

SCHEMA = "vec_id long, embedding array<float>"


def is_query():
    return F.col("id") % 20 == 0


def slow_search(rows, k=20):
    """By brute force, in double precision."""
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, table = np.array([i for i, _ in ok]), np.array([v for _, v in ok])
    out = {}
    for i in sorted({i for i, _ in ok if i % 20 == 0}):
        scores = table @ table[np.flatnonzero(ids == i)[0]]
        order = np.lexsort((ids, -scores))
        out[int(i)] = [(int(ids[j]), float(scores[j])) for j in order if ids[j] != i][:k]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 60)]
    rows += [(60, [1.0, 1.0, 0.0, 0.0]), (80, None), (100, [0.0] * 4), (120, [1.0, None, 0.0, 0.0]), (140, [1.0, float("nan"), 0.0, 0.0])]
    rows += [(160, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (180, [3.0, 3.0, 0.0, 0.0]), (200, [3.0, 3.0, 0.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, 2.0) for r in rows], SCHEMA + ", list long, score double").repartition(3)
    found = by_query(search(table, is_query()).collect())
    want = slow_search(rows)
    assert set(found) == set(want) == {20, 40, 60, 180, 200}
    for query, expected in want.items():
        assert [i for i, _ in found[query]] == [i for i, _ in expected]
        assert np.allclose([s for _, s in found[query]], [s for _, s in expected], rtol=1e-12)


def test_many_equal_vectors_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0]) for i in range(400)] + [(1000, [0.0, 2.0])]
    found = by_query(search(spark.createDataFrame(rows, SCHEMA), is_query()).collect())
    assert found[0] == [(i, 1.0) for i in range(1, 21)]
    assert found[380] == [(i, 1.0) for i in range(20)]
    assert [s for _, s in found[1000]] == [0.0] * 20
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], SCHEMA)
    assert by_query(search(two, is_query()).collect()) == {0: [(1, 2.0)]}


@pytest.mark.parametrize("lengths", ["equal", "spread"])
def test_recall(spark, lengths):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 24))
    table = centres[rng.integers(20, size=4000)] + rng.normal(size=(4000, 24)) * 0.7
    if lengths == "equal":
        table /= np.linalg.norm(table, axis=1)[:, None]
    rows = list(enumerate(table.tolist()))
    found = by_query(search(spark.createDataFrame(rows, SCHEMA), is_query(), list_rows=40).collect())
    want = slow_search(rows)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in w}) / 20 for q, w in want.items()]
    assert np.mean(hits) >= 0.9


def test_graph_finds_what_a_scan_finds():
    rng = np.random.default_rng(6)
    points = rng.normal(size=(3000, 8))
    centroids = learn_centroids(points, 150)
    assert len(centroids) == 150
    graph, missed, total = CentroidGraph(centroids), 0, 0
    for query in rng.normal(size=(100, 8)):
        d = ((centroids - query) ** 2).sum(axis=1)
        want = set(np.flatnonzero(d <= d.min() * 1.4).tolist())
        missed += len(want - set(graph.within(query, 1.4).tolist()))
        total += len(want)
    assert missed <= 0.02 * total
    sizes = np.bincount([x[0] for x in lists_of(points, centroids)], minlength=150)
    assert sizes.max() <= 8 * sizes.mean()


def test_empty_table(spark):
    assert search(spark.createDataFrame([], SCHEMA), is_query()).count() == 0
    assert search(spark.createDataFrame([(1, None)], SCHEMA), is_query()).count() == 0


def test_long_tiny_and_unequal_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1.0, 2.0]), (20, [1e200, 2.0]), (1, [2.0, 1.0]), (2, [1e-200, 0.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0])]
    found = by_query(search(spark.createDataFrame(rows, schema), is_query()).collect())
    assert found == {
        0: [(20, 1e200), (1, 4.0), (2, 1e-200)],
        20: [(1, 2e200), (0, 1e200), (2, 1.0)],
    }
    # Infinite products are kept; infinity less infinity comes last.
    rows = [(0, [1e200, 1e200]), (1, [1e200, 1e200]), (2, [1e200, -1e200]), (3, [1.0, 0.0])]
    found = by_query(search(spark.createDataFrame(rows, schema), is_query()).collect())
    assert found[0] == [(1, float("inf")), (3, 1e200), (2, float("-inf"))]


def test_every_query_gets_k_rows_and_says_what_it_compared(spark):
    rng = np.random.default_rng(8)
    far = [(i, (rng.normal(size=6) * 0.01 + np.eye(6)[i % 6] * 5).tolist()) for i in range(600)]
    found = search(spark.createDataFrame(far, SCHEMA), is_query()).collect()
    counts = np.unique([r["query_id"] for r in found], return_counts=True)[1]
    assert (counts == 20).all() and len(counts) == 30
    assert all(20 < r["compared"] <= 4 * 600 for r in found)


def test_memory_of_posting_does_not_grow_with_lists():
    import tracemalloc

    rng, peaks = np.random.default_rng(9), []
    vectors = rng.normal(size=(256, 16))
    for lists in (1024, 16_384):
        centroids = rng.normal(size=(lists, 16))
        tracemalloc.start()
        found = list(lists_of(vectors, centroids))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        nearest = np.argmin(((vectors[:, None] - centroids[:1024]) ** 2).sum(axis=2), axis=1)
        if lists == 1024:
            assert [x[0] for x in found] == nearest.tolist()
    assert max(peaks) < 64 << 20
