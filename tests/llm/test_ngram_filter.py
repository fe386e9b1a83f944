import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commitlens.llm.ngram_filter import Segments, build_segment, count_of, levels_of, score_texts
from tests.llm.conftest import odd_rows, with_clashes


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def teaches(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 != 2


def learns_from():
    return F.crc32(F.col("doc_id").cast("string")) % 7 != 2


def slow_scores(rows):
    counts = Counter()
    for key, text in rows:
        if teaches(key):
            counts.update(words_of(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        words = words_of(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out.append((key, not teaches(key), len(words), sum(counts[w] > 0 for w in words), total, base))
    return out


def slow_model(rows, prior, least):
    """What the filter's counts stand for, without a filter."""
    words, pairs = Counter(), Counter()
    for key, text in rows:
        if teaches(key):
            found = words_of(text)
            words.update(found)
            pairs.update(zip([None, *found], found))

    def quantised(n, low=1):
        return float(count_of(levels_of(np.array([n]), low), low)[0])

    size, out = sum(words.values()) + len(words) + 1, []
    for _, text in rows:
        found, score = words_of(text), 0.0
        for a, b in zip([None, *found], found):
            context, n = quantised(words[a]), pairs[a, b]
            together = min(quantised(n, least), context)
            score += math.log10((together + prior * (quantised(words[b]) + 1) / size) / (context + prior))
        out.append(score)
    return out


def compare(found, rows):
    want = sorted(slow_scores(rows), key=repr)
    got = sorted((tuple(r)[:6] for r in found), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=50), st.integers(1, 5))
def test_levels_keep_counts_within_a_step(counts, least):
    counts = np.array(counts)
    levels = levels_of(counts, least)
    known = counts >= least
    assert (levels[known] >= 1).all() and not levels[~known].any()
    assert (np.abs(np.log2(count_of(levels, least)[known] / counts[known])) <= 0.5).all()
    assert levels_of(np.array([0])).tolist() == [0] and count_of(np.array([0])).tolist() == [0]


def test_filter_forgets_nothing_and_invents_little():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 40_000).astype(np.uint64)
    counts = rng.geometric(0.3, 40_000)
    filter_ = Segments(2, {1: build_segment(keys[:20_000], counts[:20_000]).tobytes()})
    known, strange = (filter_.levels(k, np.ones(len(k), np.int64)) for k in (keys[:20_000], keys[20_000:]))
    assert not filter_.levels(keys, np.zeros(len(keys), np.int64)).any()
    levels = levels_of(counts[:20_000])
    assert (known >= levels).all() and (known > levels).mean() < 0.02 and (strange > 0).mean() < 0.02


# A slice of one byte makes every segment a slice of its own.
@pytest.mark.parametrize("slice_bytes", [1 << 20, 1])
def test_scores_of_odd_rows(odd_docs, slice_bytes):
    docs = with_clashes(odd_docs, "key", "learns", "score", "chunk", "n_tokens")
    found = score_texts(docs, learns_from(), slice_bytes=slice_bytes).collect()
    compare(found, [r[:2] for r in odd_rows()])
    assert all(r["score"] < 0 for r in found)


def test_model_matches_its_counts_and_beats_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = sorted(score_texts(docs, learns_from()).collect(), key=lambda r: r["doc_id"])
    compare(found, rows)
    model = slow_model(sorted(rows), 300.0, 2)
    got = np.array([r["score"] for r in found])
    # False positives of the filter move a text's score by little.
    assert np.abs(got - model).sum() <= 0.005 * np.abs(model).sum()
    held_out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)


def test_nothing_teaches(odd_docs, no_docs):
    found = score_texts(odd_docs, F.lit(None).cast("boolean")).collect()
    assert len(found) == len(odd_rows())
    assert all(r["held_out"] and r["n_known"] == r["train_tokens"] == 0 and r["base_score"] == 0 for r in found)
    assert score_texts(no_docs, F.lit(True)).count() == 0


def test_levels_are_half_a_power_of_two_and_false_positives_are_rare():
    counts = np.arange(1, 10_000)
    # Integers alone round a small level's middle by more.
    assert (np.abs(np.log2(count_of(levels_of(counts)) / counts)) <= 0.3).all()
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 2**63, 400_000).astype(np.uint64)
    filter_ = Segments(1, {0: build_segment(keys[:200_000], np.ones(200_000, np.int64)).tobytes()})
    assert (filter_.levels(keys[200_000:], np.zeros(200_000, np.int64)) > 0).mean() < 0.008


def test_query_knows_pairs_seen_once(spark, tmp_path):
    from commitlens.llm.queries import op8_lm_scoring

    rows = [(i, f"the cat number{i} met the dog number{i + 1} on day{i % 5} of the week") for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(op8_lm_scoring(spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])
    got = np.array([r["score"] for r in found])
    once, twice = (np.array(slow_model(rows, 300.0, least)) for least in (1, 2))
    assert np.abs(got - once).sum() < 0.2 * np.abs(got - twice).sum()
