import random

import numpy as np
import pytest

from commitlens.llm import shingle_join as sj
from commitlens.llm.queries import op11_shingle_join

from .conftest import with_clashes


def slow_set(text, shingle=3):
    words = [w.lower() for w in (text or "").encode().split()]
    if not words:
        return frozenset()
    if len(words) < shingle:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(shingle))))


def slow_components(rows, percent=90, shingle=3):
    """`(key, size, component)` of each row, every pair of rows compared."""
    sets = [slow_set(text, shingle) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(
        ((key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)), key=repr
    )


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at] = f"e{rng.randrange(10**6)}"
    return words


def corpus(seed=1):
    """Near copies on both sides of the threshold, in chains and in a large group, beside shared passages."""
    rng = random.Random(seed)
    texts, passage = [], [f"shared{i}" for i in range(40)]
    for base in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice((12, 30, 64, 127, 128, 300)))]
        for _ in range(8):
            texts.append(edited(rng, words, rng.randrange(0, 1 + len(words) // 25)))
            words = edited(rng, words, 1)
    centre = [f"c{i}" for i in range(150)]
    texts += [edited(rng, centre, rng.randrange(2, 9)) for _ in range(60)]
    texts += [passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))] for _ in range(40)]
    texts += [[f"a{i}" for i in range(11)], [f"a{i}" for i in range(12)], ["A", "b"], ["a", "B"], ["x"], ["x"], []]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(i + 1000, " ".join(t)) for i, t in enumerate(texts[:9])]


def joined(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in sj.shingle_components(docs, **options).collect()), key=repr)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"singles": 2, "pairs": 8},
        {"singles": 0, "pairs": 0, "group_tokens": 2000},
        {"percent": 80, "singles": 1, "pairs": 4, "group_tokens": 500},
        {"percent": 100},
        {"shingle": 1, "percent": 85},
    ],
)
def test_same_as_comparing_all_pairs(spark, options):
    rows = corpus()
    expected = slow_components(rows, options.get("percent", 90), options.get("shingle", 3))
    assert joined(spark, rows, **options) == expected
    assert len({c for _, _, c in expected}) < len(rows) - 8


def test_query_against_brute_force(spark, small, documents):
    found = sorted((tuple(r) for r in op11_shingle_join(spark, small).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert found == slow_components([(r["doc_id"], r["text"]) for r in documents.collect()])


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_similar_sets_share_an_entry(percent):
    rng = np.random.default_rng(percent)
    tested = 0
    for _ in range(1500):
        n = int(rng.integers(4, 400))
        universe = rng.integers(0, 2**63, 2 * n + 50).astype(np.uint64) * np.uint64(2)
        x = np.unique(universe[:n])
        keep = x[rng.random(len(x)) > rng.random() * 0.12]
        y = np.unique(np.concatenate((keep, universe[n : n + int(rng.integers(0, 1 + n // 12))])))
        if np.array_equal(x, y) or not len(y) or not sj.similar(x, y, percent):
            continue
        tested += 1
        counts = rng.choice([2, 16, 17, 1024, 1025, 10**6], p=rng.dirichlet([0.3] * 6), size=len(universe))
        count_of = dict(zip(universe.tolist(), counts.tolist()))
        band = min(len(x), len(y)).bit_length() - 1
        taken = {}
        for own in (x, y):
            assert sj.may_link(len(own), percent) and band in sj.bands_of(len(own), percent)
            taken[id(own)] = sj.unit_of(own, band, percent)
        found = []
        for own, other in ((x, y), (y, x)):
            counted, length = taken[id(own)]
            theirs = set(other[: taken[id(other)][1]].tolist())
            levels = sj.level_of(np.array([count_of[t] if t in theirs else 1 for t in own[:length].tolist()]))
            levels[counted:] = sj._UNCOUNTED
            keys = sj.band_keys(own[:length], band)
            found.append(set(sj.entries_of(keys, levels, len(own), band, percent, 16, 1024).tolist()))
        assert found[0] & found[1]
    assert tested > 100


def test_prefix_always_long_enough():
    for percent in range(80, 101):
        for n in range(1, 3000):
            if sj.may_link(n, percent):
                for band in sj.bands_of(n, percent):
                    paid = sj.subclasses(band, 2) + 2 * sj.subclasses(band, 3)
                    assert sj.prefix_length(n, band, percent) - paid >= sj.losses(n, percent) + 1


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    docs = with_clashes(odd_docs, "key", "uid", "signature", "centre", "n", "first", "component")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = sj.shingle_components(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == slow_components(rows)
    assert sj.shingle_components(no_docs).collect() == []
    keyless = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [tuple(r) for r in sj.shingle_components(keyless).collect()] == [(None, 2, None)] * 2
    with pytest.raises(ValueError):
        sj.shingle_components(no_docs, percent=50)
