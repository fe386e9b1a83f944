import hashlib
import random
import zlib

import numpy as np
import pytest

from commitlens.llm import periodic_runs as pr
from commitlens.llm.queries import op13_periodic_runs, planted_words

from .conftest import with_clashes


def slow_runs(words, least=12):
    """Every period against every position."""
    n, found = len(words), []
    covered = {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= max(least, 2 * q) - q:
                # A shorter period of the whole stretch was met before.
                if not any(q % p == 0 and s <= i and s + length >= j + q for p in covered for s, length in covered[p]):
                    found.append((i, j + q - i, q))
                covered.setdefault(q, []).append((i, j + q - i))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def slow_row(words):
    runs = slow_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return runs, hashlib.sha256(kept).hexdigest()


def found_in(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r for r in pr.periodic_runs(docs, **options).collect()}


def odd_texts():
    rng = random.Random(5)
    texts = [None, "", " \n", "a", "a a a", "a " * 11, "a " * 12, "ab c " * 6, "ab c " * 5 + "ab", "x y z " * 400]
    for _ in range(60):
        # Few letters, so that runs overlap, nest and touch.
        texts.append(" ".join(rng.choice("ab") for _ in range(rng.randint(10, 120))))
    for period in (5, 8, 13, 31, 32, 33, 64, 100, 250):
        head = [f"h{rng.random()}" for _ in range(rng.randint(0, 40))]
        root = [f"r{rng.randint(0, 9)}" for _ in range(period)]
        tail = [f"t{rng.random()}" for _ in range(rng.randint(0, 40))]
        times = rng.choice((2, 2.4, 3.5, 9))
        texts.append(" ".join(head + (root * 10)[: int(period * times)] + tail))
    # A repeat inside a repeat, and a long text of many tiles.
    inner = (["u", "v", "w"] * 7 + [f"k{i}" for i in range(30)]) * 4
    texts.append(" ".join(inner))
    texts.append(" ".join([f"a{i}" for i in range(900)] + [f"p{i % 37}" for i in range(2600)] + ["z"] * 1500 + [f"b{i}" for i in range(50)]))
    return texts


def test_same_as_trying_every_period(spark):
    texts = odd_texts()
    found = found_in(spark, texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        if len(words) > 3000:
            continue
        runs, sha = slow_row(words)
        assert [tuple(r) for r in found[i]["runs"]] == runs, text
        assert found[i]["collapsed_sha256"] == sha
        assert found[i]["n_words"] == len(words)


def test_runs_over_many_tiles_are_one(spark):
    text = odd_texts()[-1]
    runs = [tuple(r) for r in found_in(spark, [text])[0]["runs"]]
    assert (900, 2600, 37) in runs and (3500, 1500, 1) in runs
    assert all(length >= max(12, 2 * q) for _, length, q in runs)


@pytest.mark.parametrize("octave", [1, 2, 4, 8, 16])
def test_tile_has_every_interval_of_matches(octave):
    rng = np.random.default_rng(octave)
    for _ in range(40):
        words = rng.integers(0, 2, 150).tolist()
        if rng.random() < 0.7:
            q = int(rng.integers(octave, 2 * octave))
            words[20:140] = (words[20 : 20 + q] * 130)[:120]
        expected = []
        for q in range(octave, 2 * octave):
            i = 0
            while i < len(words) - q:
                j = i
                while j < len(words) - q and words[j] == words[j + q]:
                    j += 1
                if j - i >= max(12, 2 * q) - q:
                    expected.append((q, i, j))
                i = j + 1
        assert pr.tile_matches(words, octave, len(words)) == expected


def test_z_function():
    rng = random.Random(1)
    for _ in range(50):
        s = [rng.randint(0, 1) for _ in range(30)]
        slow = [next((k for k in range(30 - i) if s[k] != s[i + k]), 30 - i) for i in range(30)]
        assert pr.z_function(s)[1:] == slow[1:]


def test_other_least_length(spark):
    texts = ["a b a b c", "a a b b", "x y z x y z x", "q " * 30]
    found = found_in(spark, texts, min_length=2)
    for i, text in enumerate(texts):
        assert [tuple(r) for r in found[i]["runs"]] == slow_runs(text.encode().split(), 2)


def test_query_against_brute_force(spark, small, documents):
    found = {r["doc_id"]: r for r in op13_periodic_runs(spark, small).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    planted = 0
    for row in rows:
        words = planted_words(row["doc_id"], row["text"])
        planted += zlib.crc32(str(row["doc_id"]).encode()) % 10 == 0
        got = found[row["doc_id"]]
        if len(words) > 1200:
            assert got["n_runs"] >= (zlib.crc32(str(row["doc_id"]).encode()) % 10 == 0)
            continue
        runs, sha = slow_row(words)
        assert got["n_runs"] == len(runs) and got["collapsed_sha256"] == sha
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert got["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        assert (got["start"], got["length"], got["period"]) == best
        assert got["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
    assert planted > 5


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    docs = with_clashes(odd_docs, "key", "uid", "tiles", "runs", "sha", "period", "start", "octave")
    found = pr.run_digest(pr.periodic_runs(docs))
    rows = found.collect()
    assert len(rows) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["collapsed_sha256"] for r in rows if r["doc_id"] in (1, 2, 3)} == {empty}
    long = [r for r in rows if r["doc_id"] == 4]
    assert [(r["n_runs"], r["start"], r["length"], r["period"]) for r in long] == [(1, 0, 60_000, 1)]
    assert [r["exponent_milli"] for r in long] == [60_000_000]
    assert sum(r["doc_id"] is None for r in rows) == 3
    assert pr.run_digest(pr.periodic_runs(no_docs)).collect() == []
