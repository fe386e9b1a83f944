import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commitlens.llm.components import connected_components
from commitlens.llm.simhash import find_links, fingerprint, keep_one_of_each, simhash_groups
from tests.llm.conftest import odd_rows, with_clashes


def slow_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aAbÉ \n\t\x0b\x1f\xa0", max_size=60)), st.integers(1, 5))
def test_fingerprint(text, k):
    assert fingerprint(text, k) == slow_fingerprint(text, k)


def slow_components(values, distance):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                a_, b_ = find(i), find(j)
                root[max(a_, b_)] = min(a_, b_)
    return [find(i) for i in range(len(values))]


def near_values(seed, n=250):
    """Random fingerprints, chains of near ones, and a tight ball."""
    rng = np.random.default_rng(seed)
    values = [int(x) for x in rng.integers(0, 2**63, 60)]
    while len(values) < n:
        flips = rng.choice(64, rng.integers(1, 8), replace=False)
        source = values[rng.integers(len(values))] if len(values) < n - 80 else values[0]
        values.append(source ^ sum(1 << int(b) for b in flips))
    return sorted(set(values))


def signed(values):
    return [v - (1 << 64) if v >> 63 else v for v in values]


# The small bound deals buckets out by the code of their other bits.
@pytest.mark.parametrize("distance, most", [(4, 1 << 23), (4, 2_000), (3, 500), (0, 1 << 23), (1, 50), (2, 1)])
def test_links_connect_what_is_near_and_nothing_else(spark, distance, most):
    values = near_values(distance)
    fps = spark.createDataFrame([(v,) for v in signed(values)], "fp long")
    links = find_links(spark, fps, distance, most)
    mask = (1 << 64) - 1
    parts = {node & mask: root for node, root in connected_components(links).collect()}
    want = slow_components(values, distance)
    got = [parts.get(v, v) for v in values]
    for i in range(len(values)):
        for j in range(i):
            assert (want[i] == want[j]) == (got[i] == got[j])


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_odd_rows(odd_docs):
    found = simhash_groups(with_clashes(odd_docs, "fp", "key", "hash", "root")).collect()
    rows = odd_rows()
    values = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_components(values, 4)
    want = []
    for row, value, root in zip(rows, values, roots):
        keys = [r[0] for r, other in zip(rows, roots) if other == root and r[0] is not None]
        want.append((row[0], signed([value])[0], min(keys, default=None)))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_groups_of_documents(documents):
    rows = documents.select("doc_id", "text").collect()
    values = [slow_fingerprint(r["text"]) for r in rows]
    roots = slow_components(values, 4)
    first = {}
    for row, root in zip(rows, roots):
        first[root] = min(first.get(root, row["doc_id"]), row["doc_id"])
    want = {row["doc_id"]: first[root] for row, root in zip(rows, roots)}
    assert {r["doc_id"]: r["component"] for r in simhash_groups(documents).collect()} == want
    kept = keep_one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_one_of_each_odd_group_stays(odd_docs):
    docs = with_clashes(odd_docs, "fp", "key", "hash", "__hash", "none", "__number")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    # 1 stands for all texts without words, 7 for 9 and its own repeats.
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, None, 4, 5, 6, 7, 8], key=repr)


def test_empty_table(no_docs):
    assert simhash_groups(no_docs).count() == 0 and keep_one_of_each(no_docs).count() == 0
