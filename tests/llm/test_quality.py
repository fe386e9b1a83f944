import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commitlens.llm.quality import (
    COUNTS,
    SYMBOLS,
    Condition,
    keep_good,
    learn_rules,
    rules_of,
    score_quality,
    statistics,
)
from tests.llm.conftest import odd_rows, with_clashes

WORD = r"[^\x20\x09-\x0D]+"


def slow_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab#É \n\n\t\x0b\x1c\xa0", max_size=50)))
def test_counts(text):
    assert statistics(text)[:5] == slow_counts(text)
    assert SYMBOLS == "#*$%&|<>"


def test_rules_are_found_and_clean_rows_stay():
    rng = np.random.default_rng(1)
    n = 3000
    table = {name: rng.uniform(0, 1, n) for name in ("a", "b", "c")}
    bad = ((table["a"] > 0.8) & (table["b"] < 0.5)) | (table["c"] > 0.95)
    rules = learn_rules(table, bad)
    covered = np.zeros(n, bool)
    for rule in rules:
        inside = np.ones(n, bool)
        for condition in rule:
            inside &= condition.holds(table[condition.feature])
        covered |= inside
    assert (covered & ~bad).sum() <= 0.03 * covered.sum() and (covered & bad).sum() >= 0.9 * bad.sum()


def test_nothing_is_learned_from_noise():
    rng = np.random.default_rng(2)
    assert learn_rules({"a": rng.uniform(size=900)}, rng.uniform(size=900) < 0.3) == []
    assert learn_rules({"a": np.zeros(0)}, np.zeros(0, bool)) == []


def test_scores_of_odd_rows(odd_docs):
    rules = [(Condition("symbols_per_word", True, 0.5),), (Condition("n_words", True, 1000.0), Condition("chars_per_word", False, 4.5))]
    docs = with_clashes(odd_docs, "n_words", "kept", "rule", "__s", "base_failed")
    found = score_quality(docs, rules).collect()
    want = []
    for row in odd_rows():
        n, chars, symbols, dup, repeat = slow_counts(row[1])
        failed = n < 50 or 100 * repeat > 50 * n
        rule = 1 if n and symbols / n >= 0.5 else 2 if n >= 1000 and chars / n <= 4.5 else None
        want.append((row[0], n, chars, symbols, dup, repeat, failed, rule, not failed and rule is None))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    kept = keep_good(docs, rules)
    assert kept.columns == docs.columns and kept.count() == sum(w[-1] for w in want)


def test_learned_list_on_held_out_labels(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = F.col("doc_id") % 3 > 0
    rules = rules_of(docs, labels.filter(half))
    assert rules
    found = score_quality(docs, rules).join(labels.filter(~half), "doc_id").filter("NOT base_failed").collect()
    wrong = [r for r in found if r["kept"] != (r["quality"] == 1)]
    assert len(found) > 80 and len(wrong) <= 0.02 * len(found)
    assert {c: dict(score_quality(docs, rules).dtypes)[c] for c in COUNTS} == dict.fromkeys(COUNTS, "bigint")


def test_without_labels_only_the_base_rules_reject(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(1, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert rules_of(odd_docs, labels) == [] and rules_of(odd_docs, nulls) == [] and rules_of(no_docs, nulls) == []
    assert score_quality(no_docs, []).count() == 0 and keep_good(no_docs, []).count() == 0


def test_repeated_keys_come_back_once(spark, documents):
    from commitlens.llm.quality import keep_good, labelled_sample

    texts = [r["text"] for r in keep_good(documents.select("doc_id", "text"), []).limit(6).collect()]
    docs = spark.createDataFrame([(1, t) for t in texts[1:]] * 10 + [(2, texts[0])], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    _, bad = labelled_sample(docs, labels, "doc_id", "text", "quality", 10)
    assert sorted(bad.tolist()) == [False, True]
