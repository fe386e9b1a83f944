import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from commitlens.llm.mixing import Level, mix, take_mixed
from commitlens.llm.queries import mixture_levels, op4_source_mixing, oracle_sql
from tests.conftest import plan_of
from tests.llm.conftest import odd_rows, with_clashes


def levels(weights=None):
    def weight(name):
        return F.expr((weights or {}).get(name, "1"))

    return [Level(name, F.col(name), weight(name)) for name in ("lang", "source")]


def water(budget, children):
    """Even filling by weight up to each limit, by repeated rounds in exact fractions."""
    got, open_ = {}, dict(children)
    left = Fraction(budget)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [c for c, (w, limit) in open_.items() if w == 0 or limit * total <= left * w]
        if not full:
            return got | {c: left * w / total for c, (w, _) in open_.items()}
        # The fullest for its weight first, so that none is overfilled.
        c = min(full, key=lambda c: Fraction(open_[c][1], open_[c][0]) if open_[c][0] else -1)
        got[c] = Fraction(open_[c][1] if open_[c][0] else 0)
        left -= got[c]
        del open_[c]
    return got


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_mix(rows, weight, percent, epochs, seed):
    """rows: (key, lang, source, tokens). Copies of each row, and each leaf's exact share."""
    leaves = defaultdict(list)
    for row in rows:
        leaves[row[1], row[2]].append(row)
    tokens = {leaf: sum(r[3] for r in found) for leaf, found in leaves.items()}
    limit = {leaf: epochs * t if weight("lang", leaf) and weight("source", leaf) else 0 for leaf, t in tokens.items()}
    langs = {leaf[0] for leaf in leaves}
    budget = min(sum(tokens.values()) * percent // 100, sum(limit.values()))
    by_lang = water(budget, {g: (weight("lang", (g, None)), sum(v for k, v in limit.items() if k[0] == g)) for g in langs})
    return tokens, limit, by_lang, leaves


def check(docs, rows, weights, weight, percent, epochs, seed=17):
    found = mix(docs, levels(weights), percent=percent, max_epochs=epochs, seed=seed).collect()
    tokens, limit, by_lang, leaves = slow_mix(rows, weight, percent, epochs, seed)
    taken = defaultdict(int)
    for r in found:
        taken[r["lang"], r["source"]] += r["tokens"]
        assert r["epoch"] < epochs
    for lang, share in by_lang.items():
        family = {k: (weight("source", k), limit[k]) for k in leaves if k[0] == lang}
        for leaf, exact in water(share, family).items():
            got = [(r["doc_id"], r["tokens"], r["epoch"]) for r in found if (r["lang"], r["source"]) == leaf]
            # Which documents: whole epochs, then a prefix of one more in seeded order.
            whole = int(exact) // tokens[leaf] if tokens[leaf] else 0
            for e in range(epochs):
                here = sorted((d, t) for d, t, n in got if n == e)
                everything = sorted(((r[0], r[3]) for r in leaves[leaf]), key=repr)
                if e < whole:
                    assert sorted(here, key=repr) == everything
                elif e == whole:
                    order = lambda k: hashlib.md5(f"{seed}:{e}:{'null' if k is None else k}".encode()).hexdigest()
                    groups = defaultdict(list)
                    for r in leaves[leaf]:
                        groups[order(r[0])].append((r[0], r[3]))
                    want, start, rest = [], 0, exact - whole * tokens[leaf]
                    for o in sorted(groups):
                        # A budget is rounded to whole tokens at each of two levels.
                        if start < rest - 2:
                            want += groups[o]
                        elif start < rest + 2:
                            want = None
                            break
                        start += sum(t for _, t in groups[o])
                    if want is not None:
                        assert sorted(here, key=repr) == sorted(want, key=repr)
                else:
                    assert not here


@pytest.mark.parametrize("percent, epochs", [(30, 1), (100, 1), (100, 3), (250, 4), (1000, 2), (0, 2)])
def test_shares_of_documents(documents, percent, epochs):
    rows = [(r[0], r[1], r[2], words(r[3])) for r in documents.select("doc_id", "lang", "source", "text").collect()]
    weights = {"lang": "CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 7 ELSE 2 END", "source": "CASE WHEN source = 'src0' THEN 0 ELSE 3 END"}

    def weight(name, leaf):
        if name == "lang":
            return {"en": 1, "de": 7}.get(leaf[0], 2)
        return 0 if leaf[1] == "src0" else 3

    check(documents, rows, weights, weight, percent, epochs)


def test_odd_rows(odd_docs):
    docs = with_clashes(odd_docs, "tokens", "epochs", "last", "share", "budget", "weight", "limit", "__key")
    rows = [(r[0], r[2], r[3], words(r[1])) for r in odd_rows()]
    check(docs, rows, None, lambda name, leaf: 1, 150, 2)
    kept = take_mixed(docs, levels(), percent=150, max_epochs=2)
    again = mix(docs, levels(), percent=150, max_epochs=2)
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=repr) == sorted(
        (r[0] for r in again.select("doc_id").collect()), key=repr
    )


def test_nothing_to_take(odd_docs, no_docs):
    assert mix(no_docs, levels()).count() == 0 and take_mixed(no_docs, levels()).count() == 0
    assert mix(odd_docs, levels({"lang": "0"})).count() == 0
    assert mix(odd_docs, levels({"lang": "CAST(NULL AS INT)"})).count() == 0


def test_no_python_and_same_rows_as_sql(spark, small):
    found = op4_source_mixing(spark, small)
    assert not re.search("Python|Pandas|Arrow", plan_of(found))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = con.execute(oracle_sql()["op4_source_mixing"]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(want)


def test_levels_of_the_query(documents):
    domain = mixture_levels()[0].value
    assert {r[0] for r in documents.select(domain).distinct().collect()} <= {"d0", "d1", "d2", "other"}
