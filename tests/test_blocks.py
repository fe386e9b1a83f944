"""Block operators against brute force, on ordinary and on hot keys."""

import random

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from tests.conftest import plan_of, rows

SCHEMA = "k string, j int, t int, u int, mark boolean, id int"


def made(seed, n=600):
    """Keys of very different size, one of them null; a marker's id may be null too."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = rnd.choice(["hot"] * 6 + ["warm"] * 2 + [None, "cold", "x", "y"])
        mark = rnd.choice([True, None] + [False] * 6)
        data.append((k, rnd.choice([1, None]) if k == "hot" else 1, rnd.randrange(40), i, mark, rnd.choice([i, i, None])))
    rnd.shuffle(data)
    return data


def brute_blocks(data):
    out, groups = [], {}
    for row in data:
        groups.setdefault(row[:2], []).append(row)
    for group in groups.values():
        current, seq, pos = None, 0, 0
        for row in sorted(group, key=lambda r: (r[2], r[3])):
            if row[4]:
                current, seq, pos = row[5], seq + 1, 0
            pos += 1
            out.append((*row, current, seq, pos))
    return sorted(out, key=repr)


def brute_bounds(data):
    out, groups = [], {}
    for row in data:
        if row[4]:
            groups.setdefault(row[:2], []).append(row)
    for key, group in groups.items():
        group.sort(key=lambda r: (r[2], r[3]))
        for i, row in enumerate(group):
            following = group[i + 1][2:4] if i + 1 < len(group) else (None, None)
            out.append((*key, row[5], i + 1, *row[2:4], *following))
    return sorted(out, key=repr)


# A small bound makes every key hot, a middling one some, the default none.
@pytest.mark.parametrize("bound", [2, 25, 120, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_assign_blocks(spark, bound, seed):
    data = made(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = cl.assign_blocks(df, ["k", "j"], ["t", "u"], F.col("mark"), "id", bound)
    assert got.columns == [*df.columns, "block_id", "block_seq", "row_in_block"]
    assert rows(got) == brute_blocks(data)


@pytest.mark.parametrize("bound", [1, 10, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_block_bounds(spark, bound, seed):
    data = made(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = cl.block_bounds(df, ["k", "j"], ["t", "u"], F.col("mark"), "id", bound)
    assert got.columns == ["k", "j", "block_id", "block_seq", "start_t", "start_u", "next_t", "next_u"]
    assert rows(got) == brute_bounds(data)


def test_key_without_marker(spark):
    df = spark.createDataFrame([("a", 1, t, t, False, t) for t in range(9)], SCHEMA)
    got = cl.assign_blocks(df, ["k"], ["t"], F.col("mark"), "id", 3)
    assert rows(got.select("t", "block_id", "block_seq", "row_in_block")) == [(t, None, 0, t + 1) for t in range(9)]
    assert cl.block_bounds(df, ["k"], ["t"], F.col("mark"), "id").count() == 0


def test_ordinary_keys_take_one_shuffle_and_one_sort(spark, small):
    import __spark_entry__ as contract

    tree = plan_of(contract.queries()["event_blocks"](spark, small)).split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("Sort (") == 1


def ordered(data):
    out = {}
    for k, _, _, _, _, value in sorted(data, key=lambda r: (r[2], r[3])):
        out.setdefault(k, [])
        if value is not None:
            out[k].append(value)
    return out


def test_collect_ordered_is_one_row_per_key(spark):
    data = made(3)
    got = cl.collect_ordered(spark.createDataFrame(data, SCHEMA), ["k"], ["t", "u"], "id")
    assert got.columns == ["k", "values"]
    assert sorted(((r.k, r["values"]) for r in got.collect()), key=repr) == sorted(ordered(data).items(), key=repr)


@pytest.mark.parametrize("bound", [1, 7, 50, 10_000])
def test_positions_and_pieces_do_not_depend_on_the_bound(spark, bound):
    data = made(3)
    df = spark.createDataFrame(data, SCHEMA)
    want = ordered(data)
    rows_ = cl.ordered_values(df, ["k"], ["t", "u"], "id", bound)
    assert rows(rows_) == sorted(((k, i, v) for k, vs in want.items() for i, v in enumerate(vs, 1)), key=repr)
    pieces = cl.collect_pieces(df, ["k"], ["t", "u"], "id", 4, bound)
    assert pieces.columns == ["k", "part", "values"]
    got = {(r.k, r.part): r["values"] for r in pieces.collect()}
    assert got == {(k, at // 4): vs[at : at + 4] for k, vs in want.items() for at in range(0, len(vs), 4)}


def test_values_that_are_all_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None)], "k string, t int, v string")
    assert cl.collect_ordered(df, ["k"], ["t"], "v").collect()[0]["values"] == []
    assert cl.ordered_values(df, ["k"], ["t"], "v").count() == 0


def test_hot_groups_without_broadcast(spark, monkeypatch):
    """The joins shuffle where keys are too many or too wide; the result is the same."""
    from commitlens.operators import skew

    data = made(1)
    df = spark.createDataFrame(data, SCHEMA)
    for setting in ("MAX_BROADCAST_GROUPS", "MAX_BROADCAST_BYTES"):
        monkeypatch.setattr(skew, setting, 0)
        got = cl.assign_blocks(df, ["k", "j"], ["t", "u"], F.col("mark"), "id", 5)
        assert rows(got) == brute_blocks(data)
        monkeypatch.undo()


def test_scope_frees_what_was_stored(spark):
    import os

    from commitlens.scratch import scope, shared_root

    def kept():
        return set(os.listdir(shared_root(spark).removeprefix("file:")))

    before = kept()
    with scope(spark):
        df = spark.createDataFrame(made(1), SCHEMA)
        assert cl.assign_blocks(df, ["k"], ["t", "u"], F.col("mark"), "id", 2).count()
        assert kept() > before
    assert kept() == before
