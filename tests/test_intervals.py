"""The interval join against brute force, and its plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from commitlens.operators.intervals import choose_levels
from tests.conftest import plan_of, rows

POINTS, RANGES = "k string, p long, id int", "k string, lo long, hi long, name int"


def made(seed, n=250, m=120):
    rnd = random.Random(seed)
    keys = ["a"] * 5 + ["b", "c", None]
    points = [(rnd.choice(keys), rnd.choice([rnd.randrange(-500, 500), 7, None]), i) for i in range(n)]
    ranges = []
    for i in range(m):
        lo = rnd.randrange(-600, 500)
        length = rnd.choice([0, 1, 2, rnd.randrange(20), rnd.randrange(800), -3, 5000])
        ranges.append((rnd.choice(keys), rnd.choice([lo, lo, None]), rnd.choice([lo + length] * 4 + [None]), i))
    # Repeated rows, and the widest there are.
    return points + points[:9], ranges + ranges[:9] + [("a", -(2**63), 2**63 - 1, 900)]


def brute(points, ranges, keyed):
    out = []
    for k, p, i in points:
        for key, lo, hi, name in ranges:
            if keyed and (k is None or k != key):
                continue
            if p is None or (lo is not None and hi is not None and lo >= hi):
                continue
            if (lo is None or lo <= p) and (hi is None or p < hi):
                out.append((k, p, i, *(() if keyed else (key,)), lo, hi, name))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [1_000_000, 40, 3])
@pytest.mark.parametrize("keyed", [True, False])
def test_same_as_brute_force(spark, bound, keyed):
    points, ranges = made(bound)
    left, right = spark.createDataFrame(points, POINTS), spark.createDataFrame(ranges, RANGES)
    if not keyed:
        right = right.withColumnRenamed("k", "other")
    got = cl.interval_join(left, right, "p", "lo", "hi", ["k"] if keyed else None, bound)
    assert got.columns == ["k", "p", "id", *([] if keyed else ["other"]), "lo", "hi", "name"]
    assert rows(got) == brute(points, ranges, keyed)


def test_dates_and_timestamps(spark):
    day = dt.date(2024, 1, 1)
    days = [(day + dt.timedelta(i), i) for i in range(20)]
    spans = [(day + dt.timedelta(i), day + dt.timedelta(i + 1 + i % 4), i) for i in range(0, 20, 3)]
    expected = sorted((p, i, lo, hi, j) for p, i in days for lo, hi, j in spans if lo <= p < hi)
    for kind in ("date", "timestamp", "timestamp_ntz"):
        left = spark.createDataFrame(days, "p date, i int").withColumn("p", F.col("p").cast(kind))
        right = spark.createDataFrame(spans, "lo date, hi date, j int")
        right = right.withColumns({c: F.col(c).cast(kind) for c in ("lo", "hi")})
        got = cl.interval_join(left, right, "p", "lo", "hi")
        assert got.schema["p"].dataType.simpleString() == kind
        assert rows(got.select(F.col("p").cast("date"), "i", F.col("lo").cast("date"), F.col("hi").cast("date"), "j")) == sorted(expected, key=repr)


def test_empty_sides_and_names(spark):
    left, right = spark.createDataFrame([], POINTS), spark.createDataFrame([("a", 1, 2, 3)], RANGES)
    assert cl.interval_join(left, right, "p", "lo", "hi", ["k"]).collect() == []
    some = spark.createDataFrame([("a", 1, 1)], POINTS)
    assert cl.interval_join(some, right.limit(0), "p", "lo", "hi", ["k"]).collect() == []
    odd = some.withColumns({"__at": F.lit(1), "__bin": F.lit(2), "a b.c": F.lit(3)})
    got = cl.interval_join(odd, right.withColumn("__level", F.lit(4)), "p", "lo", "hi", ["k"])
    assert rows(got) == [("a", 1, 1, 1, 2, 3, 1, 2, 3, 4)]
    with pytest.raises(ValueError):
        cl.interval_join(some, right, "p", "lo", "hi")
    with pytest.raises(TypeError):
        cl.interval_join(some.withColumn("p", F.lit(1.5)), right, "p", "lo", "hi", ["k"])


def test_plan_is_an_equi_join_whatever_the_lengths(spark):
    left = spark.range(1000).select(F.col("id").alias("p"))
    lengths = [F.lit(1), F.lit(50), F.lit(900)]
    right = spark.range(300).select("id", (F.col("id") * 3).alias("lo"))
    right = right.withColumn("hi", F.col("lo") + F.get(F.array(*lengths), (F.col("id") % 3).cast("int")))
    got = cl.interval_join(left, right, "p", "lo", "hi")
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == sum(min(1000, 3 * i + (1, 50, 900)[i % 3]) - 3 * i for i in range(300))


def test_hot_bins_are_split(spark):
    left = spark.range(2000).select(F.lit(5).cast("long").alias("p"), "id")
    right = spark.range(60).select(F.lit(0).cast("long").alias("lo"), F.lit(9).cast("long").alias("hi"), F.col("id").alias("j"))
    got = cl.interval_join(left, right, "p", "lo", "hi", None, 100)
    assert "__row" in plan_of(got)
    assert got.count() == got.distinct().count() == 2000 * 60


def test_levels_follow_the_data():
    # Few points: a level for each of two very different lengths; many: still, one row each is worth it.
    assert len(set(choose_levels({3: 10_000, 20: 10_000}, 1_000, 1 << 22).values())) == 2
    assert len(set(choose_levels({9: 10, 10: 10_000, 11: 10}, 10_000_000, 1 << 30).values())) == 1
    assert choose_levels({}, 5, 5) == {}
    widths = choose_levels({c: 1000 for c in range(63)}, 1000, 2**62)
    assert all(c - widths[c] <= 12 for c in widths)


ASKED = {"n": ("count", None), "least": ("min", "id"), "most": ("max", "v")}


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("n, m", [(250, 120), (3000, 60), (5, 40)])
def test_summaries_same_as_brute_force(spark, keyed, n, m):
    points, ranges = made(n, n, m)
    value = {i: None if i % 3 == 0 else float("nan") if i % 97 == 1 else (i * 7919 % 1009) / 8 for _, _, i in points}
    left = spark.createDataFrame([(*p, value[p[2]]) for p in points], f"{POINTS}, v double")
    right = spark.createDataFrame(ranges, RANGES)
    key, expected = "k" if keyed else "other", {}
    for *row, lo, hi, name in brute(points, ranges, keyed):
        expected.setdefault((row[0] if keyed else row[3], lo, hi, name), []).append(row[2])
    # A repeated interval comes as often as it stands.
    times = {r: ranges.count(r) for r in ranges}
    wanted = []
    for interval, ids in expected.items():
        kept = [value[i] for i in ids if value[i] is not None]
        most = max(kept, key=lambda v: (v != v, v), default=None)
        wanted += [(*interval, len(ids) // times[interval], min(ids), most)] * times[interval]
    got = cl.interval_join(left, right if keyed else right.withColumnRenamed("k", "other"), "p", "lo", "hi",
                           ["k"] if keyed else None, summary=ASKED)
    assert got.columns == [key, "lo", "hi", "name", "n", "least", "most"]
    assert list(map(repr, rows(got))) == sorted(map(repr, wanted))


def test_summaries_make_no_pairs(spark):
    left = spark.range(20_000).select("id", F.col("id").alias("p"), F.lit(1.5).alias("v"))
    right = spark.range(20_000).select(F.col("id").alias("lo"), F.lit(None).cast("long").alias("hi"), F.col("id").alias("j"))
    got = cl.interval_join(left, right, "p", "lo", "hi", summary=ASKED)
    # 200 million pairs; a range is at most two slices a level of the tree.
    assert "__bin" not in plan_of(got)
    assert got.filter(F.col("n") == 20_000 - F.col("j")).filter("least = j").count() == 20_000
    empty = cl.interval_join(left.limit(0), right, "p", "lo", "hi", summary=ASKED)
    assert empty.collect() == []
    assert cl.interval_join(left, right.limit(0), "p", "lo", "hi", summary=ASKED).collect() == []


def test_bins_follow_the_points_of_a_key():
    # Of a million points an interval's key has a thousand: wider bins do, so an interval is in few of them.
    all_points, per_key = (choose_levels({30: 100_000}, 1_000_000, 1 << 32, met)[30] for met in (None, 1_000))
    assert per_key > all_points
    # Some 400 points to an interval are not worth more than four rows of it.
    assert 1.5 * 2.0 ** (30 - choose_levels({30: 100_000}, 1_000, 1 << 32)[30]) + 1 <= 4


def test_keys_of_one_side_only_are_left_out(spark):
    left = spark.range(1000).select((F.col("id") % 100).alias("k"), "id", F.col("id").alias("p"))
    right = spark.createDataFrame([(3, 0, 500), (777, 0, 500)], "k long, lo long, hi long")
    got = cl.interval_join(left, right, "p", "lo", "hi", ["k"])
    assert sorted(r["id"] for r in got.collect()) == [3, 103, 203, 303, 403]
    assert "LeftSemi" in plan_of(got)
