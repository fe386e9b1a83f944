"""Numbering whole tables, and block operators without keys."""

import random

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from tests.conftest import plan_of, rows
from tests.test_blocks import brute_blocks, brute_bounds


@pytest.mark.parametrize("piece", [1_000_000, 100, 7, 1])
def test_numbers_follow_the_order(spark, piece):
    rnd = random.Random(piece)
    data = [(rnd.choice([None, 1, 2, 3]), rnd.randrange(50), i) for i in range(600)]
    df = spark.createDataFrame(data, "a int, b int, id int").repartition(5)
    got = cl.number_rows(df, ["a", F.desc("b"), "id"], piece_rows=piece)
    assert got.columns == ["a", "b", "id", "row_number"]
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, -r[1], r[2]))
    assert rows(got) == sorted(((*r, i) for i, r in enumerate(ordered)), key=repr)
    assert rows(got) == rows(got)


def test_ties_of_any_size_are_split_and_keep_their_order(spark):
    df = spark.range(0, 5000, 1, 4).select(F.lit("same").alias("k"), "id")
    got = cl.number_rows(df, ["k"], "n", 1, piece_rows=500)
    assert [r.n for r in got.orderBy("id").collect()] == list(range(1, 5001))
    # No piece is much larger than asked for.
    assert max(r["count"] for r in got.groupBy(F.expr("n div 500")).count().collect()) <= 500


def test_names_and_empty_tables(spark):
    df = spark.createDataFrame([(3, 1, 1), (1, 2, 2)], "`a b` int, __place int, __piece int")
    assert rows(cl.number_rows(df, ["a b"], "no")) == [(1, 2, 2, 0), (3, 1, 1, 1)]
    assert cl.number_rows(df.limit(0), ["a b"]).collect() == []
    with pytest.raises(ValueError):
        cl.number_rows(df, ["a b"], "__PLACE")


def test_no_task_takes_the_whole_table(spark):
    got = cl.number_rows(spark.range(1000), ["id"], piece_rows=100)
    # The only window is over one row per piece.
    assert plan_of(got).count("Window [codegen") <= 1 and "SinglePartition" in plan_of(got)
    assert got.rdd.getNumPartitions() >= 1


SCHEMA = "k string, j int, t int, u int, mark boolean, id int"


def keyless(seed, n=300):
    rnd = random.Random(seed)
    return [(None, None, rnd.randrange(40), i, rnd.choice([True, None, False, False]), rnd.choice([i, None])) for i in range(n)]


@pytest.mark.parametrize("bound", [2, 20, 299, 300, 10_000_000])
def test_blocks_without_keys(spark, bound):
    data = keyless(bound)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = cl.assign_blocks(df, [], ["t", "u"], F.col("mark"), "id", bound)
    assert rows(got) == brute_blocks(data)
    bounds = cl.block_bounds(df, [], ["t", "u"], F.col("mark"), "id", bound)
    assert rows(bounds) == sorted((r[2:] for r in brute_bounds(data)), key=repr)
    values = cl.ordered_values(df, [], ["t", "u"], "id", bound)
    ordered = [r[5] for r in sorted(data, key=lambda r: r[2:4]) if r[5] is not None]
    assert rows(values) == sorted(enumerate(ordered, 1), key=repr)


@pytest.mark.parametrize("bound", [20, 10_000])
def test_blocks_of_tables_with_working_names(spark, bound):
    data = keyless(3)
    df = spark.createDataFrame(data, SCHEMA)
    odd = df.withColumns({n: F.lit(7) for n in ("__mark", "__id", "__at", "__seq", "__opened", "__chunk", "c0", "next", "a.b")})
    got = cl.assign_blocks(odd, ["c0"], ["t", "u"], F.col("mark"), "id", bound)
    assert rows(got.select(*SCHEMA.replace(",", "").split()[::2], "block_id", "block_seq", "row_in_block")) == brute_blocks(data)
    assert got.columns == [*odd.columns, "block_id", "block_seq", "row_in_block"]
    bounds = cl.block_bounds(odd, ["next"], ["t", "u"], F.col("mark"), "id", bound)
    assert rows(bounds.drop("next")) == sorted((r[2:] for r in brute_bounds(data)), key=repr)
    with pytest.raises(ValueError):
        cl.assign_blocks(df.withColumn("Block_ID", F.lit(1)), [], ["t"], F.col("mark"), "id")
    with pytest.raises(ValueError):
        cl.block_bounds(df.withColumn("start_t", F.lit(1)), ["start_t"], ["t"], F.col("mark"), "id")
