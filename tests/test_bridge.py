"""Rendered logs: what is shuffled and written for them."""

import glob
import os

import pytest

from commitlens import bridge
from commitlens.sources.gitlog import read_blocks
from tests.conftest import plan_of, rows


def test_columns_are_shuffled_not_text(spark, small):
    dealt = bridge._rendered(bridge._rows(spark, small, False).repartition(3, "key"), False)
    plan = plan_of(dealt)
    exchange = plan[plan.index(") Exchange"):]
    assert "l_partkey" in exchange.split("\n")[1] and "value" not in exchange.split("\n")[1]


def test_lines_of_repeated_and_null_keys(spark, tmp_path):
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"
    spark.createDataFrame([(5, 1, "F", None), (5, 2, "O", None), (None, 3, "F", None)], orders).write.parquet(f"{tmp_path}/orders.parquet")
    items = [(5, 7, 8), (5, 7, 8), (None, 1, 1), (5, None, 8)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    lines = bridge.log_lines(spark, str(tmp_path))
    assert lines.filter("key = 5 AND value LIKE '%src/s8/part 7.c'").count() == 2
    # A line item without a part is a line without text, as it always was.
    assert lines.filter("key = 5 AND value IS NULL").count() == 1
    assert lines.filter("key = 5 AND place = 5").count() == 2


def _odd_tables(spark, folder):
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"
    # Of a later day 8 has gone, of the two orders 3 one; 12 stays, and so does one without a customer.
    made = [(3, 2, "F", None), (3, 1, "O", None), (12, 5, "F", None), (8, 1, "F", None), (4, 2, "F", None), (21, None, "F", None), (5, None, "O", None), (None, 1, "O", None)]
    spark.createDataFrame(made, orders).write.parquet(f"{folder}/orders.parquet")
    items = [(k, 7, 8) for k in (3, 3, 12, 8, 4, 21, 5, 99, None)] + [(12, None, 1)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("later", [False, True])
def test_dealt_rows_are_those_of_the_join(spark, tmp_path, later):
    sf_dir = _odd_tables(spark, tmp_path)
    dealt = bridge._dealt(spark, sf_dir, 3)
    dealt = bridge._left(dealt) if later else dealt
    # One exchange on either day.
    assert plan_of(dealt).count("- Exchange (") == 1
    found = rows(dealt)
    assert found == rows(bridge._rows(spark, sf_dir, later))
    assert sum(row[1] is None and row[0] in (4, 8, 99, None) for row in found) == (0 if later else 4)


@pytest.mark.parametrize("task_lines", [3000, 10**9])
def test_packed_logs_of_both_days_hold_the_text_of_plain_ones(spark, small, tmp_path, monkeypatch, task_lines):
    monkeypatch.setattr(bridge, "TASK_LINES", task_lines)
    bridge.write_logs_of_both_days(spark, small, str(tmp_path / "both"))
    for day, later in (("first", False), ("later", True)):
        bridge.write_logs(spark, small, str(tmp_path / day), later, compression="none")
        plain, packed = (glob.glob(f"{tmp_path}/{at}/log=*.gitlog/part-*") for at in (day, f"both/day={day}"))
        assert all(f.endswith(".gz") for f in packed) and not any(f.endswith(".gz") for f in plain)
        assert sum(map(os.path.getsize, packed)) < 0.5 * sum(map(os.path.getsize, plain))
        # Whole blocks: their lines in order as well.
        blocks = [rows(read_blocks(spark, str(tmp_path / at))) for at in (day, f"both/day={day}")]
        assert blocks[0] == blocks[1] and all(block.count("author: ") >= 1 for _, block in blocks[0])


def test_both_days_are_rendered_once(spark, tmp_path, monkeypatch):
    sf_dir, written = _odd_tables(spark, tmp_path), []
    write = bridge.write_logs_of_both_days
    monkeypatch.setattr(bridge, "write_logs_of_both_days", lambda *args: (written.append(args), write(*args)))
    first, later = bridge.logs_of_both_days(spark, sf_dir)
    assert (bridge.logs_of(spark, sf_dir), bridge.later_logs_of(spark, sf_dir)) == (first, later)
    assert bridge.logs_of_both_days(spark, sf_dir) == (first, later) and len(written) == 1
