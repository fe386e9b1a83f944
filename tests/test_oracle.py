"""Every query against its SQL in DuckDB, on the tables alone."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# The training-data queries without SQL have brute-force tests of their own.
ROWS_ONLY = {"explain_plan": 1}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return con


def canonical(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(record[i] for i in order) for record in records), key=repr
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, small, name):
    result = QUERIES[name](spark, small)
    expected = duck.sql(ORACLES[name])
    assert canonical(result.columns, [tuple(r) for r in result.collect()]) == canonical(
        expected.columns, expected.fetchall()
    )


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, small, name):
    assert len(QUERIES[name](spark, small).collect()) == ROWS_ONLY[name]


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["author", "n_files"]
    assert result.count() == 5
