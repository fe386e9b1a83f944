"""Conditions on authors reach the partition folders through the SQL door."""

import re

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from commitlens import bridge
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def commits(spark, small):
    return cl.read_commits(spark, bridge.table_of(spark, small))


@pytest.fixture(scope="module")
def people(spark, commits, tmp_path_factory):
    """Authors of three letters, some in capitals, one null, two not in the table."""
    some = [r.author for r in commits.select("author").distinct().filter("author <> ''").orderBy("author").collect()]
    chosen = [next(a for a in some if a[0] == letter) for letter in "ao"]
    data = [(a,) for a in chosen] + [(chosen[0].upper(),), (None,), ("zz@none",)]
    # Files, whose size is known.
    folder = str(tmp_path_factory.mktemp("people") / "data")
    spark.createDataFrame(data, "person string").write.parquet(folder)
    spark.read.parquet(folder).createOrReplaceTempView("people")
    return chosen


def letters_read(df):
    """Letters in each scan's partition filters; None where a scan has none on the key."""
    out = []
    for line in plan_of(df).split("\n"):
        if line.startswith("PartitionFilters:"):
            found = [f for f in re.split(r"(?<=\)), ", line) if "author_first_char" in f]
            out.append(sorted(set(re.findall(r"(?:= |IN \(|,)(\w?)(?=[,)])", "".join(found)))) or None if found else None)
    return out


def plainly(spark, commits, text):
    commits.createOrReplaceTempView("commits")
    return spark.sql(text)


# {a} and {o} are authors of those letters; `reads` lists each scan's letters.
CASES = [
    ("SELECT * FROM commits WHERE author = '{a}'", 1),
    ("SELECT commit_hash FROM commits WHERE '{a}' = author AND size(parents) > 0", 1),
    ("SELECT commit_hash FROM commits WHERE author IN ('{a}', '{o}', 'zz@none')", 3),
    ("SELECT count(*) AS n FROM commits WHERE author IN ({many})", None),
    ("SELECT author, count(*) AS n FROM (SELECT * FROM commits WHERE repo_id < 'org_p4') WHERE author = '{o}' GROUP BY author", 1),
    ("WITH c AS (SELECT lower(author) AS who, author, commit_hash FROM commits) SELECT commit_hash FROM c WHERE author = '{a}'", 1),
    ("SELECT a.commit_hash FROM commits a JOIN commits b ON a.author = b.author AND a.date = b.date WHERE a.author = '{a}'", 1),
    ("SELECT commit_hash FROM commits JOIN people ON author = person", 3),
    ("SELECT commit_hash FROM people LEFT JOIN commits ON author = person", 3),
    ("SELECT commit_hash FROM commits WHERE author IN (SELECT person FROM people WHERE person LIKE 'a%')", 1),
]


@pytest.mark.parametrize("text, n_letters", CASES)
def test_only_needed_folders_are_read(spark, commits, people, text, n_letters):
    many = ", ".join(f"'a{i}@x'" for i in range(20))
    text = text.format(a=people[0], o=people[1], many=many)
    expected = rows(plainly(spark, commits, text).select(F.col("*")))
    got = cl.run_sql(spark, commits, text)
    reads = letters_read(got)
    assert reads and all(r is not None for r in reads), plan_of(got)
    if n_letters:
        assert all(len(r) == n_letters for r in reads)
    assert rows(got) == expected


def test_two_scans_with_letters_of_their_own(spark, commits, people):
    text = f"""SELECT commit_hash FROM commits WHERE author = '{people[0]}'
        UNION ALL SELECT commit_hash FROM commits WHERE author = '{people[1]}'"""
    got = cl.run_sql(spark, commits, text)
    assert sorted(map(tuple, letters_read(got))) == [("a",), ("o",)]
    assert rows(got) == rows(plainly(spark, commits, text))


@pytest.mark.parametrize(
    "text",
    [
        "SELECT repo_id, count(*) AS n FROM commits GROUP BY repo_id",
        "SELECT count(*) AS n FROM commits WHERE author = '{a}' OR date > '2020-01-01'",
        "SELECT count(*) AS n FROM commits WHERE upper(author) = upper('{a}')",
        "SELECT commit_hash, person FROM commits LEFT JOIN people ON author = person",
        "SELECT (SELECT count(*) FROM commits) AS n, count(*) AS m FROM commits WHERE author = '{a}'",
        "SELECT author, n FROM (SELECT author, count(*) OVER (PARTITION BY repo_id) AS n FROM commits) WHERE author = '{a}'",
        "SELECT author FROM commits WHERE author <> '{a}'",
        "SELECT a.author FROM commits a LEFT ANTI JOIN people ON a.author = person",
    ],
)
def test_results_never_change(spark, commits, people, text):
    text = text.format(a=people[0])
    assert rows(cl.run_sql(spark, commits, text)) == rows(plainly(spark, commits, text))


def test_statements_without_authors_read_no_author(spark, commits):
    got = cl.run_sql(spark, commits, "SELECT repo_id, count(*) AS n FROM commits WHERE date > '2000-01-01' GROUP BY repo_id")
    assert "author#" not in plan_of(got).split("ReadSchema")[1]


def test_the_view_stays_whole(spark, commits, people):
    cl.run_sql(spark, commits, f"SELECT * FROM commits WHERE author = '{people[0]}'")
    assert spark.table("commits").count() == commits.count()


def test_large_sides_are_not_looked_up(spark, commits, people):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = cl.run_sql(spark, commits, "SELECT commit_hash FROM commits JOIN people ON author = person")
        assert "PartitionFilters" not in plan_of(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_commands_run_once(spark, commits, people):
    text = f"CREATE OR REPLACE TEMP VIEW mine AS SELECT * FROM commits WHERE author = '{people[0]}'"
    cl.run_sql(spark, commits, text)
    assert spark.table("mine").count() == commits.filter(F.col("author") == people[0]).count()


def test_authors_that_are_null(spark):
    data = [("a@x", "a", "h1"), (None, None, "h2"), ("", "", "h3")]
    df = spark.createDataFrame(data, "author string, author_first_char string, commit_hash string")
    assert cl.run_sql(spark, df, "SELECT count(*) AS n FROM commits").first().n == 3


def test_explain_shows_the_folders(spark, commits, people):
    (row,) = cl.explain_sql(spark, commits, f"SELECT * FROM commits WHERE author = '{people[0]}'").collect()
    assert re.search(r"PartitionFilters: \[.*author_first_char", row.plan)
