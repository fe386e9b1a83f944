"""Questions over commits and the SQL door."""

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

import __spark_entry__ as contract
import commitlens as cl
from commitlens import bridge
from commitlens.functions.repo_url import is_repo_url, repo_id
from tests.conftest import rows


@pytest.fixture(scope="module")
def commits(spark, small):
    return cl.read_commits(spark, bridge.table_of(spark, small))


# A file's field may be written as of a struct or as of a map.
DELETED_SQL = """
WITH changes AS (SELECT author, explode(files) AS file FROM commits)
SELECT author, count_if(file['status'] = 'D') AS n_files
FROM changes WHERE file.status <> 'A'
GROUP BY author ORDER BY 2 DESC, 1 LIMIT 5
"""


def test_sql_and_dataframe_twins(spark, commits):
    assert cl.run_sql(spark, commits, contract.CREATED_FILES_SQL).collect() == cl.files_by_author(commits).collect()
    assert cl.run_sql(spark, commits, DELETED_SQL).collect() == cl.files_by_author(commits, "D").collect()
    merges = cl.run_sql(spark, commits, "SELECT * FROM commits WHERE size(parents) > 1")
    assert rows(merges) == rows(cl.merge_commits(commits))


def test_view_holds_selected_repositories(spark, commits):
    got = cl.run_sql(spark, commits, "SELECT DISTINCT repo_id FROM commits;", repos=["org_p2", "no_ne"])
    assert rows(got) == [("org_p2",)]


def test_sql_takes_one_statement(spark, commits):
    with pytest.raises(ParseException):
        cl.run_sql(spark, commits, "SELECT 1; SELECT 2")


def test_explain(spark, commits):
    plan = cl.explain_sql(spark, commits, "SELECT * FROM commits WHERE repo_id = 'org_p1'").collect()
    assert len(plan) == 1
    assert "PartitionFilters" in plan[0].plan
    (commented,) = cl.explain_sql(spark, commits, contract.CREATED_FILES_SQL).collect()
    assert "TakeOrderedAndProject" in commented.plan
    (unresolved,) = cl.explain_sql(spark, commits, "SELECT no_column FROM commits").collect()
    assert "UNRESOLVED_COLUMN" in unresolved.plan


def test_explain_of_nonsense_is_a_row(spark, commits):
    (plan,) = cl.explain_sql(spark, commits, "SELEC 1").collect()
    assert "SELEC 1" in plan.plan and "PARSE_SYNTAX_ERROR" in plan.plan
    with pytest.raises(AnalysisException):
        cl.run_sql(spark, commits, "SELECT no_column FROM commits").collect()


def test_contributors_of_one_absent_repository(commits):
    assert cl.contributors(commits, ["no_ne"]).count() == 0
    assert cl.contributors(commits, ["org_p2", "no_ne"], all_of=True).count() == 0
    twice = cl.contributors(commits, ["org_p2", "org_p2"], all_of=True)
    assert rows(twice) == rows(cl.contributors(commits, ["org_p2"]))


def test_sample(commits):
    assert cl.sample(commits).count() == 5
    assert cl.sample(commits, 0).count() == 0


@pytest.mark.parametrize(
    "url, valid, expected",
    [
        ("https://github.com/apache/spark", True, "apache_spark"),
        ("https://www.gitlab.com/a-b/c_d.git", True, "a-b_c_d"),
        ("https://github.com/a/b/", True, "a_b"),
        ("https://github.com/a/b.git/", True, "a_b"),
        ("https://github.com/a/b//", False, "a_b"),
        ("http://github.com/a/b", False, "a_b"),
        ("https://github.com/a/b.c", False, "a_b.c"),
        ("https://github.com/a", False, "github.com_a"),
        ("https://github.com/a/b/c", False, "b_c"),
        ("https://bitbucket.org/a/b", False, "a_b"),
        ("https://github.com/a/b.git.git", False, "a_b.git"),
        ("abc", False, None),
        ("", False, None),
        ("//", False, None),
        ("https://github.com/", False, None),
        (None, None, None),
    ],
)
def test_repository_urls(spark, url, valid, expected):
    row = spark.createDataFrame([(url,)], "url string").select(is_repo_url(F.col("url")), repo_id(F.col("url")))
    assert tuple(row.first()) == (valid, expected)
