"""Finding commits by hash, contributors by bitmaps, and the file list of rows being parsed."""

import random

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from commitlens import bridge
from tests.conftest import plan_of, rows
from tests.test_ingest import H, commit
from tests.test_table import hashes, write_logs


def rows_scanned(df):
    """Rows that come out of the scans of a plan, once it has run."""
    before = df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        found = again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        return found, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", before)


def test_row_groups_without_the_hash_are_skipped(spark, small):
    root = bridge.table_of(spark, small)
    table = cl.read_commits(spark, root)
    wanted = [r.commit_hash for r in table.filter("repo_id = 'org_p1'").orderBy("commit_hash").limit(2).collect()]
    found, scanned = rows_scanned(cl.find_commits(spark, root, [w.upper() for w in wanted] + ["f" * 40]))
    assert sorted(r.commit_hash for r in found) == wanted
    assert 2 <= scanned < table.count() / 4
    nobody, scanned = rows_scanned(cl.find_commits(spark, root, ["0" * 40]))
    assert nobody == [] and scanned < table.count() / 10


def test_many_hashes_and_none(spark, tmp_path):
    root = str(tmp_path / "table")
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", a_b=[commit(H["1"]), commit(H["2"])], c_d=[commit(H["2"])]), root)
    assert hashes(cl.find_commits(spark, root, [])) == []
    many = [f"{i:040x}" for i in range(50)] + [H["2"], H["2"]]
    assert hashes(cl.find_commits(spark, root, many)) == [H["2"], H["2"]]
    assert hashes(cl.find_commits(spark, root, many, ["a_b"])) == [H["2"]]


def test_file_list_is_worked_out_once(spark, small):
    parsed = cl.parse_blocks(cl.read_blocks(spark, bridge.logs_of(spark, small)))
    files = cl.changed_files(cl.well_formed(parsed), "repo_id", "commit_hash")
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(filter(") == 1
    twice = cl.well_formed(parsed).select("commit_hash", F.inline("files"))
    assert twice._jdf.queryExecution().optimizedPlan().toString().count("transform(filter(") > 1
    assert rows(files.select("commit_hash", "status", "filename")) == rows(twice)


@pytest.mark.parametrize("n_repos", [3, 64, 200])
def test_contributors_by_bitmaps(spark, n_repos):
    rnd = random.Random(n_repos)
    repos = [f"r{i:03}" for i in range(n_repos)]
    data = [(f"a{rnd.randrange(30)}", rnd.choice(repos)) for _ in range(600)] + [("", repos[0]), (None, repos[-1])]
    commits = spark.createDataFrame(data, "author string, repo_id string")
    subsets = {"all": repos, "two": [repos[0], repos[-1], repos[0]], "gone": ["none"], "half_gone": [repos[1], "none"], "empty": []}
    bitmaps = cl.author_bitmaps(commits)
    counts = {}
    for author, repo in set(data):
        for name, wanted in subsets.items():
            if repo in wanted:
                counts[name, author] = counts.get((name, author), 0) + 1
    expected = [(s, a, n) for (s, a), n in counts.items()]
    assert rows(cl.contributors_of(bitmaps, subsets)) == sorted(expected, key=repr)
    for k in (2, 5):
        assert rows(cl.contributors_of(bitmaps, subsets, at_least=k)) == sorted((r for r in expected if r[2] >= k), key=repr)
    whole = [r for r in expected if r[2] == len(set(subsets[r[0]]))]
    assert rows(cl.contributors_of(bitmaps, subsets, all_of=True)) == sorted(whole, key=repr)


def test_many_subsets_take_one_look(spark):
    commits = spark.range(100).select(F.concat(F.lit("a"), F.col("id") % 9).alias("author"), F.concat(F.lit("r"), F.col("id") % 5).alias("repo_id"))
    bitmaps = cl.author_bitmaps(commits)
    few, many = ({f"s{i}": ["r1", f"r{i % 5}"] for i in range(n)} for n in (2, 40))
    assert plan_of(cl.contributors_of(bitmaps, few)).count("Range (") == plan_of(cl.contributors_of(bitmaps, many)).count("Range (")
