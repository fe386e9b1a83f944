"""Rollups kept with each load, and reports from them."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from commitlens.sources.commits import Pointer
from tests.conftest import plan_of, rows
from tests.test_ingest import H, commit
from tests.test_table import write_logs


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def logs(folder, **repos):
    made = {}
    for repo, authors in repos.items():
        made[repo] = [commit(H[str(i % 6 + 1)], author=a, files=["M\tf", "A\tg"][: i % 3]) for i, a in enumerate(authors)]
    return write_logs(folder, **made)


def overviews(spark, root):
    return rows(cl.overview_long_from(cl.read_rollups(spark, root))), rows(cl.overview_long(cl.read_commits(spark, root)))


def test_equal_to_the_overview_after_every_load(spark, tmp_path, root):
    cl.ingest_logs(spark, logs(tmp_path / "1", a_b=["x@x", "y@y", "x@x"], c_d=["z@z"], e_f=["x@x"]), root, rollups=True)
    stored, fresh = overviews(spark, root)
    assert stored == fresh and stored
    later = logs(tmp_path / "2", a_b=["q@q", "x@x"], g_h=["x@x"])
    cl.ingest_logs(spark, later, root, rollups=True)
    assert len(set(overviews(spark, root)[0]) & set(stored)) and overviews(spark, root)[0] == overviews(spark, root)[1]
    # A load without rollups, and a repository that is emptied.
    cl.ingest_logs(spark, logs(tmp_path / "3", c_d=["n@n"] * 4), root)
    cl.replace_repo(spark, cl.read_commits(spark, root).filter("false"), root, "e_f")
    stored, fresh = overviews(spark, root)
    assert stored == fresh
    assert rows(cl.read_rollups(spark, root, ["c_d", "no_ne"]).select("repo_id").distinct()) == [("c_d",)]


def test_a_load_scans_only_what_it_replaces(spark, tmp_path, root):
    cl.ingest_logs(spark, logs(tmp_path / "1", a_b=["x@x"], c_d=["z@z", "y@y"]), root, rollups=True)
    before = {r for r in rows(cl.read_rollups(spark, root)) if r[0] == "c_d"}
    (load,) = set(Pointer.read(spark, root).commits.values())
    # Without the files of the other repository neither a load nor a report misses them.
    shutil.rmtree(f"{root}/load={load}/kind=commits/repo_id=c_d")
    cl.ingest_logs(spark, logs(tmp_path / "2", a_b=["n@n"]), root, rollups=True)
    found = cl.read_rollups(spark, root)
    assert {r for r in rows(found) if r[0] == "c_d"} == before
    report = cl.overview_long_from(found)
    assert "kind=commits" not in plan_of(report)
    assert {r.key for r in report.collect() if r.report == "commits_per_author"} == {"n@n", "y@y", "z@z"}


def test_replaced_rollups_are_swept(spark, tmp_path, root):
    for author in ("x@x", "y@y", "z@z", "w@w"):
        cl.ingest_logs(spark, logs(tmp_path / author, a_b=[author]), root, rollups=True, keep_seconds=0)
    assert len([n for n in os.listdir(root) if n.startswith("load=")]) == 2


def test_estimates_of_distinct_authors(spark, root):
    n = 20_000
    commits = spark.range(n).select(
        F.concat(F.lit("a"), F.col("id") % 7001, F.lit("@x")).alias("author"), F.lit("a").alias("author_first_char"),
        F.sha1(F.col("id").cast("string")).alias("commit_hash"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 360).cast("int")).alias("date"), F.lit("").alias("timestamp"),
        F.array().cast("array<struct<status:string,filename:string>>").alias("files"), F.lit("").alias("message"),
        F.array().cast("array<string>").alias("parents"), F.concat(F.lit("r"), F.col("id") % 3).alias("repo_id"),
        F.lit(None).cast("timestamp").alias("committed_at"),
    )
    cl.replace_repos(spark, commits, root, rollup=cl.rollup_of)
    found = cl.read_rollups(spark, root)
    for period in ("month", "quarter", "year", None):
        by = [] if period is None else [F.date_trunc(period, "date").cast("date").alias("period")]
        exact = {r[:-1]: r[-1] for r in map(tuple, commits.groupBy("repo_id", *by).agg(F.count_distinct("author")).collect())}
        got = {r[:-1]: r[-1] for r in map(tuple, cl.approx_authors(found, period, by_repo=True).collect())}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - exact[k]) <= max(1, 0.065 * exact[k]) for k in exact)
    assert abs(cl.approx_authors(found, None).first().authors - 7001) < 0.05 * 7001
    # Only sketches travel.
    assert "author#" not in plan_of(cl.approx_authors(found)).split("ReadSchema")[1].split("\n")[0]


def test_empty_table(spark, root):
    os.makedirs(root)
    assert rows(cl.overview_long_from(cl.read_rollups(spark, root))) == []
    assert cl.approx_authors(cl.read_rollups(spark, root)).collect() == []
