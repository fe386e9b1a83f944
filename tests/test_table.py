"""The partitioned table: replacing, reading back, pruning."""

import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import commitlens as cl
from commitlens.sources import commits as table
from commitlens.sources.commits import Pointer
from tests.conftest import plan_of, rows
from tests.test_ingest import H, commit


def write_logs(folder, **logs):
    os.makedirs(folder, exist_ok=True)
    for repo, commits in logs.items():
        with open(f"{folder}/{repo}.gitlog", "w") as f:
            f.write("\n".join(commits))
    return str(folder)


def hashes(df):
    return sorted(r.commit_hash for r in df.select("commit_hash").collect())


def folders(root):
    """What the table's files are: repository and letter of each folder that is read."""
    pointer = Pointer.read(SparkSession.active(), root)
    return sorted(
        f"{repo}/{letter}"
        for repo, load in pointer.commits.items()
        for letter in os.listdir(f"{root}/load={load}/kind=commits/{repo}") if "=" in letter
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_ingest_reports_counts_and_keeps_rejects(spark, tmp_path, root):
    logs = write_logs(
        tmp_path / "logs", a_b=["warning: x", commit(H["1"], files=["M\tf", "warning: y"]), commit(H["2"])],
        c_d=["fatal: z"], e_f=[commit(H["3"])],
    )
    counts = {"blocks": 5, "rejected_blocks": 2, "stray_lines": 1}
    want = [("a_b", "header", "warning: x"), ("a_b", "stray", "warning: y"), ("c_d", "header", "fatal: z")]
    # A second load replaces rejects as it replaces commits.
    for _ in range(2):
        assert cl.ingest_logs(spark, logs, root) == counts
        assert rows(cl.read_rejects(spark, root)) == want
    assert rows(cl.read_rejects(spark, root, ["c_d", "no_ne"])) == want[2:]
    assert rows(cl.read_rejects(spark, root, ["e_f"])) == []
    cl.ingest_logs(spark, write_logs(tmp_path / "2", a_b=[commit(H["1"])]), root)
    assert rows(cl.read_rejects(spark, root)) == want[2:]


def test_rejects_cost_no_second_parse(spark, tmp_path, root):
    logs = write_logs(tmp_path / "logs", a_b=["warning: x", commit(H["1"])])

    def executions():
        found = spark._jsparkSession.sharedState().statusStore().executionsList()
        return {e.executionId(): e for e in map(found.apply, range(found.size()))}

    before = set(executions())
    cl.ingest_logs(spark, logs, root)
    plans = [e.physicalPlanDescription() for number, e in executions().items() if number not in before]
    assert sum("Scan text" in plan for plan in plans) == 1
    assert "Scan text" not in plan_of(cl.read_rejects(spark, root))


def test_one_row_per_commit_of_overlapping_logs(spark, tmp_path, root):
    parts = tmp_path / "logs" / "a_b.gitlog"
    os.makedirs(parts)
    for i, names in enumerate(("12", "23")):
        (parts / f"{i}.txt").write_text("\n".join(["warning: x", *(commit(H[n]) for n in names)]))
    cl.ingest_logs(spark, str(tmp_path / "logs"), root)
    assert hashes(cl.read_commits(spark, root)) == [H["1"], H["2"], H["2"], H["3"]]
    cl.ingest_logs(spark, str(tmp_path / "logs"), root, overlapping=True)
    assert hashes(cl.read_commits(spark, root)) == [H["1"], H["2"], H["3"]]
    assert rows(cl.read_rejects(spark, root)) == [("a_b", "header", "warning: x")]


def test_no_logs_at_all(spark, tmp_path, root):
    os.makedirs(tmp_path / "logs")
    (tmp_path / "logs" / "other.txt").write_text(commit(H["1"]))
    assert cl.ingest_logs(spark, str(tmp_path / "logs"), root) == {
        "blocks": 0, "rejected_blocks": 0, "stray_lines": 0,
    }
    assert cl.read_commits(spark, root).count() == 0


@pytest.mark.parametrize("step", ["write_text", "rename", "names_in", "delete"])
def test_a_load_that_dies_leaves_old_or_new_rows(spark, tmp_path, root, monkeypatch, step):
    """Whatever step fails, readers see a whole table, and the next load sweeps up."""
    old = write_logs(tmp_path / "1", a_b=[commit(H["1"]), commit(H["2"])], c_d=[commit(H["5"])])
    new = write_logs(tmp_path / "2", a_b=[commit(H["3"])])
    cl.ingest_logs(spark, old, root, keep_seconds=0)
    cl.ingest_logs(spark, old, root, keep_seconds=0)
    real, left = getattr(table, step), [0]

    def dies(*args):
        if left[0] == 0:
            raise OSError("the driver is gone")
        left[0] -= 1
        return real(*args)

    for calls in range(6):
        left[0] = calls
        monkeypatch.setattr(table, step, dies)
        try:
            cl.ingest_logs(spark, new, root, keep_seconds=0)
        except OSError:
            pass
        monkeypatch.setattr(table, step, real)
        assert hashes(cl.read_commits(spark, root)) in ([H["1"], H["2"], H["5"]], [H["3"], H["5"]])
    cl.ingest_logs(spark, new, root, keep_seconds=0)
    assert hashes(cl.read_commits(spark, root)) == [H["3"], H["5"]]
    cl.ingest_logs(spark, new, root, keep_seconds=0)
    cl.ingest_logs(spark, new, root, keep_seconds=0)
    # Two repositories, each with the load that holds it, and what the last one replaced.
    assert len([n for n in os.listdir(root) if n.startswith("load=")]) == 3
    assert not [n for n in os.listdir(root) if n.startswith("_making")]


def test_a_reader_that_has_begun_sees_its_rows_through_a_load(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "1", a_b=[commit(H["1"])]), root)
    begun = cl.read_commits(spark, root)
    cl.ingest_logs(spark, write_logs(tmp_path / "2", a_b=[commit(H["2"])]), root)
    assert hashes(begun) == [H["1"]]
    assert hashes(cl.read_commits(spark, root)) == [H["2"]]


def test_repositories_come_from_the_pointer(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", **{"a_b": [commit(H["1"])], "1%2 c": [commit(H["2"])]}), root)
    assert rows(cl.list_repos(spark, root)) == [("1%2 c",), ("a_b",)]
    assert "FileScan" not in plan_of(cl.list_repos(spark, root))


def test_ingest_twice_is_ingest_once(spark, tmp_path, root):
    logs = write_logs(tmp_path / "logs", a_b=[commit(H["1"]), commit(H["2"])], c_d=[commit(H["3"])])
    cl.ingest_logs(spark, logs, root)
    once = rows(cl.read_commits(spark, root))
    cl.ingest_logs(spark, logs, root)
    assert rows(cl.read_commits(spark, root)) == once


def test_reingest_drops_what_is_gone_and_only_there(spark, tmp_path, root):
    cl.ingest_logs(
        spark,
        write_logs(tmp_path / "1", a_b=[commit(H["1"], author="x@x"), commit(H["2"], author="y@y")],
                   c_d=[commit(H["3"], author="z@z")]),
        root,
    )
    cl.ingest_logs(spark, write_logs(tmp_path / "2", a_b=[commit(H["4"], author="y@y")]), root)
    assert folders(root) == ["repo_id=a_b/author_first_char=y", "repo_id=c_d/author_first_char=z"]
    assert hashes(cl.read_commits(spark, root)) == [H["3"], H["4"]]


def test_an_unreadable_log_leaves_its_repository_alone(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "1", a_b=[commit(H["1"])]), root)
    counts = cl.ingest_logs(spark, write_logs(tmp_path / "2", a_b=["fatal: not a git repository"]), root)
    assert counts["rejected_blocks"] == 1
    assert hashes(cl.read_commits(spark, root)) == [H["1"]]


def test_replace_one_repository(spark, tmp_path, root):
    logs = write_logs(tmp_path / "1", a_b=[commit(H["1"], author="x@x")], c_d=[commit(H["3"])])
    cl.ingest_logs(spark, logs, root)
    newer = write_logs(tmp_path / "2", a_b=[commit(H["4"], author="y@y")], c_d=[commit(H["5"])])
    fresh = cl.well_formed(cl.parse_blocks(cl.read_blocks(spark, newer)))
    cl.replace_repo(spark, fresh, root, "a_b")
    assert hashes(cl.read_commits(spark, root)) == [H["3"], H["4"]]
    assert folders(root) == ["repo_id=a_b/author_first_char=y", "repo_id=c_d/author_first_char=a"]
    cl.replace_repo(spark, fresh.filter("false"), root, "a_b")
    assert hashes(cl.read_commits(spark, root)) == [H["3"]]


def test_replace_by_rows_of_the_same_table(spark, tmp_path, root):
    logs = write_logs(tmp_path / "1", a_b=[commit(H["1"], author="x@x"), commit(H["2"], author="y@y")])
    cl.ingest_logs(spark, logs, root)
    cl.replace_repo(spark, cl.read_commits(spark, root).filter("author <> 'x@x'"), root, "a_b")
    assert hashes(cl.read_commits(spark, root)) == [H["2"]]


def test_a_failed_write_leaves_the_table(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "1", a_b=[commit(H["1"])]), root)
    broken = cl.read_commits(spark, root).withColumn(
        "message", F.when(F.col("message") != "", F.raise_error(F.lit("lost")).cast("string"))
    )
    for replace in (cl.replace_repos, lambda *args: cl.replace_repo(*args, "a_b")):
        with pytest.raises(Exception, match="lost"):
            replace(spark, broken, root)
    assert hashes(cl.read_commits(spark, root)) == [H["1"]]


def test_keys_read_back_as_written(spark, tmp_path, root):
    commits = [commit(H["1"], author="7@x"), commit(H["2"], author=""), commit(H["3"], author="%@x")]
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", **{"12": commits, "007": commits[:1]}), root)
    got = rows(cl.read_commits(spark, root).select("repo_id", "author_first_char", "author"))
    assert set(got) == {("007", "7", "7@x"), ("12", "", ""), ("12", "%", "%@x"), ("12", "7", "7@x")}
    assert len(got) == 4
    assert hashes(cl.by_author(cl.read_commits(spark, root), "")) == [H["2"]]


def test_a_commit_without_files_everywhere(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", a_b=[commit(H["1"])]), root)
    assert cl.read_commits(spark, root).select("files").first()[0] == []


def test_empty_table_and_missing_repositories(spark, tmp_path, root):
    os.makedirs(root)
    assert cl.read_commits(spark, root).count() == 0
    assert cl.read_commits(spark, root, ["a_b"]).count() == 0
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", a_b=[commit(H["1"])], c_d=[commit(H["2"])]), root)
    assert hashes(cl.read_commits(spark, root, ["c_d", "no_ne"])) == [H["2"]]
    assert cl.read_commits(spark, root, []).count() == 0


def test_selected_repositories_are_all_that_is_listed(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", a_b=[commit(H["1"])], c_d=[commit(H["2"])]), root)
    files = cl.read_commits(spark, root, ["a_b"]).inputFiles()
    assert files and all("repo_id=a_b" in f for f in files)


def test_write_has_one_exchange_by_key(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", a_b=[commit(H["1"])]), root)
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [executions.apply(i).physicalPlanDescription() for i in range(executions.size())]
    write = [p for p in plans if "InsertIntoHadoopFs" in p][-1].split("== Initial Plan ==")[1].split("(1) ")[0]
    assert write.count("Exchange") == 1
    assert write.count("Sort") == 1
    assert "Python" not in write


def test_hot_folder_is_split(spark, tmp_path, root):
    """A repository's letter that is too large for one task is written by several."""
    commits = spark.range(40_000).select(
        F.sha1(F.col("id").cast("string")).alias("commit_hash"), F.lit("a@x").alias("author")
    )
    full = commits.select(
        "author", F.lit("a").alias("author_first_char"), "commit_hash",
        F.current_date().alias("date"), F.lit("").alias("timestamp"),
        F.array().cast("array<struct<status:string,filename:string>>").alias("files"),
        F.col("commit_hash").alias("message"), F.array().cast("array<string>").alias("parents"),
        F.lit("a_b").alias("repo_id"), F.current_timestamp().alias("committed_at"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "300kb")
    try:
        cl.replace_repos(spark, full.repartition(16), root)
    finally:
        spark.conf.set(setting, before)
    (load,) = Pointer.read(spark, root).commits.values()
    folder = f"{root}/load={load}/kind=commits/repo_id=a_b/author_first_char=a"
    written = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(written) > 1
    assert cl.read_commits(spark, root).select("commit_hash").distinct().count() == 40_000


def test_author_lookup_prunes_both_keys(spark, tmp_path, root):
    cl.ingest_logs(spark, write_logs(tmp_path / "logs", a_b=[commit(H["1"])]), root)
    found = cl.by_author(cl.select_repos(cl.read_commits(spark, root), ["a_b"]), "A@x.ORG")
    filters = next(l for l in plan_of(found).splitlines() if "PartitionFilters" in l)
    assert "repo_id" in filters and "author_first_char" in filters
    assert "EqualTo(author,a@x.org)" in plan_of(found)
    assert hashes(found) == [H["1"]]


ODD_FILES = [
    [("A", "a"), ("M", "b\tc")], [("A", "one\ntwo")], [("R100", "x")], [("A", None)], [(None, "x")], [("", "x")], [], None, [("T", "")],
]
ODD_PARENTS = [[H["1"], H["2"]], [H["1"].upper()], ["ab"], [], None, [H["1"], None], [""], ["f" * 64]]


def test_rows_come_back_whole_from_the_exchange(spark):
    given = [
        (i, h, f, p)
        for i, (h, f, p) in enumerate((h, f, p) for h in (H["1"], "F" * 40, "a" * 64, "abc", "", None) for f in ODD_FILES for p in ODD_PARENTS)
    ]
    kinds = "id int, commit_hash string, files array<struct<status:string,filename:string>>, parents array<string>"
    df = spark.createDataFrame(given, kinds)
    packed = table._packed(df)
    assert packed.filter("files IS NULL AND __packed_files IS NOT NULL").count() > 0
    back = table._unpacked(packed)
    assert back.columns == df.columns and rows(back) == rows(df)


def test_packed_rows_cross_the_exchange(spark, tmp_path, root):
    logs = write_logs(tmp_path / "logs", a_b=[commit(H["1"], files=["M\tf", "A\tg"])])
    rows_ = table._laid_out(cl.well_formed(cl.parse_blocks(cl.read_blocks(spark, logs))).withColumn("kind", F.lit("commits")))
    exchange = next(line for line in rows_._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort" in line)
    assert exchange.strip() and "__packed_files" in rows_._jdf.queryExecution().optimizedPlan().toString()
    assert [f.filename for f in rows_.first().files] == ["f", "g"]
