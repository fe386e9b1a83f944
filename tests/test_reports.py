"""Report semantics on a small table, and the plans of the large ones."""

import datetime as dt

import pytest

import commitlens as cl
import __spark_entry__ as contract
from tests.conftest import plan_of, rows

DAY = dt.date


@pytest.fixture(scope="module")
def commits(spark):
    def row(author, date, files="", repo="r", parents=()):
        changed = [(status, f"f{i}") for i, status in enumerate(files)]
        return (author, author[:1], "h", DAY.fromisoformat(date), "", changed, "m", list(parents), repo, None)

    return spark.createDataFrame(
        [
            row("a@x", "2024-01-31", "AM"),
            row("a@x", "2024-01-01", "A"),
            row("b@x", "2024-03-01", "RX", parents=["1", "2"]),
            row("b@x", "2024-03-31"),
            row("c@x", "2024-03-02", "D", repo="s"),
            row("Others", "2023-12-31", "MMMM", repo="s", parents=["1"]),
            row("a@x", "2024-02-10", repo="t"),
        ],
        cl.COMMITS_SCHEMA,
    )


def test_top_authors_ties_by_name(commits):
    assert [tuple(r) for r in cl.top_authors(commits, 3).collect()] == [("a@x", 3), ("b@x", 2), ("Others", 1)]


def test_others_row_comes_last_and_is_no_author(commits):
    got = [tuple(r) for r in cl.top_authors_with_others(commits, 3).collect()]
    assert got == [("a@x", 3), ("b@x", 2), ("Others", 1), ("Others", 1)]


@pytest.mark.parametrize("n", [4, 20])
def test_no_others_row_without_others(commits, n):
    assert cl.top_authors_with_others(commits, n).count() == 4


def test_others_of_no_commits(commits):
    assert cl.top_authors_with_others(commits.filter("false")).collect() == []


def test_activity(commits):
    got = [tuple(r) for r in cl.commit_activity(commits).collect()]
    assert got == [
        (DAY(2023, 12, 1), 1, "s"),
        (DAY(2024, 1, 1), 2, "r"),
        (DAY(2024, 2, 1), 1, "t"),
        (DAY(2024, 3, 1), 4, "r"),
        (DAY(2024, 3, 1), 2, "s"),
    ]
    monthly = cl.commit_activity(commits, cumulative=False)
    assert (DAY(2024, 3, 1), 2, "r") in [tuple(r) for r in monthly.collect()]


def test_active_authors(commits):
    exact = [tuple(r) for r in cl.active_authors(commits).collect()]
    assert ("r", DAY(2024, 1, 1), 1) in exact
    assert [tuple(r) for r in cl.active_authors(commits, approximate=True).collect()] == exact


def test_status_counts_and_percent(commits):
    counts = {r.repo_id: r for r in cl.file_status_counts(commits).collect()}
    assert (counts["r"].A, counts["r"].M, counts["r"].D, counts["r"].X, counts["r"].total) == (2, 1, 0, 1, 5)
    assert "t" not in counts
    percent = {r.repo_id: r for r in cl.file_status_percent(commits).collect()}
    # The total has statuses without a column, so the four need not sum to 100.
    assert (percent["r"].A, percent["r"].M, percent["r"].R, percent["r"].D) == (40.0, 20.0, 20.0, 0.0)
    shares = rows(cl.file_status_shares(commits).filter("repo_id = 's' AND files > 0"))
    assert shares == [("s", "D", "Deleted", 1, 20.0), ("s", "M", "Modified", 4, 80.0)]


def test_status_columns_found_in_the_data(commits):
    found = cl.file_status_counts(commits, discover=True)
    assert found.columns == ["repo_id", "A", "D", "M", "R", "X"]
    assert {r.repo_id: r.A for r in found.collect()} == {"r": 2, "s": None}


def test_overview_equals_the_reports(commits):
    reports = cl.overview(commits, 2)
    single = {
        "commits_per_author": cl.top_authors_with_others(commits, 2),
        "commit_activity": cl.commit_activity(commits),
        "file_status": cl.file_status_counts(commits),
        "active_authors": cl.active_authors(commits),
    }
    assert {k: rows(v) for k, v in reports.items()} == {k: rows(v) for k, v in single.items()}


def test_overview_long_scans_twice(spark, small):
    """One scan for the shared rollup, one for the file statuses."""
    report = contract.queries()["overview_long"](spark, small)
    report.collect()
    final = plan_of(report).split("== Initial Plan ==")[0]
    tree = final.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2
    assert "ReusedExchange" in tree


def test_top_authors_never_sorts_all(spark, small):
    plan = plan_of(contract.queries()["commits_per_author_top20"](spark, small))
    assert "TakeOrderedAndProject" in plan


def test_with_others_has_no_window_and_no_cross_join(spark, small):
    plan = plan_of(contract.queries()["commits_per_author_with_others"](spark, small))
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_status_report_reads_statuses_only(spark, small):
    plan = plan_of(contract.queries()["file_status_counts"](spark, small))
    schema = next(l for l in plan.splitlines() if "ReadSchema" in l)
    assert "files:array<struct<status:string>>" in schema
    assert "filename" not in schema and "author" not in schema.replace("author_first_char", "")


def test_a_kept_rollup_serves_the_overview(spark, commits):
    rollup = cl.author_months(commits).persist()
    try:
        reports = cl.overview(commits)
        for name in ("commits_per_author", "commit_activity", "active_authors"):
            assert "InMemoryTableScan" in plan_of(reports[name])
    finally:
        rollup.unpersist()
