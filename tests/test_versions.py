"""Loads at the same time, older states of the table, and what is swept."""

import os
import time

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from commitlens.sources import commits as table
from tests.conftest import rows
from tests.test_ingest import H, commit
from tests.test_table import hashes, write_logs


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def logs(tmp_path, name, **repos):
    return write_logs(tmp_path / name, **{repo: [commit(H[h]) for h in names] for repo, names in repos.items()})


def during(monkeypatch, what, action):
    """Run `action` once, just before the table's function `what` is first called."""
    real, done = getattr(table, what), []

    def first(*args):
        if not done:
            done.append(True)
            action()
        return real(*args)

    monkeypatch.setattr(table, what, first)
    return done


# Before the load looks at the table again, and between that look and its rename.
@pytest.mark.parametrize("moment", ["_publish", "rename"])
def test_loads_of_different_repositories_both_count(spark, tmp_path, root, monkeypatch, moment):
    cl.ingest_logs(spark, logs(tmp_path, "0", a_b="1", c_d="2", e_f="3"), root, rollups=True)
    other = logs(tmp_path, "2", c_d="5", g_h="6")
    done = during(monkeypatch, moment, lambda: cl.ingest_logs(spark, other, root, rollups=True))
    cl.ingest_logs(spark, logs(tmp_path, "1", a_b="4"), root, rollups=True)
    assert done
    assert hashes(cl.read_commits(spark, root)) == sorted(H[h] for h in "3456")
    assert rows(cl.overview_long_from(cl.read_rollups(spark, root))) == rows(cl.overview_long(cl.read_commits(spark, root)))
    assert rows(cl.versions(spark, root).select("version")) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("moment", ["_publish", "rename"])
def test_the_later_of_two_loads_of_a_repository_changes_nothing(spark, tmp_path, root, monkeypatch, moment):
    cl.ingest_logs(spark, logs(tmp_path, "0", a_b="1", c_d="2"), root)
    other = logs(tmp_path, "2", a_b="5")
    during(monkeypatch, moment, lambda: cl.ingest_logs(spark, other, root))
    with pytest.raises(cl.LoadConflict, match="repo_id=a_b"):
        cl.ingest_logs(spark, logs(tmp_path, "1", a_b="4", c_d="3"), root)
    assert hashes(cl.read_commits(spark, root)) == [H["2"], H["5"]]
    # Its rows are gone, too.
    assert len([n for n in os.listdir(root) if n.startswith("load=")]) == 2


def test_a_load_keeps_what_another_is_writing(spark, tmp_path, root, monkeypatch):
    cl.ingest_logs(spark, logs(tmp_path, "0", a_b="1"), root)
    other = logs(tmp_path, "2", c_d="5")
    # Both have written their rows when the other one begins, sweeps and ends.
    during(monkeypatch, "_publish", lambda: [cl.ingest_logs(spark, other, root) for _ in range(2)])
    cl.ingest_logs(spark, logs(tmp_path, "1", a_b="4"), root)
    assert hashes(cl.read_commits(spark, root)) == [H["4"], H["5"]]


def test_older_versions_can_be_read(spark, tmp_path, root):
    for i, name in enumerate("1234"):
        cl.ingest_logs(spark, logs(tmp_path, name, a_b=name, **({"c_d": "6"} if i == 0 else {})), root)
    begun = cl.read_commits(spark, root, version=1)
    assert hashes(begun) == [H["1"], H["6"]]
    assert [hashes(cl.read_commits(spark, root, ["a_b"], version=v)) for v in (1, 2, 3, 4)] == [[H[n]] for n in "1234"]
    assert hashes(cl.read_commits(spark, root)) == [H["4"], H["6"]]
    found = cl.versions(spark, root).orderBy("version").collect()
    assert [r.version for r in found] == [1, 2, 3, 4]
    assert all(a.published <= b.published for a, b in zip(found, found[1:]))
    with pytest.raises(ValueError, match="version 9"):
        cl.read_commits(spark, root, version=9)


def test_what_was_replaced_long_ago_is_swept(spark, tmp_path, root):
    for name in "123":
        cl.ingest_logs(spark, logs(tmp_path, name, a_b=name, c_d=name if name == "1" else ""), root)
    begun = cl.read_commits(spark, root, version=2)
    time.sleep(1.1)
    # The first two states were replaced more than a second ago, the third is replaced now.
    cl.ingest_logs(spark, logs(tmp_path, "4", a_b="4"), root, keep_seconds=1)
    assert rows(cl.versions(spark, root).select("version")) == [(3,), (4,)]
    assert hashes(cl.read_commits(spark, root, version=3)) == [H["1"], H["3"]]
    assert hashes(cl.read_commits(spark, root)) == [H["1"], H["4"]]
    with pytest.raises(Exception):
        begun.select(F.max("message")).collect()
    # One load holds the other repository still, two the last states of this one.
    assert len([n for n in os.listdir(root) if n.startswith("load=")]) == 3
