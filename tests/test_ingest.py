"""The parser on a hand-written log that holds what real logs may hold."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import commitlens as cl
from tests.conftest import plan_of, rows

H = {c: c * 40 for c in "0123456789abcdef"}


def commit(hash_, parents="", subject="s", author="A@x.org", date="2024-03-01 10:00:00 +0000", files=()):
    lines = [f"commit: {hash_}", f"parents: {parents}", f"message: {subject}", f"author: {author}", f"date: {date}"]
    return "\n".join(lines + ([""] + list(files) if files else [])) + "\n"


EDGE = "\n".join(
    [
        "warning: refname 'x' is ambiguous",
        commit(H["a"], f"{H['e']} {H['b']}", "make it work", "Tom@X.org", "2024-03-01 00:30:00 +0200"),
        commit(H["b"], H["a"], "quotes commit: " + H["c"], "auThor@X.org", "2024-02-29 23:59:59 -0530",
               ["M\tsrc/a b.py", "R087\told name\tnew name", "warning: inexact rename", 'A\t"q\\303\\251 "', "D\ttrail \t"]),
        commit(H["c"], H["b"], "one\rtwo", "é@x.org", files=["T\tlink", "C100\ta\tb"]),
        commit(H["d"], H["c"], "author: nobody", "7@x.org"),
        commit(H["e"], H["d"], "", "", files=["A\tf"]),
        commit("f" * 39, "", "short"),
        commit(H["f"], "", "bad day", date="2023-02-29 10:00:00 +0000"),
        commit(H["0"], "", "no time", date="2023-02-28"),
        f"commit: {H['1']}\nparents: \nmessage: cut off\n",
        commit(H["2"], "", "  root  ", "  spaced@x.org  "),
        commit("ab" * 32, "cd" * 32, "64 digits", date="2024-03-01 00:30:00 +1830"),
        commit(H["3"], "", "far west", date="2024-03-01 23:00:00 -2359"),
        commit(H["4"], "", "no such offset", date="2024-03-01 23:00:00 +2400"),
        commit("a" * 41, "", "41 digits"),
    ]
)


@pytest.fixture(scope="module")
def logs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    (folder / "own-er_na me+1.gitlog").write_text(EDGE)
    (folder / "solo_one.gitlog").write_text(commit(H["9"], author="9@9.org"))
    (folder / "solo_empty.gitlog").write_text("")
    (folder / "notes.txt").write_text(commit(H["6"]))
    (folder / "win_dows.gitlog").write_text(
        (commit(H["8"], files=["M\tf"]) + "\n" + commit(H["7"])).replace("\n", "\r\n"), newline=""
    )
    return str(folder)


@pytest.fixture(scope="module")
def parsed(spark, logs):
    return cl.parse_blocks(cl.read_blocks(spark, logs))


@pytest.fixture(scope="module")
def by_hash(parsed):
    return {r.commit_hash: r for r in cl.well_formed(parsed).collect()}


def test_schema(parsed):
    got = cl.well_formed(parsed).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [
        (f.name, f.dataType.simpleString()) for f in cl.COMMITS_SCHEMA
    ]


def test_every_commit_is_kept(by_hash):
    assert set(by_hash) == {H[c] for c in "abcde23" + "9" + "87"} | {"ab" * 32}


def test_prefixes_are_not_character_sets(by_hash):
    a = by_hash[H["a"]]
    assert (a.message, a.author, a.author_first_char) == ("make it work", "tom@x.org", "t")
    assert a.parents == [H["e"], H["b"]]
    assert by_hash[H["b"]].author == "author@x.org"


def test_date_is_the_authors_day(by_hash):
    a, b = by_hash[H["a"]], by_hash[H["b"]]
    assert (a.date, a.timestamp) == (dt.date(2024, 3, 1), "00:30:00+0200")
    assert (b.date, b.timestamp) == (dt.date(2024, 2, 29), "23:59:59-0530")


def test_committed_at_is_the_instant(parsed):
    got = cl.well_formed(parsed).select("commit_hash", F.unix_seconds("committed_at")).collect()
    instants = {h: dt.datetime.fromtimestamp(s, dt.timezone.utc) for h, s in got}
    assert instants[H["a"]].isoformat() == "2024-02-29T22:30:00+00:00"
    assert instants[H["b"]].isoformat() == "2024-03-01T05:29:59+00:00"
    assert instants["ab" * 32].isoformat() == "2024-02-29T06:00:00+00:00"
    assert instants[H["3"]].isoformat() == "2024-03-02T22:59:00+00:00"


def test_files(by_hash):
    files = {h: [tuple(f) for f in r.files] for h, r in by_hash.items()}
    assert files[H["a"]] == []
    assert files[H["b"]] == [
        ("M", "src/a b.py"),
        ("R", "087\told name\tnew name"),
        ("A", '"q\\303\\251 "'),
        ("D", "trail"),
    ]
    assert files[H["c"]] == [("T", "link"), ("C", "100\ta\tb")]
    assert files[H["8"]] == [("M", "f")]


def test_subjects(by_hash):
    assert by_hash[H["b"]].message == "quotes commit: " + H["c"]
    assert by_hash[H["c"]].message == "one two"
    assert by_hash[H["d"]].message == "author: nobody"
    assert by_hash[H["e"]].message == ""
    assert by_hash[H["2"]].message == "root"


def test_authors(by_hash):
    assert (by_hash[H["c"]].author, by_hash[H["c"]].author_first_char) == ("é@x.org", "é")
    assert (by_hash[H["e"]].author, by_hash[H["e"]].author_first_char) == ("", "")
    assert by_hash[H["2"]].author == "spaced@x.org"
    assert by_hash[H["2"]].parents == []


def test_repo_ids(by_hash):
    assert by_hash[H["a"]].repo_id == "own-er_na me+1"
    assert by_hash[H["9"]].repo_id == "solo_one"


def test_rejects(parsed):
    got = [(r.reason, r.text.split("\n")[0]) for r in cl.rejects(parsed).collect()]
    assert sorted(got) == sorted(
        [
            ("header", "warning: refname 'x' is ambiguous"),
            ("stray", "warning: inexact rename"),
            ("header", "f" * 39),
            ("date", H["f"]),
            ("date", H["0"]),
            ("header", H["1"]),
            ("date", H["4"]),
            ("header", "a" * 41),
        ]
    )


@pytest.mark.parametrize("text", ["author: a\nx\nmessage: b", "a\nauthor: b\nmessage: c\ndate: d\nauthor: e\nf", "\n\n"])
def test_junk_is_rejected_not_fatal(spark, text):
    blocks = spark.createDataFrame([("r", text)], "repo_id string, block string")
    parsed = cl.parse_blocks(blocks)
    assert cl.well_formed(parsed).count() == 0
    assert [r.reason for r in cl.rejects(parsed).collect()] == ["header"]


@pytest.mark.parametrize("split_bytes", ["700b", "64kb"])
def test_splits_do_not_tear_blocks(spark, small, split_bytes):
    from commitlens import bridge

    def scan():
        return cl.well_formed(cl.parse_blocks(cl.read_blocks(spark, bridge.logs_of(spark, small))))

    whole = rows(scan())
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, split_bytes)
    try:
        pieces = scan()
        parts = pieces.rdd.getNumPartitions()
        assert rows(pieces) == whole
        assert parts > 1
    finally:
        spark.conf.set(setting, before)


def test_parse_needs_no_shuffle_and_no_python(parsed):
    plan = plan_of(cl.well_formed(parsed))
    assert "Exchange" not in plan
    assert "Python" not in plan
    # The filter stands above the generator: blocks are parsed once.
    assert plan.index("Filter") < plan.index("Generate")


def test_log_sizes(spark, logs):
    got = {r.repo_id: (r.size_bytes, r.size_mb) for r in cl.log_sizes(spark, logs).collect()}
    size = os.path.getsize(f"{logs}/own-er_na me+1.gitlog")
    assert got["own-er_na me+1"] == (size, round(size / 1024**2, 2))
    assert set(got) == {"own-er_na me+1", "solo_one", "solo_empty", "win_dows"}
    assert got["solo_empty"] == (0, 0.0)


def test_only_what_is_asked_for_is_worked_out(parsed):
    files = plan_of(cl.well_formed(parsed).select("files"))
    assert "lower(" not in files and "parents" not in files.split("Generate")[0]
    assert plan_of(cl.well_formed(parsed).select("author")).count("transform(") == 0
