"""

Queries over commits read a commits table that is rendered from `orders` and
`lineitem` as git-log text and ingested from that text, once per session. Their
SQL works on the two tables alone and never sees the text.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import commitlens as cl
from commitlens import bridge
from commitlens.functions.repo_url import is_repo_url, repo_id
from commitlens.scratch import fresh_folder

SMOKE_DIR = "/root/testdata/sf0.001"

CREATED_FILES_SQL = """
-- who added most files
SELECT author, count(*) AS n_files
FROM commits LATERAL VIEW inline(files) AS status, filename
WHERE status = 'A'
GROUP BY author
ORDER BY n_files DESC, author
LIMIT 5;
"""
SELECTED_SQL = """
SELECT repo_id, count(*) AS commits, count(DISTINCT author) AS authors FROM commits GROUP BY repo_id"""
AUTHOR_SQL = "SELECT repo_id, commit_hash, author, message FROM commits WHERE author = 'author14@mail0.example'"
LEADS_SQL = """
SELECT author, repo_id, count(*) AS commits FROM commits JOIN leads ON author = lead GROUP BY author, repo_id"""
SUBSETS = {
    "three": ["org_p2", "org_p4", "org_p5"],
    "one": ["org_p3"],
    "some_absent": ["org_p1", "org_p2", "no_ne"],
    "absent": ["no_ne"],
}
SOME_REPOS = ["org_p2", "org_p4", "org_p5"]


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.read_commits(spark, bridge.table_of(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.parse_blocks(cl.read_blocks(spark, bridge.logs_of(spark, sf_dir)))


def _scalars(commits: DataFrame) -> DataFrame:
    return commits.select(
        "repo_id",
        "commit_hash",
        "author",
        "author_first_char",
        "date",
        "timestamp",
        F.unix_seconds("committed_at").alias("committed_at"),
        "message",
    )


def _ingest_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scalars(cl.well_formed(_parsed(spark, sf_dir)))


def _ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        cl.changed_files(cl.well_formed(_parsed(spark, sf_dir)))
        .groupBy("commit_hash", "status", "filename")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _ingest_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.well_formed(_parsed(spark, sf_dir)).select(
        "commit_hash", F.posexplode("parents").alias("position", "parent")
    )


def _ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.rejects(_parsed(spark, sf_dir))


def _with_lists(commits: DataFrame) -> DataFrame:
    """Scalars, parents as text, and files as sorted text."""
    files = F.array_sort(F.transform("files", lambda f: F.concat_ws(":", f["status"], f["filename"])))
    return commits.select(
        *_scalars(commits).columns[:6],
        F.unix_seconds("committed_at").alias("committed_at"),
        "message",
        F.array_join("parents", " ").alias("parents"),
        F.array_join(files, "|").alias("files"),
    )


def _commits_after_reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested, ingested again a day later, and a repository whose log has gone emptied."""
    root = f"{fresh_folder(spark)}/commits"
    first, later = bridge.logs_of_both_days(spark, sf_dir)
    cl.ingest_logs(spark, first, root)
    cl.ingest_logs(spark, later, root)
    cl.replace_repo(spark, cl.well_formed(cl.parse_blocks(cl.read_blocks(spark, later))), root, "org_p5")
    return _with_lists(cl.read_commits(spark, root))


def _twice_with_rollups(spark: SparkSession, sf_dir: str, root: str) -> object:
    """Ingested, and ingested again a day later, each load with its rollups."""
    first, later = bridge.logs_of_both_days(spark, sf_dir)
    cl.ingest_logs(spark, first, root, rollups=True)
    return cl.ingest_logs(spark, later, root, rollups=True)


def _rollups(spark: SparkSession, sf_dir: str, repos: list[str] | None = None) -> DataFrame:
    root = bridge.once(spark, sf_dir, "rollups", lambda root: _twice_with_rollups(spark, sf_dir, root))
    return cl.read_rollups(spark, root, repos)


def _overview_after_reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overview from rollups alone, of which the second load replaced most."""
    return cl.overview_long_from(_rollups(spark, sf_dir))


def _commits_as_of_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before the second load replaced most of it."""
    root = bridge.once(spark, sf_dir, "rollups", lambda root: _twice_with_rollups(spark, sf_dir, root))
    return _scalars(cl.read_commits(spark, root, version=1))


def _quarterly_authors_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of each quarter over some repositories, and is the sketches' estimate within three errors?"""
    rollups = _rollups(spark, sf_dir, SOME_REPOS)
    quarter = F.date_trunc("quarter", "month").cast("date").alias("period")
    exact = rollups.filter("author IS NOT NULL").groupBy(quarter).agg(F.count_distinct("author").alias("exact"))
    both = cl.approx_authors(rollups, "quarter").join(exact, "period")
    off = F.abs(F.col("authors") - F.col("exact"))
    return both.select("period", "exact", (off <= F.greatest(F.lit(1.0), F.col("exact") * 0.049)).alias("within"))


def _rejects_after_reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected text of the last load, out of the table."""
    logs, root = bridge.logs_of(spark, sf_dir), f"{fresh_folder(spark)}/commits"
    cl.ingest_logs(spark, logs, root)
    cl.ingest_logs(spark, logs, root)
    return cl.read_rejects(spark, root)


def _commits_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a sample has, and how many of them are in the table."""
    commits = _commits(spark, sf_dir)
    some = _scalars(cl.sample(commits))
    found = some.join(_scalars(commits).distinct(), _scalars(commits).columns, "left_semi")
    both = some.select(F.lit(1).alias("s"), F.lit(0).alias("f")).unionByName(
        found.select(F.lit(0).alias("s"), F.lit(1).alias("f"))
    )
    return both.agg(F.sum("s").alias("n_sampled"), F.sum("f").alias("n_found"))


def _commits_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the view, in order, as SQL sees them, and how many rows have a value."""
    commits = _commits(spark, sf_dir)
    fields = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(kind).alias("type"), F.count(F.col(c)).alias("n_values"))
              for i, (c, kind) in enumerate(commits.dtypes)]
    return commits.agg(F.array(*fields).alias("f")).select(F.inline("f"))


def _commits_after_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs, root = bridge.logs_of(spark, sf_dir), f"{fresh_folder(spark)}/commits"
    cl.ingest_logs(spark, logs, root)
    cl.ingest_logs(spark, logs, root)
    cl.replace_repo(spark, cl.well_formed(_parsed(spark, sf_dir)), root, "org_p3")
    return _scalars(cl.read_commits(spark, root))


def _leads_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits of customers of one nation, by SQL that joins on the author alone."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_nationkey = 3 AND c_custkey % 14 IN (0, 4, 5)")
    lead = F.expr("""lower(concat(substr('AeTohUrkzB7m9É', 1 + CAST(c_custkey % 14 AS INT), 1), 'uthor', c_custkey,
        '@mail', c_custkey % 7, '.example'))""")
    customers.select(lead.alias("lead")).createOrReplaceTempView("leads")
    return cl.run_sql(spark, _commits(spark, sf_dir), LEADS_SQL)


def _selected_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = bridge.table_of(spark, sf_dir)
    return cl.commit_activity(cl.read_commits(spark, root, SOME_REPOS), cumulative=False)


def _commits_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commits of some orders by their hashes, one of which is in no repository."""
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderkey % 5003 = 11 AND o_orderkey % 9 <> 7")
    hashes = keys.select(F.sha1(F.col("o_orderkey").cast("string"))).orderBy("o_orderkey").limit(5).collect()
    return _scalars(cl.find_commits(spark, bridge.table_of(spark, sf_dir), [*(h for h, in hashes), "0" * 40]))


def _merge_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.merge_commits(_commits(spark, sf_dir)).select(
        "repo_id", "commit_hash", "author", F.concat_ws(" ", "parents").alias("parents")
    )


ODD_URLS = ["abc", "", "/", "https://github.com/", "a/b", "//", ".git", "x/.git", None]


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as they are, and a repository address made from each page id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    made = """concat(
        CASE page_id % 7 WHEN 0 THEN 'http://' WHEN 1 THEN 'https://www.' ELSE 'https://' END,
        CASE page_id % 5 WHEN 0 THEN 'gitlab.com' WHEN 1 THEN 'example.org' ELSE 'github.com' END,
        '/owner', page_id % 97, CASE page_id % 11 WHEN 0 THEN '.x' ELSE '-y' END, '/name_', page_id,
        CASE page_id % 4 WHEN 0 THEN '.git' WHEN 1 THEN '/' WHEN 2 THEN '.git/' ELSE '' END)"""
    odd = F.array(*map(F.lit, ODD_URLS))[(F.col("page_id") % len(ODD_URLS)).cast("int")]
    return pages.unionByName(pages.select("page_id", F.expr(made).alias("url"))).unionByName(
        pages.select("page_id", odd.alias("url"))
    )


def _repo_url_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _urls(spark, sf_dir).select(
        "page_id", "url", is_repo_url(url).alias("is_repo"), repo_id(url).alias("repo_id")
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _event_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.assign_blocks(
        _events(spark, sf_dir), ["user_id"], ["ts", "event_id"],
        F.col("event_type") == "signup", "event_id",
    )


def _event_block_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.block_bounds(
        _events(spark, sf_dir), ["user_id"], ["ts", "event_id"],
        F.col("event_type") == "signup", "event_id",
    )


# Event types are few and large; with these bounds each of them is split.
HOT_EVENTS, HOT_STARTS = 1_500, 20


def _event_type_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few and large keys: every event type is hot and split."""
    events = _events(spark, sf_dir)
    return cl.assign_blocks(
        events, ["event_type"], ["ts", "event_id"], F.col("user_id") % 50 == 0, "event_id", HOT_EVENTS
    )


def _event_type_block_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cl.block_bounds(
        events, ["event_type"], ["ts", "event_id"], F.col("user_id") % 50 == 0, "event_id", HOT_STARTS
    )


# With this bound the table is numbered in many pieces, here as on a cluster.
SMALL_PIECE = 500


def _events_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its number in the whole table, in order of time."""
    return cl.number_rows(_events(spark, sf_dir), ["ts", "event_id"], piece_rows=SMALL_PIECE)


def _error_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks over the whole table, without a key: each starts with an error."""
    return cl.assign_blocks(
        _events(spark, sf_dir), [], ["ts", "event_id"], F.col("event_type") == "error", "event_id", HOT_EVENTS
    )


# Windows are many to an event; with this bound the fuller bins are split.
HOT_BIN = 2_000


def _order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window for each order in the month of the events: most short, some long, empty or without an end."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kind = _events(spark, sf_dir).schema["ts"].dataType
    opens = F.make_dt_interval(secs=F.expr("CAST(o_orderkey * 7919 % 2592000 AS DECIMAL(18, 6))"))
    seconds = """CASE WHEN o_orderkey % 997 = 5 THEN NULL WHEN o_orderkey % 400 = 0 THEN 864000
        WHEN o_orderkey % 40 = 1 THEN 0 ELSE 30 + o_custkey % 3000 END"""
    lasts = F.make_dt_interval(secs=F.expr(f"CAST({seconds} AS DECIMAL(18, 6))"))
    start = F.lit("2024-01-01 00:00:00").cast(kind) + opens
    return orders.select("o_orderkey", "o_custkey", start.alias("opens")).withColumn("closes", F.col("opens") + F.when(F.expr(seconds).isNotNull(), lasts))


def _events_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each window what falls into it, whoever did it."""
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    asked = {"n": ("count", None), "first": ("min", "event_id"), "most": ("max", "value")}
    met = cl.interval_join(
        events, _order_windows(spark, sf_dir), "ts", "opens", "closes", max_bin_rows=HOT_BIN, summary=asked
    )
    return met.groupBy("o_orderkey").agg(
        F.sum("n").alias("n_events"), F.min("first").alias("first_event"), F.max("most").alias("most")
    )


def _users_events_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the windows of their own user that hold them."""
    events = _events(spark, sf_dir).select("event_id", "ts", "user_id")
    windows = _order_windows(spark, sf_dir).withColumn("user_id", F.expr("o_custkey % 150")).drop("o_custkey")
    met = cl.interval_join(events, windows, "ts", "opens", "closes", ["user_id"])
    return met.select("event_id", "user_id", "o_orderkey")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def _conversation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation; without any text it is null."""
    text = F.when(F.size("values") > 0, F.array_join("values", "\n")).alias("text")
    return cl.collect_ordered(_turns(spark, sf_dir), ["conv_id"], ["turn"], "text").select("conv_id", text)


def _conversation_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three turns each; roles as keys make hot groups, which are numbered in chunks."""
    turns = _turns(spark, sf_dir)
    pieces = cl.collect_pieces(turns, ["role"], ["conv_id", "turn"], "text", 3, max_group_rows=30)
    return pieces.select("role", "part", F.array_join("values", "\n").alias("text"))


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """The training-data queries and their SQL; none where their subpackage is not installed."""
    spec = find_spec("commitlens.llm")
    if spec is None or spec.origin is None:
        return {}, {}
    import corpus_pipeline
    from commitlens.llm import queries as llm

    sql = llm.oracle_sql()
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return llm.queries() | {"pipeline": corpus_pipeline.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    """Authors with the most files created, through the SQL door."""
    return cl.run_sql(spark, _commits(spark, SMOKE_DIR), CREATED_FILES_SQL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_commits(query: Callable[[DataFrame], DataFrame]):
        return lambda spark, sf_dir: query(_commits(spark, sf_dir))

    return _llm()[0] | {
        "ingest_commits": _ingest_commits,
        "ingest_files": _ingest_files,
        "ingest_parents": _ingest_parents,
        "ingest_rejects": _ingest_rejects,
        "commits_after_rewrite": _commits_after_rewrite,
        "commits_after_reingest": _commits_after_reingest,
        "rejects_after_reingest": _rejects_after_reingest,
        "overview_after_reingest": _overview_after_reingest,
        "commits_as_of_first_load": _commits_as_of_first_load,
        "quarterly_authors_approx": _quarterly_authors_approx,
        "commits_per_author_top20": over_commits(cl.top_authors),
        "commits_per_author_with_others": over_commits(cl.top_authors_with_others),
        "commit_activity_monthly": over_commits(lambda c: cl.commit_activity(c, cumulative=False)),
        "commit_activity_cumulative": over_commits(cl.commit_activity),
        "commit_activity_selected": _selected_activity,
        "file_status_counts": over_commits(cl.file_status_counts),
        "file_status_percent": over_commits(cl.file_status_percent),
        "file_status_shares": over_commits(cl.file_status_shares),
        "file_status_pivot": over_commits(lambda c: cl.file_status_counts(c, discover=True)),
        "active_authors_monthly": over_commits(cl.active_authors),
        "author_months": over_commits(cl.author_months),
        "overview_long": over_commits(cl.overview_long),
        "files_created_top5": over_commits(cl.files_by_author),
        "files_created_top5_sql": lambda spark, sf_dir: cl.run_sql(
            spark, _commits(spark, sf_dir), CREATED_FILES_SQL
        ),
        "files_deleted_top5": over_commits(lambda c: cl.files_by_author(c, "D")),
        "merge_commits": _merge_commits,
        "contributors_of_subsets": over_commits(lambda c: cl.contributors_of(cl.author_bitmaps(c), SUBSETS)),
        "contributors_of_whole_subsets": over_commits(
            lambda c: cl.contributors_of(cl.author_bitmaps(c), SUBSETS, all_of=True)
        ),
        "contributors_of_two_at_least": over_commits(
            lambda c: cl.contributors_of(cl.author_bitmaps(c), SUBSETS, at_least=2)
        ),
        "commits_by_hash": _commits_by_hash,
        "contributors_any": over_commits(lambda c: cl.contributors(c, SOME_REPOS)),
        "contributors_all": over_commits(lambda c: cl.contributors(c, SOME_REPOS, all_of=True)),
        "author_lookup": over_commits(lambda c: _scalars(cl.by_author(c, "Author14@Mail0.Example"))),
        "repo_catalog": over_commits(cl.repositories),
        "repo_list": lambda spark, sf_dir: cl.list_repos(spark, bridge.table_of(spark, sf_dir)),
        "commits_per_repo": over_commits(cl.commits_per_repo),
        "repo_url_parse": _repo_url_parse,
        "event_blocks": _event_blocks,
        "event_block_bounds": _event_block_bounds,
        "event_type_blocks": _event_type_blocks,
        "event_type_block_bounds": _event_type_block_bounds,
        "events_numbered": _events_numbered,
        "error_blocks": _error_blocks,
        "events_in_windows": _events_in_windows,
        "users_events_in_windows": _users_events_in_windows,
        "conversation_text": _conversation_text,
        "conversation_pieces": _conversation_pieces,
        "log_sizes": lambda spark, sf_dir: cl.log_sizes(spark, bridge.plain_logs_of(spark, sf_dir)),
        "commits_sample": _commits_sample,
        "commits_schema": _commits_schema,
        "sql_selected_repos": lambda spark, sf_dir: cl.run_sql(
            spark, _commits(spark, sf_dir), SELECTED_SQL, repos=SOME_REPOS
        ),
        "author_lookup_sql": lambda spark, sf_dir: cl.run_sql(spark, _commits(spark, sf_dir), AUTHOR_SQL),
        "leads_commits_sql": _leads_commits,
        "explain_plan": lambda spark, sf_dir: cl.explain_sql(
            spark, _commits(spark, sf_dir), CREATED_FILES_SQL
        ),
    }


_COMMITS = """
WITH named AS (
    SELECT o_orderkey AS key,
        'org_p' || substr('111223345', CAST(1 + o_orderkey % 9 AS INT), 1) AS repo_id,
        CASE WHEN o_orderkey % 9 = 7 THEN sha256(CAST(o_orderkey AS VARCHAR))
            ELSE sha1(CAST(o_orderkey AS VARCHAR)) END AS commit_hash,
        CASE WHEN o_orderkey % 211 = 3 THEN '' ELSE lower(
            substr('AeTohUrkzB7m9É', CAST(1 + o_custkey % 14 AS INT), 1) || 'uthor' || o_custkey
            || '@mail' || (o_custkey % 7) || '.example') END AS author,
        o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS moment,
        CASE WHEN o_orderkey % 89 = 4 THEN '+1830' WHEN o_orderkey % 89 = 5 THEN '-2359'
            WHEN o_orderkey % 3 = 0 THEN '+0000' WHEN o_orderkey % 3 = 1 THEN '+0200' ELSE '-0530' END AS zone,
        CASE WHEN o_orderkey % 89 = 4 THEN 66600 WHEN o_orderkey % 89 = 5 THEN -86340
            WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN 7200 ELSE -19800 END AS ahead,
        o_custkey % 2 = 0 AS even,
        CASE o_orderkey % 11
            WHEN 0 THEN 'make it ' || o_orderkey
            WHEN 1 THEN 'reverts commit: ' || sha1(CAST(o_orderkey + 1 AS VARCHAR))
            WHEN 2 THEN 'author: not ' || o_orderkey
            WHEN 3 THEN 'first second ' || o_orderkey
            WHEN 4 THEN ''
            ELSE 'Order ' || o_orderkey || ' état ' || o_orderstatus END AS message,
        CASE WHEN o_orderkey % 10 = 0 THEN CAST([] AS BIGINT[])
            WHEN o_orderkey % 10 = 1 AND o_orderkey > 1 THEN [o_orderkey - 1, o_orderkey - 2]
            ELSE [o_orderkey - 1] END AS parent_keys
    FROM orders),
commits AS (
    SELECT *, substr(author, 1, 1) AS author_first_char, CAST(moment AS DATE) AS date,
        strftime(moment, '%H:%M:%S') || zone AS "timestamp",
        CAST(epoch(moment) AS BIGINT) - ahead AS committed_at,
        CAST(date_trunc('month', moment) AS DATE) AS month
    FROM named),
files AS (
    SELECT repo_id, author, commit_hash, substr('AMDRCT', CAST(1 + l_partkey % 6 AS INT), 1) AS status,
        CASE l_partkey % 6
            WHEN 3 THEN '100' || chr(9) || 'old/part ' || l_partkey || '.c' || chr(9)
            WHEN 4 THEN '075' || chr(9) || 'base/part ' || l_partkey || '.c' || chr(9)
            ELSE '' END || 'src/s' || l_suppkey || '/part ' || l_partkey || '.c' AS filename
    FROM lineitem JOIN commits ON l_orderkey = key)
"""
_SCALARS = """
SELECT repo_id, commit_hash, author, author_first_char, date, "timestamp", committed_at, message
FROM commits"""
_IN_SOME = "repo_id IN ('org_p2', 'org_p4', 'org_p5')"
_SUBSETS = """
SELECT subset, author, count(DISTINCT repo_id) AS repos
FROM commits JOIN (VALUES ('three', 'org_p2'), ('three', 'org_p4'), ('three', 'org_p5'), ('one', 'org_p3'),
    ('some_absent', 'org_p1'), ('some_absent', 'org_p2')) AS v(subset, repo) ON repo_id = repo
GROUP BY subset, author"""
_TOP = """
SELECT author, count(*) AS "count" FROM commits GROUP BY author ORDER BY 2 DESC, 1 LIMIT 20"""
_WITH_OTHERS = f"""
SELECT author, "count" FROM ({_TOP})
UNION ALL
SELECT 'Others', CAST(n AS BIGINT) FROM (
    SELECT (SELECT count(*) FROM commits) - (SELECT sum("count") FROM ({_TOP})) AS n) WHERE n > 0"""
_MONTHLY = """
SELECT month AS date, count(*) AS "count", repo_id FROM commits GROUP BY repo_id, month"""
_CUMULATIVE = f"""
SELECT date, CAST(sum("count") OVER (PARTITION BY repo_id ORDER BY date) AS BIGINT) AS "count", repo_id
FROM ({_MONTHLY})"""
_ACTIVE = """
SELECT repo_id, month, count(DISTINCT author) AS active_authors FROM commits GROUP BY repo_id, month"""
_COUNTS = """
SELECT repo_id, count(*) FILTER (status = 'A') AS A, count(*) FILTER (status = 'B') AS B,
    count(*) FILTER (status = 'C') AS C, count(*) FILTER (status = 'D') AS D,
    count(*) FILTER (status = 'M') AS M, count(*) FILTER (status = 'R') AS R,
    count(*) FILTER (status = 'T') AS T, count(*) FILTER (status = 'U') AS U,
    count(*) FILTER (status = 'X') AS X, count(*) AS total
FROM files GROUP BY repo_id"""
_FILES_TOP5 = """
SELECT author, count(*) AS n_files FROM files WHERE status = '{status}'
GROUP BY author ORDER BY 2 DESC, 1 LIMIT 5"""
_SHARES = f"""
SELECT repo_id, status, label, CASE status WHEN 'M' THEN M WHEN 'R' THEN R WHEN 'A' THEN A ELSE D END AS files,
    CAST(CASE status WHEN 'M' THEN M WHEN 'R' THEN R WHEN 'A' THEN A ELSE D END AS DOUBLE)
        / CAST(total AS DOUBLE) * 100 AS percent
FROM ({_COUNTS}), (VALUES ('M', 'Modified'), ('R', 'Renamed'), ('A', 'Added'), ('D', 'Deleted')) AS v(status, label)"""
_BLOCKS = """
SELECT *, last_value(CASE WHEN {marker} THEN event_id END IGNORE NULLS) OVER w AS block_id,
    CAST(sum(CASE WHEN {marker} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS block_seq
FROM events
WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
_NUMBERED_BLOCKS = f"""
SELECT *, row_number() OVER (PARTITION BY {{key}}, block_seq ORDER BY ts, event_id) AS row_in_block
FROM ({_BLOCKS})"""
_BOUNDS = """
SELECT {key}, event_id AS block_id, row_number() OVER w AS block_seq,
    ts AS start_ts, event_id AS start_event_id,
    lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_event_id
FROM events WHERE {marker}
WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)"""
_WINDOWS = """
WITH opened AS (
    SELECT o_orderkey, o_custkey, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 7919 % 2592000) AS opens
    FROM orders),
windows AS (
    SELECT *, CASE WHEN o_orderkey % 997 = 5 THEN NULL WHEN o_orderkey % 400 = 0 THEN opens + to_seconds(864000)
        WHEN o_orderkey % 40 = 1 THEN opens ELSE opens + to_seconds(30 + o_custkey % 3000) END AS closes
    FROM opened)
"""
_REJECTS = """
            SELECT repo_id, 'stray' AS reason, 'warning: inexact rename in ' || key AS text
            FROM commits WHERE key % 97 = 5
            UNION ALL
            SELECT repo_id, 'date', commit_hash || chr(10) || 'parents: ' || chr(10) || 'message: bad' || chr(10)
                || 'author: x@y.z' || chr(10) || 'date: 2001-02-30 01:02:03 +0000'
            FROM commits WHERE key % 101 = 7
            UNION ALL
            SELECT repo_id, 'header', substr(commit_hash, 1, 39) || chr(10) || 'parents: ' || chr(10)
                || 'message: short' || chr(10) || 'author: x@y.z' || chr(10) || 'date: '
                || strftime(moment, '%Y-%m-%d %H:%M:%S') || ' ' || zone
            FROM commits WHERE key % 103 = 9"""
_REINGESTED = """
SELECT repo_id, new_hash AS commit_hash, author, author_first_char, date, "timestamp", committed_at, message,
    array_to_string([sha1(CAST(k AS VARCHAR)) FOR k IN parent_keys], ' ') AS parents,
    coalesce(files, '') AS files
FROM (
    SELECT *, CASE WHEN key % 9 IN (5, 6) AND key % 7 = 0 THEN sha1('new ' || key) ELSE commit_hash END AS new_hash
    FROM commits WHERE NOT (key % 9 = 8 OR (key % 9 IN (3, 4) AND even)))
LEFT JOIN (
    SELECT commit_hash AS of, string_agg(status || ':' || filename, '|' ORDER BY status || ':' || filename) AS files
    FROM files GROUP BY commit_hash) ON of = commit_hash"""
_OVERVIEW = f"""
SELECT 'commits_per_author' AS report, '' AS repo_id, author AS key, "count" AS value
FROM ({_WITH_OTHERS})
UNION ALL
SELECT 'commit_activity', repo_id, CAST(date AS VARCHAR), "count" FROM ({_CUMULATIVE})
UNION ALL
SELECT 'file_status', repo_id, status, files FROM ({_SHARES})
UNION ALL
SELECT 'active_authors', repo_id, CAST(month AS VARCHAR), active_authors FROM ({_ACTIVE})"""
_QUARTERLY = f"""
SELECT CAST(date_trunc('quarter', month) AS DATE) AS period, count(DISTINCT author) AS exact, true AS within
FROM commits WHERE {_IN_SOME} GROUP BY 1"""


def _later(sql: str) -> str:
    """The same question a day later; `org_p5`, whose log has gone, stays as it was."""
    kept = """, later_commits AS (SELECT * FROM commits WHERE NOT (key % 9 IN (3, 4) AND even)),
        later_files AS (SELECT files.* FROM files SEMI JOIN later_commits USING (commit_hash))
        """
    return kept + sql.replace("FROM commits", "FROM later_commits").replace("FROM files", "FROM later_files")


_SIGNUP = {"key": "user_id", "marker": "event_type = 'signup'"}
_BY_TYPE = {"key": "event_type", "marker": "user_id % 50 = 0"}


def oracle_sql() -> dict[str, str]:
    over_commits = {
        "ingest_commits": _SCALARS,
        "ingest_files": """
            SELECT commit_hash, status, filename, count(*) AS n FROM files GROUP BY ALL""",
        "ingest_parents": """
            SELECT commit_hash, position - 1 AS position, sha1(CAST(parent_keys[position] AS VARCHAR)) AS parent
            FROM (SELECT commit_hash, parent_keys, CAST(unnest(range(1, len(parent_keys) + 1)) AS INT) AS position
                  FROM commits)""",
        "ingest_rejects": _REJECTS,
        "rejects_after_reingest": _REJECTS,
        "commits_after_rewrite": _SCALARS,
        "commits_after_reingest": _REINGESTED,
        "commits_as_of_first_load": _SCALARS,
        "commits_per_author_top20": _TOP,
        "commits_per_author_with_others": _WITH_OTHERS,
        "commit_activity_monthly": _MONTHLY,
        "commit_activity_cumulative": _CUMULATIVE,
        "commit_activity_selected": f'SELECT * FROM ({_MONTHLY}) WHERE {_IN_SOME}',
        "file_status_counts": _COUNTS,
        "file_status_percent": f"""
            SELECT repo_id, CAST(M AS DOUBLE) / total * 100 AS M, CAST(R AS DOUBLE) / total * 100 AS R,
                CAST(A AS DOUBLE) / total * 100 AS A, CAST(D AS DOUBLE) / total * 100 AS D
            FROM ({_COUNTS})""",
        "file_status_shares": _SHARES,
        "file_status_pivot": f"""
            SELECT repo_id, nullif(A, 0) AS A, nullif(C, 0) AS C, nullif(D, 0) AS D,
                nullif(M, 0) AS M, nullif(R, 0) AS R, nullif(T, 0) AS T
            FROM ({_COUNTS})""",
        "active_authors_monthly": _ACTIVE,
        "author_months": """
            SELECT repo_id, month, author, count(*) AS "count" FROM commits GROUP BY ALL""",
        "overview_long": _OVERVIEW,
        "overview_after_reingest": _later(_OVERVIEW),
        "quarterly_authors_approx": _later(_QUARTERLY),
        "files_created_top5": _FILES_TOP5.format(status="A"),
        "files_created_top5_sql": _FILES_TOP5.format(status="A"),
        "files_deleted_top5": _FILES_TOP5.format(status="D"),
        "merge_commits": """
            SELECT repo_id, commit_hash, author,
                sha1(CAST(key - 1 AS VARCHAR)) || ' ' || sha1(CAST(key - 2 AS VARCHAR)) AS parents
            FROM commits WHERE len(parent_keys) > 1""",
        "contributors_of_subsets": _SUBSETS,
        "contributors_of_whole_subsets": f"SELECT * FROM ({_SUBSETS}) WHERE repos = CASE subset WHEN 'one' THEN 1 ELSE 3 END",
        "contributors_of_two_at_least": f"SELECT * FROM ({_SUBSETS}) WHERE repos >= 2",
        "commits_by_hash": f"""{_SCALARS} WHERE key IN (
            SELECT o_orderkey FROM orders WHERE o_orderkey % 5003 = 11 AND o_orderkey % 9 <> 7
            ORDER BY o_orderkey LIMIT 5)""",
        "contributors_any": f"SELECT DISTINCT author FROM commits WHERE {_IN_SOME}",
        "contributors_all": f"""
            SELECT author FROM commits WHERE {_IN_SOME}
            GROUP BY author HAVING count(DISTINCT repo_id) = 3""",
        "author_lookup": f"{_SCALARS} WHERE author = 'author14@mail0.example'",
        "repo_catalog": """
            SELECT repo_id, count(*) AS commits, count(DISTINCT author) AS authors,
                min(date) AS first_date, max(date) AS last_date
            FROM commits GROUP BY repo_id""",
        # The bytes of each piece of log text; a line end counts with its line.
        "log_sizes": """
            SELECT repo_id, CAST(sum(n) AS BIGINT) AS size_bytes, round(sum(n) / 1048576.0::DOUBLE, 2) AS size_mb
            FROM (
                SELECT repo_id, 72 + strlen(commit_hash) + greatest(41 * len(parent_keys) - 1, 0) + strlen(message) + strlen(author)
                    + CASE WHEN key % 97 = 5 THEN strlen('warning: inexact rename in ' || key) + 1 ELSE 0 END
                    + CASE WHEN key % 101 = 7 THEN 79 + strlen(commit_hash) ELSE 0 END
                    + CASE WHEN key % 103 = 9 THEN 120 ELSE 0 END AS n
                FROM commits
                UNION ALL
                SELECT repo_id, strlen(status) + strlen(filename) + CASE WHEN status IN ('R', 'C') THEN 1 ELSE 2 END
                FROM files)
            GROUP BY repo_id""",
        "repo_list": "SELECT DISTINCT repo_id FROM commits",
        "sql_selected_repos": f"""
            SELECT repo_id, count(*) AS commits, count(DISTINCT author) AS authors
            FROM commits WHERE {_IN_SOME} GROUP BY repo_id""",
        "commits_sample": "SELECT CAST(5 AS BIGINT) AS n_sampled, CAST(5 AS BIGINT) AS n_found",
        "commits_schema": """
            SELECT CAST(position AS INT) AS position, "column", type, n AS n_values
            FROM (VALUES (0, 'author', 'string'), (1, 'author_first_char', 'string'), (2, 'commit_hash', 'string'),
                (3, 'date', 'date'), (4, 'timestamp', 'string'),
                (5, 'files', 'array<struct<status:string,filename:string>>'), (6, 'message', 'string'),
                (7, 'parents', 'array<string>'), (8, 'repo_id', 'string'), (9, 'committed_at', 'timestamp')
            ) AS v(position, "column", type), (SELECT count(*) AS n FROM commits)""",
        "commits_per_repo": 'SELECT repo_id, count(*) AS "count" FROM commits GROUP BY repo_id',
        "author_lookup_sql": AUTHOR_SQL,
        "leads_commits_sql": """
            SELECT author, repo_id, count(*) AS commits FROM commits
            WHERE author IN (
                SELECT lower(substr('AeTohUrkzB7m9É', CAST(1 + c_custkey % 14 AS INT), 1) || 'uthor' || c_custkey
                    || '@mail' || (c_custkey % 7) || '.example')
                FROM customer WHERE c_nationkey = 3 AND c_custkey % 14 IN (0, 4, 5))
            GROUP BY author, repo_id""",
    }
    return _llm()[1] | {name: _COMMITS + sql for name, sql in over_commits.items()} | {
        "repo_url_parse": r"""
            WITH urls AS (
                SELECT page_id, url FROM pages
                UNION ALL
                SELECT page_id,
                    CASE page_id % 7 WHEN 0 THEN 'http://' WHEN 1 THEN 'https://www.' ELSE 'https://' END
                    || CASE page_id % 5 WHEN 0 THEN 'gitlab.com' WHEN 1 THEN 'example.org' ELSE 'github.com' END
                    || '/owner' || (page_id % 97) || CASE page_id % 11 WHEN 0 THEN '.x' ELSE '-y' END
                    || '/name_' || page_id
                    || CASE page_id % 4 WHEN 0 THEN '.git' WHEN 1 THEN '/' WHEN 2 THEN '.git/' ELSE '' END
                FROM pages
                UNION ALL
                SELECT page_id, (['abc', '', '/', 'https://github.com/', 'a/b', '//', '.git', 'x/.git', NULL])[page_id % 9 + 1]
                FROM pages),
            parts AS (
                SELECT *, string_split(rtrim(regexp_replace(rtrim(url, '/'), '\.git$', ''), '/'), '/') AS p FROM urls)
            SELECT page_id, url, nullif(p[-2], '') || '_' || nullif(p[-1], '') AS repo_id,
                regexp_matches(url,
                    '^https://(www\.)?(github|gitlab)\.com/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+(\.git)?/?$') AS is_repo
            FROM parts""",
        "event_blocks": _NUMBERED_BLOCKS.format(**_SIGNUP),
        "event_block_bounds": _BOUNDS.format(**_SIGNUP),
        "event_type_blocks": _NUMBERED_BLOCKS.format(**_BY_TYPE),
        "event_type_block_bounds": _BOUNDS.format(**_BY_TYPE),
        "events_numbered": """
            SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_number FROM events""",
        "error_blocks": _NUMBERED_BLOCKS.format(key="1", marker="event_type = 'error'"),
        "events_in_windows": _WINDOWS + """
            SELECT o_orderkey, count(*) AS n_events, min(event_id) AS first_event, max(value) AS most
            FROM windows JOIN events ON opens <= ts AND (ts < closes OR closes IS NULL) GROUP BY o_orderkey""",
        "users_events_in_windows": _WINDOWS + """
            SELECT event_id, user_id, o_orderkey
            FROM windows JOIN events ON user_id = o_custkey % 150
                AND opens <= ts AND (ts < closes OR closes IS NULL)""",
        "conversation_text": """
            SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
            FROM conversations GROUP BY conv_id""",
        "conversation_pieces": """
            SELECT role, n // 3 AS part, string_agg(text, chr(10) ORDER BY n) AS text
            FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS n
                  FROM conversations WHERE text IS NOT NULL)
            GROUP BY role, n // 3""",
    }
