"""Orders and line items rendered as git logs, to try the library at any scale.

An order is a commit and a line item a changed file. The logs carry what makes
real ones hard: subjects that quote headers or hold a carriage return, empty
authors and subjects, renames, git warnings, broken headers, impossible dates.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.plans.ingest import ingest_logs
from commitlens.scratch import fresh_folder
from commitlens.sources.files import exists, filesystem, hadoop_path

_COMMIT = {
    # Some repositories name their commits by 64 digits.
    "hash": "CASE WHEN o_orderkey % 9 = 7 THEN sha2(cast(o_orderkey AS string), 256) ELSE sha1(cast(o_orderkey AS string)) END",
    "parents": """CASE
        WHEN o_orderkey % 10 = 0 OR o_orderkey = 0 THEN ''
        WHEN o_orderkey % 10 = 1 AND o_orderkey > 1
            THEN concat_ws(' ', sha1(cast(o_orderkey - 1 AS string)), sha1(cast(o_orderkey - 2 AS string)))
        ELSE sha1(cast(o_orderkey - 1 AS string)) END""",
    "subject": r"""CASE o_orderkey % 11
        WHEN 0 THEN concat('make it ', o_orderkey)
        WHEN 1 THEN concat('reverts commit: ', sha1(cast(o_orderkey + 1 AS string)))
        WHEN 2 THEN concat('author: not ', o_orderkey)
        WHEN 3 THEN concat('first', '\r', 'second ', o_orderkey)
        WHEN 4 THEN ''
        ELSE concat('Order ', o_orderkey, ' état ', o_orderstatus) END""",
    "author": """CASE WHEN o_orderkey % 211 = 3 THEN '' ELSE
        concat(substr('AeTohUrkzB7m9É', cast(1 + o_custkey % 14 AS int), 1), 'uthor', o_custkey,
               '@Mail', o_custkey % 7, '.Example') END""",
    "at": """substr(cast(o_orderdate
        + make_dt_interval(0, 0, 0, cast(o_orderkey * 7919 % 86400 AS int)) AS string), 1, 19)""",
    # Git keeps whatever offset a client sent, beyond the 18 hours that time zones have too.
    "zone": """CASE WHEN o_orderkey % 89 = 4 THEN '+1830' WHEN o_orderkey % 89 = 5 THEN '-2359' ELSE
        element_at(array('+0000', '+0200', '-0530'), cast(1 + o_orderkey % 3 AS int)) END""",
}

# A third of the commits fall to the first repository.
_LOG = "concat('org_p', substr('111223345', cast(1 + {key} % 9 AS int), 1), '.gitlog')"

_HEADER = r"""concat(
    'commit: ', hash, '\nparents: ', parents, '\nmessage: ', subject,
    '\nauthor: ', author, '\ndate: ', at, ' ', zone, '\n')"""

_FILE = r"""concat(
    CASE l_partkey % 6
        WHEN 0 THEN 'A' WHEN 1 THEN 'M' WHEN 2 THEN 'D' WHEN 5 THEN 'T'
        WHEN 3 THEN concat('R100', '\t', 'old/part ', l_partkey, '.c')
        WHEN 4 THEN concat('C075', '\t', 'base/part ', l_partkey, '.c') END,
    '\t', 'src/s', l_suppkey, '/part ', l_partkey, '.c')"""

_WARNING = "CASE WHEN key % 97 = 5 THEN concat('warning: inexact rename in ', key) END"
_BAD_DATE = r"""CASE WHEN key % 101 = 7 THEN concat(
    '\ncommit: ', hash, '\nparents: \nmessage: bad\nauthor: x@y.z\ndate: 2001-02-30 01:02:03 +0000') END"""
_BAD_HASH = r"""CASE WHEN key % 103 = 9 THEN concat(
    '\ncommit: ', left(hash, 39), '\nparents: \nmessage: short\nauthor: x@y.z\ndate: ', at, ' ', zone) END"""


# A later day: one repository has lost all commits, one its authors of even customers.
_STILL_THERE = "NOT (o_orderkey % 9 = 8 OR (o_orderkey % 9 IN (3, 4) AND o_custkey % 2 = 0))"
# In another, every seventh commit has been written anew.
_NEW_HASH = """CASE WHEN o_orderkey % 9 IN (5, 6) AND o_orderkey % 7 = 0
    THEN sha1(concat('new ', o_orderkey)) ELSE {hash} END"""


# The days that logs are rendered for; on the later one some commits have gone.
DAYS = {"first": False, "later": True}
# Lines of the logs that one task writes, about.
TASK_LINES = 500_000


def _tables(spark: SparkSession, sf_dir: str, later: bool) -> tuple[DataFrame, DataFrame]:
    """Orders of that day and all line items; `key` is the order's."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if later:
        orders = orders.filter(_STILL_THERE)
    # One struct, null for line items, is shuffled in fewer bytes than columns that are.
    commits = orders.select(F.col("o_orderkey").alias("key"), F.struct("o_custkey", "o_orderstatus", "o_orderdate").alias("commit"))
    files = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("key"), "l_partkey", "l_suppkey")
    return commits, files


def _rows(spark: SparkSession, sf_dir: str, later: bool) -> DataFrame:
    """Orders and line items as they are, in one table; without line items whose order has gone."""
    commits, files = _tables(spark, sf_dir, later)
    if later:
        files = files.join(commits.select("key"), "key", "left_semi")
    return commits.unionByName(files, allowMissingColumns=True)


def _dealt(spark: SparkSession, sf_dir: str, tasks: int) -> DataFrame:
    """Orders and line items in one table as on the first day, dealt out by key."""
    commits, files = _tables(spark, sf_dir, False)
    return commits.unionByName(files, allowMissingColumns=True).repartition(tasks, "key")


def _left(dealt: DataFrame) -> DataFrame:
    """What of `_dealt` is there on a later day, seen behind the shuffle: `_rows` of that day."""
    is_commit = F.col("commit").isNotNull()
    marked = dealt.withColumns({"o_orderkey": F.col("key"), "o_custkey": F.col("commit.o_custkey")}).withColumn("stays", F.coalesce(is_commit & F.expr(_STILL_THERE), F.lit(False)))
    there = F.max("stays").over(Window.partitionBy("key"))
    kept = F.when(is_commit, F.col("stays")).otherwise(F.col("there") & F.col("key").isNotNull())
    return marked.withColumn("there", there).filter(kept).select(dealt.columns)


def _rendered(rows: DataFrame, later: bool) -> DataFrame:
    commit = dict(_COMMIT)
    if later:
        commit["hash"] = _NEW_HASH.format(hash=commit["hash"])
    is_commit = F.col("commit").isNotNull()
    # Line items have no order's columns, from which nothing is worked out for them then.
    rows = rows.select("key", is_commit.alias("is_commit"), F.when(is_commit, F.col("key")).alias("o_orderkey"), "commit.*", "l_partkey", "l_suppkey")
    parts = rows.select(
        F.expr(_LOG.format(key="key")).alias("log"),
        "key",
        "is_commit",
        *(F.expr(e).alias(name) for name, e in commit.items()),
        F.expr(_FILE).alias("file"),
    )
    around = F.array(*map(F.expr, (_HEADER, "NULL", _WARNING, _BAD_DATE, _BAD_HASH, "''")))
    pieces = F.when(F.col("is_commit"), around).otherwise(F.array(F.lit(None), F.col("file")))
    lines = parts.select("log", "key", "is_commit", F.posexplode(pieces).alias("place", "value"))
    # A file without a name is a line all the same.
    return lines.filter("value IS NOT NULL OR (NOT is_commit AND place = 1)").drop("is_commit")


def log_lines(spark: SparkSession, sf_dir: str, later: bool = False) -> DataFrame:
    """`(log, key, place, value)`: text of all logs; `key` and `place` give its order."""
    return _rendered(_rows(spark, sf_dir, later), later)


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    lines = sum(n * spark.read.parquet(f"{sf_dir}/{table}.parquet").count() for table, n in (("orders", 2), ("lineitem", 1)))
    return -(-lines // TASK_LINES)


def _write(lines: DataFrame, folder: str, compression: str, *folders: str) -> None:
    # The writer sorts by its folders, and loses the lines' order, unless they come first here.
    ordered = lines.sortWithinPartitions(*folders, "log", "key", "place", "value").select(*folders, "log", "value")
    ordered.write.partitionBy(*folders, "log").text(folder, compression=compression)


def write_logs(spark: SparkSession, sf_dir: str, folder: str, later: bool = False, compression: str = "gzip") -> None:
    """Write one log per repository under `folder`; a commit stays within a part file.

    What is shuffled are the tables' columns, not the text made of them. Only what one
    task could write is shuffled as text, and adaptive execution says how many do.
    A part file is what one task writes, so it need not be split to be read and may be
    compressed.
    """
    tasks = _tasks(spark, sf_dir)
    if tasks > 1:
        dealt = _dealt(spark, sf_dir, tasks)
        lines = _rendered(_left(dealt) if later else dealt, later)
    else:
        lines = _rendered(_rows(spark, sf_dir, later), later).repartition("key")
    _write(lines, folder, compression)


def write_logs_of_both_days(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """`write_logs` into `day=first` and `day=later` under `folder`, from one shuffle unless one task could write them."""
    tasks = _tasks(spark, sf_dir)
    if tasks <= 1:
        for day, later in DAYS.items():
            write_logs(spark, sf_dir, f"{folder}/day={day}", later)
        return
    # Both read one exchange, which Spark reuses.
    dealt = _dealt(spark, sf_dir, tasks)
    first, later = (
        _rendered(_left(dealt) if later else dealt, later).withColumn("day", F.lit(day)) for day, later in DAYS.items()
    )
    _write(first.unionByName(later), folder, "gzip", "day")


_written: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """When the tables that logs are rendered from last changed, and their sizes."""
    out = []
    for table in ("orders", "lineitem"):
        path = hadoop_path(spark, f"{sf_dir}/{table}.parquet")
        fs = filesystem(spark, sf_dir)
        out += [fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()]
    return tuple(out)


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, what, _state(spark, sf_dir))


def once(spark: SparkSession, sf_dir: str, what: str, write: Callable[[str], object]) -> str:
    """Folder that `write` filled earlier in this session from the same tables, or fills now."""
    key = _key(spark, sf_dir, what)
    if key not in _written or not exists(spark, _written[key]):
        folder = f"{fresh_folder(spark)}/{what}"
        write(folder)
        _written[key] = folder
    return _written[key]


def logs_of(spark: SparkSession, sf_dir: str) -> str:
    """Folder of rendered logs; written once per session."""
    return once(spark, sf_dir, "logs", lambda folder: write_logs(spark, sf_dir, folder))


def plain_logs_of(spark: SparkSession, sf_dir: str) -> str:
    """The same logs as plain text, whose files are as long as the text."""
    return once(spark, sf_dir, "plain", lambda folder: write_logs(spark, sf_dir, folder, compression="none"))


def later_logs_of(spark: SparkSession, sf_dir: str) -> str:
    """Logs of a later day: `org_p5` has none, `org_p2` lacks authors, `org_p3` has new commits."""
    return once(spark, sf_dir, "later", lambda folder: write_logs(spark, sf_dir, folder, later=True))


def logs_of_both_days(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """`logs_of` and `later_logs_of`, rendered from one shuffle if neither is there."""
    keys = {day: _key(spark, sf_dir, what) for day, what in zip(DAYS, ("logs", "later"), strict=True)}
    if not any(key in _written and exists(spark, _written[key]) for key in keys.values()):
        folder = f"{fresh_folder(spark)}/days"
        write_logs_of_both_days(spark, sf_dir, folder)
        _written.update({key: f"{folder}/day={day}" for day, key in keys.items()})
    return logs_of(spark, sf_dir), later_logs_of(spark, sf_dir)


def table_of(spark: SparkSession, sf_dir: str) -> str:
    """Commits table ingested from those logs; written once per session."""
    return once(
        spark, sf_dir, "commits", lambda root: ingest_logs(spark, logs_of(spark, sf_dir), root)
    )
