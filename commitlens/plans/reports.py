"""The overview reports. Each takes the commits table and gives a DataFrame."""

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.schema import STATUS_LABELS, STATUSES

OTHERS = "Others"


def _month() -> Column:
    return F.trunc("date", "month")


def _author_counts(commits: DataFrame) -> DataFrame:
    return commits.groupBy("author").agg(F.count(F.lit(1)).alias("count"))


def _largest(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), "author").limit(n)


def top_authors(commits: DataFrame, n: int = 20) -> DataFrame:
    """`(author, count)` of the `n` authors with most commits; ties go by name."""
    return _largest(_author_counts(commits), n)


def _with_others(counts: DataFrame, n: int) -> DataFrame:
    # What the others hold is the total less the top; no author is ranked
    # outside a bounded top-n, and all three branches share one shuffle.
    top = _largest(counts, n)
    rest = (
        counts.select("count")
        .unionByName(top.select((-F.col("count")).alias("count")))
        .agg(F.sum("count").alias("count"))
        .filter("count > 0")
        .select(F.lit(OTHERS).alias("author"), "count", F.lit(1).alias("last"))
    )
    return (
        top.withColumn("last", F.lit(0))
        .unionByName(rest)
        .orderBy("last", F.desc("count"), "author")
        .limit(n + 1)
        .select("author", "count")
    )


def top_authors_with_others(commits: DataFrame, n: int = 20) -> DataFrame:
    """`top_authors` plus one last row `Others`, if other authors have commits."""
    return _with_others(_author_counts(commits), n)


def _running(monthly: DataFrame) -> DataFrame:
    so_far = (
        Window.partitionBy("repo_id")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn("count", F.sum("count").over(so_far))


def commit_activity(commits: DataFrame, cumulative: bool = True) -> DataFrame:
    """`(date, count, repo_id)`: commits per repository and month, running or not.

    Months without commits have no row.
    """
    monthly = commits.groupBy("repo_id", _month().alias("date")).agg(
        F.count(F.lit(1)).alias("count")
    )
    counted = _running(monthly) if cumulative else monthly
    return counted.select("date", "count", "repo_id").orderBy("date", "repo_id")


def active_authors(commits: DataFrame, approximate: bool = False) -> DataFrame:
    """`(repo_id, month, active_authors)`: distinct authors per repository and month."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        commits.groupBy("repo_id", _month().alias("month"))
        .agg(distinct("author").alias("active_authors"))
        .orderBy("month", "repo_id")
    )


def status_counts(commits: DataFrame) -> DataFrame:
    """`(repo_id, status, files)`: changed files of any status that occurs."""
    return (
        commits.select("repo_id", F.explode("files").alias("file"))
        .groupBy("repo_id", F.col("file.status").alias("status"))
        .agg(F.count(F.lit(1)).alias("files"))
    )


def _spread(commits: DataFrame) -> DataFrame:
    """One exchange: a repository's files are counted into cells before it."""
    status = F.col("file.status")
    cells = [F.count_if(status == s).alias(s) for s in STATUSES]
    files = commits.select("repo_id", F.explode("files").alias("file"))
    return files.groupBy("repo_id").agg(*cells, F.count(F.lit(1)).alias("total"))


def file_status_counts(commits: DataFrame, discover: bool = False) -> DataFrame:
    """Changed files per repository, one column per status.

    The columns are the statuses git knows and a `total` over any status. With
    `discover` they are the statuses found in the data instead (one more job),
    null where a repository has none.
    """
    if discover:
        return status_counts(commits).groupBy("repo_id").pivot("status").agg(F.sum("files"))
    return _spread(commits)


def file_status_percent(commits: DataFrame) -> DataFrame:
    """`(repo_id, M, R, A, D)`: percent of a repository's changed files, any status."""
    return _spread(commits).select(
        "repo_id", *((F.col(s) / F.col("total") * 100).alias(s) for s in STATUS_LABELS)
    )


def file_status_shares(commits: DataFrame) -> DataFrame:
    """Long form of counts and percents: `(repo_id, status, label, files, percent)`."""
    labels = F.create_map(*map(F.lit, chain.from_iterable(STATUS_LABELS.items())))
    cells = F.array(
        *(F.struct(F.lit(s).alias("status"), F.col(s).alias("files")) for s in STATUS_LABELS)
    )
    return _spread(commits).select("repo_id", "total", F.inline(cells)).select(
        "repo_id",
        "status",
        labels[F.col("status")].alias("label"),
        "files",
        (F.col("files") / F.col("total") * 100).alias("percent"),
    )


def author_months(commits: DataFrame) -> DataFrame:
    """Rollup `(repo_id, month, author, count)` that the author and activity reports share."""
    return commits.groupBy("repo_id", _month().alias("month"), "author").agg(
        F.count(F.lit(1)).alias("count")
    )


def overview(commits: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """The four reports, the first three over one rollup. Nothing runs yet.

    Persist `author_months(commits)` beforehand to keep the rollup between reports.
    """
    return overview_of(author_months(commits), file_status_counts(commits), n)


def overview_of(rollup: DataFrame, file_status: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """The four reports from `author_months` and `file_status_counts`, wherever these come from."""
    authors = rollup.groupBy("author").agg(F.sum("count").alias("count"))
    monthly = rollup.groupBy("repo_id", F.col("month").alias("date")).agg(
        F.sum("count").alias("count")
    )
    return {
        "commits_per_author": _with_others(authors, n),
        "commit_activity": _running(monthly).select("date", "count", "repo_id"),
        "file_status": file_status,
        # Every count is above 0; asking for it keeps the rollup's columns, and so
        # its shuffle, the same as in the other reports.
        "active_authors": rollup.groupBy("repo_id", "month").agg(
            F.count_if(F.col("count") > 0).alias("active_authors")
        ),
    }


def overview_long(commits: DataFrame, n: int = 20) -> DataFrame:
    """All four reports as one table `(report, repo_id, key, value)`, in one query."""
    return as_long(overview(commits, n))


def as_long(reports: dict[str, DataFrame]) -> DataFrame:
    """An overview's four reports as one table `(report, repo_id, key, value)`."""
    status = reports["file_status"].select(
        "repo_id",
        F.inline(F.array(*(F.struct(F.lit(s).alias("key"), F.col(s).alias("value")) for s in STATUS_LABELS))),
    )
    parts = {
        "commits_per_author": reports["commits_per_author"].select(
            F.lit("").alias("repo_id"), F.col("author").alias("key"), F.col("count").alias("value")
        ),
        "commit_activity": reports["commit_activity"].select(
            "repo_id", F.col("date").cast("string").alias("key"), F.col("count").alias("value")
        ),
        "file_status": status,
        "active_authors": reports["active_authors"].select(
            "repo_id", F.col("month").cast("string").alias("key"), F.col("active_authors").alias("value")
        ),
    }
    tagged = [part.select(F.lit(name).alias("report"), "*") for name, part in parts.items()]
    first, *others = tagged
    for part in others:
        first = first.unionByName(part)
    return first
