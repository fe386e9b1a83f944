"""Reports from rollups that loads leave beside their commits.

A load that keeps rollups writes, for each repository that it replaces, commits by
month and author, changed files by status, and a sketch of each month's authors.
The pointer names them along with the commits, so what a report reads is always as
old as the commits themselves, and a load works out its own repositories only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.plans.reports import as_long, author_months, overview_of, status_counts
from commitlens.schema import ROLLUP_SCHEMA, STATUSES
from commitlens.sources.commits import read_commits, read_stored_rollups

# Parts of a rollup.
AUTHORS, FILES, MONTHS = "authors", "files", "months"
# Sketches have 2^12 registers: a relative standard error of 1.04 / 64, about 1.6 percent.
SKETCH_BITS = 12


def _part(rows: DataFrame, part: str) -> DataFrame:
    """Rows of one part in the rollup's columns, null where the part has none."""
    given = rows.withColumn("part", F.lit(part))
    return given.select(
        *((F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ROLLUP_SCHEMA)
    )


def rollup_of(commits: DataFrame) -> DataFrame:
    """The rollup of some commits; two scans, one of which reads the files' statuses only."""
    authors = author_months(commits).withColumnRenamed("count", "n")
    months = authors.groupBy("repo_id", "month").agg(
        F.sum("n").alias("n"), F.hll_sketch_agg("author", SKETCH_BITS).alias("sketch")
    )
    files = status_counts(commits).withColumnRenamed("files", "n")
    return _part(authors, AUTHORS).unionByName(_part(months, MONTHS)).unionByName(_part(files, FILES))


def read_rollups(spark: SparkSession, root: str, repos: list[str] | None = None) -> DataFrame:
    """The table's rollup, for all repositories or those.

    Repositories whose last load kept no rollup are worked out from their commits.
    """
    stored, others = read_stored_rollups(spark, root, repos)
    return stored.unionByName(rollup_of(read_commits(spark, root, others))) if others else stored


def overview_from(rollups: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """`overview` of the commits behind the rollups."""
    authors = rollups.filter(F.col("part") == AUTHORS).select("repo_id", "month", "author", F.col("n").alias("count"))
    cells = [F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).alias(s) for s in STATUSES]
    files = rollups.filter(F.col("part") == FILES).groupBy("repo_id").agg(*cells, F.sum("n").alias("total"))
    return overview_of(authors, files, n)


def overview_long_from(rollups: DataFrame, n: int = 20) -> DataFrame:
    """`overview_long` of the commits behind the rollups."""
    return as_long(overview_from(rollups, n))


def approx_authors(rollups: DataFrame, period: str | None = "quarter", by_repo: bool = False) -> DataFrame:
    """`([repo_id,] [period,] authors)`: about how many authors were active, by union of sketches.

    `period` is what `date_trunc` takes, a month or longer; None is all time.
    Estimates have a relative standard error of 1.6 percent. No author is read or
    shuffled: a month of a repository is one sketch of at most 4 KB.
    """
    keys = [F.col("repo_id")] if by_repo else []
    if period is not None:
        keys.append(F.date_trunc(period, "month").cast("date").alias("period"))
    months = rollups.filter(F.col("part") == MONTHS)
    return months.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("authors"))
