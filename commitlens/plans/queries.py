"""Questions over the commits table, and the SQL door."""

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.plans.pruning import pruned
from commitlens.schema import VIEW_NAME


def select_repos(commits: DataFrame, repos: list[str]) -> DataFrame:
    """Commits of the named repositories; becomes a partition filter."""
    return commits.filter(F.col("repo_id").isin(list(repos)))


def files_by_author(commits: DataFrame, status: str = "A", n: int = 5) -> DataFrame:
    """The `n` authors with most files of a status, such as added or deleted."""
    return (
        commits.select("author", F.explode("files").alias("file"))
        .filter(F.col("file.status") == status)
        .groupBy("author")
        .agg(F.count(F.lit(1)).alias("n_files"))
        .orderBy(F.desc("n_files"), "author")
        .limit(n)
    )


def merge_commits(commits: DataFrame) -> DataFrame:
    """Commits with more than one parent."""
    return commits.filter(F.size("parents") > 1)


def contributors(commits: DataFrame, repos: list[str], all_of: bool = False) -> DataFrame:
    """Authors with a commit in any (or, with `all_of`, in each) of the repositories."""
    wanted = list(dict.fromkeys(repos))
    pairs = select_repos(commits, wanted).select("author", "repo_id").distinct()
    if not all_of:
        return pairs.select("author").distinct()
    return (
        pairs.groupBy("author")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == len(wanted))
        .select("author")
    )


def by_author(commits: DataFrame, email: str) -> DataFrame:
    """One author's commits; only folders of the address's first letter are read."""
    author = F.lower(F.lit(email))
    return commits.filter(
        (F.col("author_first_char") == F.substring(author, 1, 1)) & (F.col("author") == author)
    )


def repositories(commits: DataFrame) -> DataFrame:
    """Catalogue: commits, authors and first and last day of each repository."""
    return commits.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("commits"),
        F.count_distinct("author").alias("authors"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def commits_per_repo(commits: DataFrame) -> DataFrame:
    """`(repo_id, count)`."""
    return commits.groupBy("repo_id").agg(F.count(F.lit(1)).alias("count"))


def sample(commits: DataFrame, n: int = 5) -> DataFrame:
    """Any `n` rows, to show what the table looks like."""
    return commits.limit(n)


def register_view(commits: DataFrame, repos: list[str] | None = None) -> DataFrame:
    """Make the (selected) commits known to SQL as `commits`; returns them."""
    chosen = commits if repos is None else select_repos(commits, repos)
    chosen.createOrReplaceTempView(VIEW_NAME)
    return chosen


def run_sql(
    spark: SparkSession, commits: DataFrame, text: str, repos: list[str] | None = None
) -> DataFrame:
    """Run one Spark SQL statement over the view `commits`.

    Conditions and joins on `author` reach the partition folders: the statement sees
    the view without folders that it cannot need. The view that stays has them all.
    """
    return _asked(spark, commits, text, text, repos)


def _asked(spark: SparkSession, commits: DataFrame, text: str, statement: str, repos: list[str] | None) -> DataFrame:
    """Put `statement` to the view as far as `text` needs it."""
    chosen = register_view(commits, repos)
    needed = pruned(spark, chosen, text)
    if needed is chosen:
        return spark.sql(statement)
    register_view(needed)
    try:
        return spark.sql(statement)
    finally:
        register_view(chosen)


def explain_sql(
    spark: SparkSession, commits: DataFrame, text: str, repos: list[str] | None = None
) -> DataFrame:
    """One row `plan`: the formatted plan of a statement, or why there is none."""
    try:
        lines = _asked(spark, commits, text, f"EXPLAIN FORMATTED {text}", repos)
        return lines.agg(F.array_join(F.collect_list("plan"), "\n").alias("plan"))
    except ParseException as error:
        return spark.createDataFrame([(f"{error}\n{text}",)], "plan string")
    except AnalysisException:
        lines = spark.sql(f"EXPLAIN FORMATTED {text}")
        return lines.agg(F.array_join(F.collect_list("plan"), "\n").alias("plan"))
