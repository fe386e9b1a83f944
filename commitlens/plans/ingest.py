"""Logs to table in one pass."""

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from commitlens.operators.ingest import parse_blocks, sorted_out
from commitlens.plans.rollups import rollup_of
from commitlens.sources.commits import KEEP_SECONDS, load
from commitlens.sources.gitlog import read_blocks


def ingest_logs(
    spark: SparkSession,
    logs: str | list[str],
    root: str,
    overlapping: bool = False,
    rollups: bool = False,
    keep_seconds: float = KEEP_SECONDS,
) -> dict[str, int]:
    """Ingest git logs into the commits table at `root`, repository by repository.

    Returns the number of blocks read, of blocks rejected and of stray lines,
    counted during the same pass; the rejected text itself goes into the table,
    for `read_rejects`. Logs are read and parsed once.

    A commit that occurs twice in a repository's log is two rows. With
    `overlapping`, for logs whose part files overlap, it is one, which takes one
    more exchange. With `rollups`, those of the loaded repositories are kept in the
    table for `read_rollups`, which takes one more look at the rows just written.
    What was replaced more than `keep_seconds` ago is deleted.
    """
    paths = [logs] if isinstance(logs, str) else list(logs)
    rows = sorted_out(parse_blocks(read_blocks(spark, *paths)))
    strays = F.when(F.col("kind") == "commits", F.size("rejects"))
    metrics = [
        F.count(F.lit(1)).alias("blocks"),
        F.count_if(F.col("kind") == "rejects").alias("rejected_blocks"),
        F.coalesce(F.sum(F.when(F.col("rejects").isNotNull(), strays)), F.lit(0)).alias("stray_lines"),
    ]
    seen = Observation("ingest")
    observed = rows.observe(seen, *metrics)
    if overlapping:
        whole = F.when(F.col("kind") == "rejects", F.xxhash64("rejects"))
        observed = observed.withColumn("__whole", whole).dropDuplicates(["repo_id", "kind", "commit_hash", "__whole"])
        observed = observed.drop("__whole")
    written = load(spark, observed, root, rollup=rollup_of if rollups else None, keep_seconds=keep_seconds)
    # Without a row to write, adaptive execution drops the plan and its metrics.
    if written or rows.limit(1).count():
        return dict(seen.get)
    return {"blocks": 0, "rejected_blocks": 0, "stray_lines": 0}
