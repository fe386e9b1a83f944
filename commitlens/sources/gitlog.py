"""Git-log text: one row per commit block, whatever the size of the log.

A log is `<repo_id>.gitlog`, either one file or a directory of part files. Other
files in the same folders are no logs and are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how a block begins.
BLOCK_SEPARATOR = "\ncommit: "
LOG_SUFFIX = ".gitlog"


def _log_of(path: Column) -> Column:
    """The name of the log that a file is or is a part of; null for other files."""
    file = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(file.endswith(LOG_SUFFIX), file).when(folder.endswith(LOG_SUFFIX), folder)


def _repo_id_of(path: Column) -> Column:
    """The log's name without its suffix and without a partition folder's `key=`.

    Plain substring steps: this runs once per block.
    """
    log = _log_of(path)
    return F.substring_index(F.left(log, F.length(log) - len(LOG_SUFFIX)), "=", -1)


def _decoded(path: Column) -> Column:
    """Undo the metadata path's URL encoding, in which a plus sign is a plus sign."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), plain).otherwise(path)


def read_blocks(spark: SparkSession, *paths: str) -> DataFrame:
    """Scan logs into `(repo_id, block)`, one row per commit block.

    The record separator is the start of a commit, so Spark may split a file
    anywhere and no block is torn. Only a file's first block keeps its
    `commit: ` prefix.
    """
    path = F.col("_metadata.file_path")
    return (
        spark.read.option("lineSep", BLOCK_SEPARATOR)
        .option("recursiveFileLookup", True)
        .text(list(paths))
        # On the path alone: files that are no logs are not opened.
        .filter(_log_of(path).isNotNull())
        .select(_decoded(_repo_id_of(path)).alias("repo_id"), F.col("value").alias("block"))
    )


def log_sizes(spark: SparkSession, *paths: str) -> DataFrame:
    """Bytes and megabytes of log text per repository, without reading any content.

    Empty logs count 0 bytes. The list of files, which Spark's reader holds anyway,
    names them; lengths come from a scan that leaves the content out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    names = spark.createDataFrame([(name,) for name in reader.inputFiles()], "path string")
    empty = names.select(_decoded(F.col("path")).alias("path"), F.lit(0).cast("long").alias("length"))
    return (
        reader.select("path", "length")
        .unionByName(empty)
        .select(_repo_id_of(F.col("path")).alias("repo_id"), "length")
        .filter("repo_id IS NOT NULL")
        .groupBy("repo_id")
        .agg(F.sum("length").alias("size_bytes"))
        .withColumn("size_mb", F.round(F.col("size_bytes") / 1024**2, 2))
    )
