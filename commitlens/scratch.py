"""The folder every executor can reach, for derived tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from commitlens.sources.files import filesystem, hadoop_path

SETTING = "spark.checkpoint.dir"

# A local session's own folder, by application.
_local_roots: dict[str, str] = {}
# Folders made within the scopes that are open now, innermost last.
_scopes: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names.

    Where that is unset, a local session gets a temporary folder; a cluster
    session must name one.
    """
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="commitlens-")
        root = _local_roots[context.applicationId]
    return root.rstrip("/")


def fresh_folder(spark: SparkSession) -> str:
    """An unused path in that folder, deleted when its scope or the session ends."""
    name = f"commitlens-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    outer = f"{shared_root(spark)}/{name}"
    fs, path = filesystem(spark, outer), hadoop_path(spark, outer)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    if _scopes:
        _scopes[-1].append(outer)
    return f"{outer}/data"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Frees what is stored inside, at its end; results must be written or collected by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            filesystem(spark, folder).delete(hadoop_path(spark, folder), True)


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """`df` computed now and read back from parquet: its lineage ends there.

    Unlike a checkpoint it is computed once and can be read column by column.
    `compression` is parquet's, the session's by default.
    """
    folder = fresh_folder(df.sparkSession)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
