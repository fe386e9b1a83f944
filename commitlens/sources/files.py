"""Folders and small files on whatever file system a path names."""

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, *parts: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def filesystem(spark: SparkSession, path: str) -> JavaObject:
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path(spark, path).getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    return filesystem(spark, path).exists(hadoop_path(spark, path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    if not exists(spark, path):
        return []
    return [s.getPath().getName() for s in filesystem(spark, path).listStatus(hadoop_path(spark, path))]


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """When each thing in a folder was last changed, in milliseconds."""
    if not exists(spark, path):
        return {}
    found = filesystem(spark, path).listStatus(hadoop_path(spark, path))
    return {s.getPath().getName(): s.getModificationTime() for s in found}


def read_text(spark: SparkSession, path: str) -> str:
    stream = filesystem(spark, path).open(hadoop_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = filesystem(spark, path).create(hadoop_path(spark, path), False)
    stream.write(bytearray(text.encode()))
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    filesystem(spark, path).delete(hadoop_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; `FileExistsError` if `target` is there, `OSError` if the file system refuses.

    No two renames to one target succeed where the file system sees to that, as HDFS does.
    """
    fs, there = filesystem(spark, source), hadoop_path(spark, target)
    if fs.exists(there):
        raise FileExistsError(target)
    if not fs.rename(hadoop_path(spark, source), there):
        if fs.exists(there):
            raise FileExistsError(target)
        raise OSError(f"cannot rename {source} to {target}")
