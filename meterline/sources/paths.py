"""Folder listings through the session's Hadoop file system: local disk, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _open(spark, folder)
    return system.exists(path)


def children(spark: SparkSession, folder: str, files: bool) -> list[str]:
    """Sorted names of the files or of the folders directly inside a folder."""
    system, path = _open(spark, folder)
    if not system.exists(path):
        return []
    return sorted(
        status.getPath().getName()
        for status in system.listStatus(path)
        if bool(status.isFile()) == files
    )


def size(spark: SparkSession, file: str) -> int:
    """Bytes of a file; 0 if there is none."""
    system, path = _open(spark, file)
    return system.getFileStatus(path).getLen() if system.exists(path) else 0


def absolute(spark: SparkSession, folder: str) -> str:
    """The folder's path from its root, without scheme and host."""
    system, path = _open(spark, folder)
    return system.makeQualified(path).toUri().getPath()


def join(*parts: str) -> str:
    return "/".join(part.rstrip("/") for part in parts)
