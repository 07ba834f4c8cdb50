"""Files of any Hadoop file system. The session's JVM handles are used here and nowhere else."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as listings and plans show it."""
    found = _path(spark, path)
    return _system(spark, found).makeQualified(found).toString()


def as_in_rows(spark: SparkSession, path: str) -> list[str]:
    """The spellings of a qualified path in the ``_metadata`` of rows: escaped, a local one with one slash or three."""
    escaped = _path(spark, path).toUri().toString().rstrip("/")
    return [escaped, escaped.replace("file:/", "file:///", 1)] if re.match("file:/[^/]", escaped) else [escaped]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Qualified paths that a pattern finds, in order."""
    found = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in _system(spark, found).globStatus(found) or [])


def exists(spark: SparkSession, path: str) -> bool:
    found = _path(spark, path)
    return _system(spark, found).exists(found)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds; nothing if there is none."""
    found = _path(spark, path)
    _system(spark, found).delete(found, True)
