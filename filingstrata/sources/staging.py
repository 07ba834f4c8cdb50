"""Intermediates written once to the folder the cluster shares.

Used where a step needs the very same rows twice (for example positions inside range partitions),
and where lineage should end: the written files survive the loss of any executor. Staging runs a
job while the plan is built, so operators that stage are eager in that part.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from filingstrata.sources import files

_FOLDER_KEY = "spark.checkpoint.dir"
_FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ONE_MACHINE = re.compile(r"local(\[.*\])?")
_open: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local masters without a setting."""
    configured = spark.conf.get(_FOLDER_KEY, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not _ONE_MACHINE.fullmatch(context.master):
            raise ValueError(f"set {_FOLDER_KEY} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="filingstrata-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/filingstrata/{label}-{uuid.uuid4().hex}"


def scoped_folder(spark: SparkSession, label: str) -> str:
    """As :func:`new_folder`; an open :func:`staging_scope` removes it at its end."""
    path = new_folder(spark, label)
    if (staged := _open.get()) is not None:
        staged.append(path)
    return path


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries inside go when their query ends: for rows that are written once and read back."""
    before = spark.conf.get(_FREE_KEY, "false")
    spark.conf.set(_FREE_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_KEY, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written files."""
    path = scoped_folder(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Removes what is staged inside once the block ends; results must be written before that."""
    staged: list[str] = []
    token = _open.set(staged)
    try:
        yield
    finally:
        _open.reset(token)
        for path in staged:
            files.delete(spark, path)


def stage_made(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Stages what ``make`` returns and removes what it staged on the way."""
    path = scoped_folder(spark, label)
    with staging_scope(spark), shuffles_freed(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)
