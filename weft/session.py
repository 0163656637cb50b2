"""Small helpers around the running session."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession


_NAME = re.compile(r"[a-z][a-z0-9_]*")


def checked_name(name: str) -> str:
    """The name of a table, if it is one: lower-case letters, digits and underscores, a letter first; else a ValueError."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not the name of a table: {name!r}")
    return name


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the session's catalog has a table or view of that name."""
    return spark.catalog.tableExists(checked_name(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table of that name in a folder."""
    return spark.read.parquet(f"{folder}/{checked_name(name)}.parquet")


def partitions(spark: SparkSession) -> int:
    """How many tasks a shuffle is planned with."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors share: what spark.checkpoint.dir names, else (in tests) a new local one."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="weft-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


#: A setting of the session that has the files of a query's shuffles removed as soon as the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[list[str | Broadcast]] = []


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that run within leave no shuffle files behind; the session's own setting is put back at the end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str | Broadcast]]:
    """Tables that `cut` writes and values that are `lent` within are deleted at the end, for steps whose results are written themselves by `cut(df, keep=True)`."""
    made: list[str | Broadcast] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.pop()
        for thing in made:
            if isinstance(thing, Broadcast):
                thing.destroy(blocking=True)
            else:
                _delete(spark, thing)


def lent(spark: SparkSession, value: object) -> Broadcast:
    """The value as a broadcast; its copies, on disk too, are deleted at the end of the `scope` it is made in, so what reads it must be written within."""
    made = spark.sparkContext.broadcast(value)
    if _scopes:
        _scopes[-1].append(made)
    return made


def cut(df: DataFrame, keep: int = 0) -> DataFrame:
    """The same rows, written as a compressed table to the shared folder, so that lost executors cost no recomputation.

    The table is deleted at the end of the `scope` it is written in, with keep at the end of the one that is so many around that; without one, when the
    session's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/weft-{uuid.uuid4().hex}"
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    if len(_scopes) > keep:
        _scopes[-1 - keep].append(path)
    else:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)
