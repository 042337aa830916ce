"""Paths that tasks write to: the shared folder of intermediate tables, and files of Python tasks named as Spark names them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Schemes of Hadoop's connectors and the names that pyarrow has for them.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme of the file system that Spark takes it to be on, so a path without one is on the cluster's own."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(own).toString()


def opened(uri: str):
    """(pyarrow file system, path there) of a qualified path."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if not rest:
        raise ValueError(f"{uri!r} has no scheme; see qualified()")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


#: Used only where the session names no shared folder and all runs on one machine, as in tests.
LOCAL_FOLDER = "/tmp/checkpoints"


#: The folder, under the shared one, of the run that goes on in this thread; see run().
_run: ContextVar[str] = ContextVar("_run", default="")


@contextmanager
def run(spark: SparkSession, name: str = "run", *, keep: bool = False) -> Iterator[str]:
    """Within it, intermediate tables go to a folder of their own, whose path it gives; at the end, also after an error, the folder
    is removed with all they hold, unless keep. Results that are read from such tables have to be written before it ends."""
    folder = shared_folder(spark, name)
    before = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(before)
        if not keep:
            removed(spark, folder)


def removed(spark: SparkSession, folder: str) -> bool:
    """Removes a folder through Hadoop's file system, so wherever Spark writes; whether it was there."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, the folder that the driver and all executors share; within run(), under that run's.

    Where it is unset, a folder of this machine serves a local master; a cluster has none, which is an error.
    """
    if own := _run.get():
        return f"{own}/{name}-{uuid.uuid4().hex}"
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"{(base or LOCAL_FOLDER).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *, by: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder, read back.

    This cuts the lineage with files that survive lost executors, and fixes the rows of steps whose
    results are used more than once. by: a column to lay the files out by.
    """
    path = shared_folder(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a table without rows may have no file


def shuffled(rows: DataFrame) -> DataFrame:
    """rows whose next join is a shuffled one. Spark takes the size of a written table from its files; rows of pages are so alike that
    these are a hundredth of the rows, and millions of them would be broadcast through the driver."""
    return rows.hint("merge")


def joined_small(table: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """A written table for joins: broadcast if it is seen to have most_rows or fewer, else shuffled()."""
    return table.hint("broadcast") if table.count() <= most_rows else shuffled(table)
