"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[str | None] = ContextVar("textloom_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return context.getCheckpointDir()


def _located(spark: SparkSession, path: str):
    """The path and the file system that it belongs to."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """A folder that is not there is fine."""
    name, files = _located(spark, path)
    files.delete(name, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing where there is none."""
    name, files = _located(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(name)) if files.exists(name) else []


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file; an error where there is one already."""
    name, files = _located(spark, path)
    files.create(name, False).close()


@contextmanager
def scope(spark: SparkSession, name: str | None = None) -> Iterator[str]:
    """Tables stored inside the block belong to it and are deleted at its end, also after an error.

    So a result that reads them has to be written before. A block that was cut off by a lost driver leaves its
    folder behind; given the same ``name`` again, as when a micro-batch is replayed, the block clears it first.
    Blocks nest: an inner one deletes its own.
    """
    folder = f"{_SCOPE.get() or shared_dir(spark) + '/textloom'}/scope-{name or uuid.uuid4().hex}"
    if name:
        delete_folder(spark, folder)
    entered = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(entered)
        delete_folder(spark, folder)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_SCOPE.get() or shared_dir(spark) + '/textloom'}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go. Spark deletes them only when the driver happens to collect its garbage, so after
    a large table has been stored the next one's shuffles would come on top of them."""
    spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the scan of the written table.

    Later stages then start from files, so a lost executor costs a re-read and
    not the whole upstream job, and Catalyst sees real sizes and prunes columns.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
