"""Where intermediate and trial tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Parquet options of large tables: integers and texts as differences to the row before, then zstd.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: that of the session's setting, else the context's checkpoint folder.

    Where neither is set, a run inside one process uses a temporary folder of
    this machine; on a cluster executors would each write to their own disks,
    so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = found.get() if found.isDefined() else None
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tillscope-")


def fresh_folder(spark: SparkSession) -> str:
    """A new, unused folder name inside the shared folder, or inside the ``scratch`` folder in use."""
    return f"{_scratch.get() or shared_folder(spark)}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder that takes all intermediate tables made inside the block and is deleted at its end.

    Only for blocks whose result is written elsewhere before they end: a DataFrame that still reads an intermediate table
    can not be computed afterwards.
    """
    folder = fresh_folder(spark)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it lies in, if it exists."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """A block in which the shuffle files of a query go when it ends.

    Else they stay until the driver happens to collect its garbage, so those of several large writes lie side by side.
    """
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)


def materialized(df: DataFrame, path: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` computed once into ``path``, by default in the shared folder, and read from there.

    For rows that a plan reads several times and that no executor's loss may
    take away.
    """
    path = path or fresh_folder(df.sparkSession)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
