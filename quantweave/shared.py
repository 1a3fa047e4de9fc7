"""Small helpers for running on a cluster: shared intermediate tables and session settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("quantweave.shared.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="quantweave-")
    spark.conf.set("quantweave.shared.dir", folder)
    return folder


#: Spark's own setting: the shuffle files of a query go when it ends, and not only when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_rows(df: DataFrame, path: str) -> None:
    """Write Parquet and let go of the shuffle files behind it, which nothing reads once the table is there."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a DataFrame once to the shared folder and read it back.

    This cuts lineage like a checkpoint, survives lost executors, and keeps column pruning, filter pushdown and size
    statistics for whatever follows.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if (paths := _written.get()) is not None:
        paths.append(path)
    write_rows(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that ``materialise`` wrote inside.

    Whatever reads them has to be written elsewhere by then, such as the output of a workflow's stage. Blocks may be
    nested: each deletes its own tables. They go even if the block fails; a driver that is lost leaves them behind.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """Number of ranges for work that is split by value: one per shuffle partition."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
