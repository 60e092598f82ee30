"""Session helpers: the shared work area and tables staged in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def work_area(spark: SparkSession) -> str:
    """Shared folder for staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset, as in a
    local test, a temporary folder is taken and kept for the session.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"{CHECKPOINT_CONF} has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shiftledger-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path inside the work area; nothing is created yet."""
    return f"{work_area(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, n_tasks: int, *cols: str) -> DataFrame:
    """Rows dealt by columns to so many tasks, for a window over these columns.

    So what a task sorts does not grow with the input. Adaptive execution spreads rows over the
    session's cores by itself, so up to their number of tasks it is left to do so.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n_tasks, *cols) if n_tasks > cores else df


_leased: ContextVar[tuple[list[str], ...]] = ContextVar("leased", default=())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def lease(spark: SparkSession) -> Iterator[list[str]]:
    """Owns the tables staged inside the ``with`` block and removes them at its end, also after an error.

    What is returned from the block must not read them any more: collect or write it inside. Leases
    may lie in one another; a table belongs to the innermost. Outside of any lease tables stay.
    """
    folders: list[str] = []
    token = _leased.set((*_leased.get(), folders))
    try:
        yield folders
    finally:
        _leased.reset(token)
        for path in folders:
            remove_folder(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the work area and read it back.

    Cuts the lineage like a checkpoint and survives lost executors, but stays columnar, so
    each later reader prunes to the columns it needs. A ``lease`` removes it again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if _leased.get():
        _leased.get()[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
