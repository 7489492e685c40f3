"""Cutting lineage safely: a reliable checkpoint in the folder the cluster shares.

Executor-local checkpoints die with their executor, so iterative operators never use them.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Whether a query's shuffle files go when it ends. By default they stay until the driver happens to collect its garbage.
FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the cluster. Only where none is set and everything runs in one process (a local master, as in
    tests) a fresh local folder is made; on a cluster the executors could not read it, so that is an error."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        one_process = sc.master == "local" or sc.master.startswith("local[")
        if not named and not one_process:
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="relink-"))
        current = sc.getCheckpointDir()
    return named or os.path.dirname(current)


def run_path(spark: SparkSession) -> str:
    """The folder of this run's tables: one for each Spark application."""
    return f"{shared_dir(spark).rstrip('/')}/relink/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A new path under the run's folder for a written table."""
    return f"{run_path(spark)}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete the run's tables; call it when no DataFrame that reads them is needed any more."""
    _delete(spark, run_path(spark))


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside leave no shuffle files behind."""
    was = spark.conf.get(FREE_CONF, None)
    spark.conf.set(FREE_CONF, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(FREE_CONF)
        else:
            spark.conf.set(FREE_CONF, was)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so that iterations do not pile up one plan on another."""
    shared_dir(df.sparkSession)
    with freeing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def _write(df: DataFrame, path: str) -> DataFrame:
    with freeing(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str = "rows") -> DataFrame:
    """`cut` for wide tables that are read a few times: columns written compressed, so that a reader takes only its own."""
    return _write(df, work_path(df.sparkSession, label))


@contextmanager
def briefly(df: DataFrame, label: str = "rows") -> Iterator[DataFrame]:
    """``df`` stored for the jobs of one block, then deleted."""
    path = work_path(df.sparkSession, label)
    try:
        yield _write(df, path)
    finally:
        _delete(df.sparkSession, path)
