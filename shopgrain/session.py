"""Session helper for tests and benchmarks, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
LONGEST_METHOD = "spark.sql.codegen.hugeMethodLimit"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARQUET_CODEC = "spark.sql.parquet.compression.codec"
#: Where ``materialize`` notes its tables for an open ``scratch_noted``.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def local_session(cores: int | str = 8, app: str = "shopgrain") -> SparkSession:
    """A single-JVM session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local[...] session without that setting gets a folder of its own; anywhere else a
    machine-local folder would be invisible to the other executors, so we refuse.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shopgrain-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing read is overwritten."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/shopgrain/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds inside only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each query run inside leaves no shuffle files behind. Otherwise they stay on the executors' disks until the
    driver happens to collect garbage, so a job of many steps would hold the shuffles of all of them."""
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing a Parquet table to the shared folder and reading it back.

    Survives the loss of any executor, and unlike an RDD checkpoint keeps column pruning
    and file statistics for the readers. What was shuffled for it is not needed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    noted = _noted.get()
    if noted is not None:
        noted.append(path)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_noted(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Gives a function that removes the tables that ``materialize`` has written since: for a job of many steps,
    to be called when a step is written and nothing reads them any more."""
    paths: list[str] = []

    def drop() -> None:
        while paths:
            delete_path(spark, paths.pop())

    token = _noted.set(paths)
    try:
        yield drop
    finally:
        _noted.reset(token)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table once nothing reads it any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def deliver(spark: SparkSession, source: str, folder: str) -> None:
    """Let a written folder arrive under another name; one that holds no rows was never written and arrives empty."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, folder))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent() if files.exists(old) else new)
    if files.exists(old) and not files.rename(old, new):
        raise OSError(f"can't rename {source} to {folder}")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables from the shared folder."""
    delete_path(spark, f"{shared_dir(spark)}/shopgrain/{spark.sparkContext.applicationId}")
