"""Tables written to the shared folder to cut a long lineage.

A stored table beats a cached or checkpointed frame here: readers prune its
columns and push filters into it, its size is known to the optimiser, and it
outlives any executor.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_OWN: set[str] = set()
_RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pitlane-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def _remove(fs: JavaObject, folder: JavaObject) -> None:
    try:
        fs.delete(folder, True)
    except (Py4JError, OSError):
        pass  # The JVM went first; the folder is left to the cluster's clean-up.


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's own part of the shared folder, which is removed at exit."""
    own = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        folder = spark._jvm.org.apache.hadoop.fs.Path(own)
        atexit.register(_remove, folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with releasing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_path(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path in the shared folder; what the block stores there goes with it."""
    path = new_path(spark, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        yield path
    finally:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """A write of the block removes the shuffle files of its own plan as it ends, on all executors.

    Spark removes them once the driver's garbage collector finds the plan gone, which a driver that does little never
    does, so the steps of a job would add theirs up.
    """
    own = spark.conf.get(_RELEASED, None)
    spark.conf.set(_RELEASED, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_RELEASED)
        else:
            spark.conf.set(_RELEASED, own)
