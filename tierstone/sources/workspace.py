"""Shared scratch space for intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from threading import Lock
from urllib.parse import urlsplit
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = Lock()
_REMOVING: dict[SparkSession, tuple[int, str]] = {}


def _on_one_machine(spark: SparkSession, path: str) -> bool:
    """Whether a path is on the local file system, by its scheme or the default one."""
    scheme = urlsplit(path).scheme
    if not scheme:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        scheme = urlsplit(default or "file:///").scheme
    return scheme == "file"


@cache
def _seen_by_all(spark: SparkSession, application: str, folder: str) -> bool:
    """Whether rows that the executors write under ``folder`` are all read back; tried once.

    Where a path is another folder on each machine, the driver does not find their files.
    """
    path = f"{folder}/tierstone/seen-{uuid4().hex}"
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(tasks, numPartitions=tasks).write.parquet(path)
    try:
        return spark.read.schema("id long").parquet(path).count() == tasks
    except (PySparkException, Py4JJavaError):
        return False


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, under the warehouse, which a session shares with its executors too.
    On a cluster a path of the local file system is refused: other machines do not see it.
    A standalone cluster brings no file system of its own, and its machines may mount the same
    folder: there a first write tells whether they do.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "")
    standalone = master.startswith("spark:")
    if not shared and not standalone and not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    shared = (shared or spark.conf.get("spark.sql.warehouse.dir", None) + "/scratch").rstrip("/")
    if not master.startswith("local") and _on_one_machine(spark, shared):
        if not standalone or not _seen_by_all(spark, spark.sparkContext.applicationId, shared):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors can reach; {shared} is none")
    return f"{shared}/tierstone/{label}-{uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what the session writes meanwhile go as soon as that write is done.

    Else they stay until the driver happens to collect its garbage, those of several steps
    together. Calls may overlap: the session has its own setting back after the last.
    """
    with _LOCK:
        depth, before = _REMOVING.get(spark) or (0, spark.conf.get(_CLEANUP, "false"))
        spark.conf.set(_CLEANUP, "true")
        _REMOVING[spark] = depth + 1, before
    try:
        yield
    finally:
        with _LOCK:
            depth, before = _REMOVING.pop(spark)
            if depth > 1:
                _REMOVING[spark] = depth - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored table.

    Cuts the lineage durably, so later reads see one fixed result whatever executors are
    lost meanwhile. Parquet rather than an RDD checkpoint: readers can prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
