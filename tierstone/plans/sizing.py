"""Task sizes that follow the data, for the length of a refresh."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierstone.sources import landing_inventory

_MB = 1024 * 1024

# Shuffle partitions hold about this much in-memory data each. More than the upper limit
# would make the blocks between map and reduce tasks too small to be read efficiently;
# beyond it partitions grow, and sort by spilling.
PARTITION_BYTES = 256 * _MB
MAX_PARTITIONS = 50_000

# Scans use larger splits once there would be more tasks (and bronze files) than this.
MAX_SCAN_TASKS = 100_000
MAX_SPLIT_BYTES = 1024 * _MB

_PARTITIONS = "spark.sql.shuffle.partitions"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_DEFAULT_SPLIT = 128 * _MB


def shuffle_partitions(data_bytes: int, configured: int) -> int:
    """Partitions for shuffling ``data_bytes``; never fewer than ``configured``.

    AQE merges what turns out too small, but cannot split a plain shuffle that was planned
    with too few.
    """
    return max(configured, min(MAX_PARTITIONS, -(-data_bytes // PARTITION_BYTES)))


def split_bytes(file_bytes: int) -> int:
    """Bytes of a file one scan task reads."""
    return max(_DEFAULT_SPLIT, min(MAX_SPLIT_BYTES, -(-file_bytes // MAX_SCAN_TASKS)))


def total_bytes(spark: SparkSession, files: str | list[str]) -> int:
    """Size of all files, from their listing."""
    return landing_inventory(spark, files).agg(F.sum("length")).first()[0] or 0


@contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def splits_sized_for(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Larger scan splits for very large inputs; a split size set by the user stays."""
    chosen = spark.conf.get(_SPLIT)
    if chosen != f"{_DEFAULT_SPLIT}b":
        yield
        return
    with _setting(spark, _SPLIT, split_bytes(file_bytes)):
        yield


@contextmanager
def shuffles_sized_for(spark: SparkSession, data_bytes: int) -> Iterator[None]:
    configured = int(spark.conf.get(_PARTITIONS))
    with _setting(spark, _PARTITIONS, shuffle_partitions(data_bytes, configured)):
        yield
