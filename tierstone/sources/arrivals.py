"""Which files of a landing zone a table has already taken in.

The ledger lies beside a table's versions::

    path/ledger/part-*.parquet   one row per file and the data folder its rows went to

It is written before the version that it belongs to, and a row counts only if a version names its
folder: a failed attempt leaves files that are still new.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.sources.files import landing_inventory
from tierstone.sources.snapshots import all_commits

_LEDGER = "file string, length long, modified timestamp, folder string"


class FileChanged(ValueError):
    """A file that was taken in before has another size or time now."""


def file_ledger(spark: SparkSession, table: str) -> DataFrame:
    """``file, length, modified, version, folder``: what each version of ``table`` was read from."""
    commits = [(c.folder, c.version) for c in all_commits(spark, table)]
    versions = spark.createDataFrame(commits, "folder string, version long")
    try:
        noted = spark.read.schema(_LEDGER).parquet(f"{table}/ledger")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = spark.createDataFrame([], _LEDGER)
    # one row per version: as many as there were arrivals
    return noted.join(F.broadcast(versions), "folder").select("file", "length", "modified", "version", "folder")


def new_files(spark: SparkSession, files: str | list[str], table: str, *, reread_changed: bool = False) -> DataFrame:
    """``file, length, modified`` of the files that no version of ``table`` was read from.

    A file is known by its path, size and time; no file is opened. One that is known by its path
    but has changed raises :class:`FileChanged`, as its old rows stay in the table;
    ``reread_changed`` counts it as new.
    """
    listed = landing_inventory(spark, files).select(
        F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )
    known = file_ledger(spark, table)
    fresh = listed.join(known, ["file", "length", "modified"], "left_anti")
    if not reread_changed:
        changed = fresh.join(known, "file", "left_semi").orderBy("file").limit(5).collect()
        if changed:
            raise FileChanged(f"{table}: taken in before, but changed since: {[r['file'] for r in changed]}")
    return fresh


def note_files(found: DataFrame, table: str, folder: str) -> None:
    """Add ``found`` (see :func:`new_files`) to the ledger, as the files behind ``folder``."""
    noted = found.select("file", "length", "modified", F.lit(folder).alias("folder"))
    noted.coalesce(1).write.mode("append").parquet(f"{table}/ledger")
