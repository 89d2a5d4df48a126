"""Versioned Parquet tables.

Layout of a table at ``path``::

    path/v=<n>-<token>/part-*.parquet   the rows of version n
    path/history/part-*.json            one line per committed version

A version exists once its history line does, and the line names the data folder. A failed
or repeated attempt leaves an unnamed folder that no reader sees; a committed folder is
never written again, so a table can be read while it is being rebuilt, and old versions
stay readable. One writer per table at a time is assumed; two that commit the same version are
found out by the next read, which refuses to choose until ``settle_conflicts`` has.
``expire_snapshots`` removes the rows of old versions; their lines in the history stay.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions import named, row_bytes
from tierstone.sources.files import SchemaChanged

_HISTORY = (
    "version long, timestamp timestamp, operation string,"
    " operationParameters map<string,string>, schema_json string, num_rows long,"
    " in_memory_bytes long, folder string, upstream_folder string, upstream_rows long,"
    " rejected_rows long"
)
_SUPERSEDED, _EXPIRED = "SUPERSEDED", "EXPIRED"
_OVERWRITE, _APPEND = "Overwrite", "Append"
_FOLDER = re.compile(r"v=\d+-[0-9a-f]{12}\Z")
# Types whose values come back from the name of a folder as they were.
_LAYOUT_TYPES = (T.DateType, T.StringType, T.BooleanType, T.IntegralType)
_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class VersionNotFound(LookupError):
    """The table, or the requested version of it, does not exist."""


class ConflictingVersions(RuntimeError):
    """Two writers committed the same version; which one is current cannot be told."""


@dataclass(frozen=True)
class Commit:
    """One stored version. ``in_memory_bytes`` bounds its size as a broadcast table.

    ``upstream_folder`` and ``upstream_rows`` tell what it was built from: a folder of another
    table, or the rows counted in the source files. ``rejected_rows`` counts the rows whose source
    line is kept beside them, see :func:`write_snapshot`.
    """

    path: str
    version: int
    num_rows: int
    in_memory_bytes: int | None
    schema: T.StructType
    folder: str
    upstream_folder: str | None = None
    upstream_rows: int | None = None
    rejected_rows: int | None = None


def _path(spark: SparkSession, name: str):
    """A path, and the file system that it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, path: str) -> DataFrame:
    history, files = _path(spark, f"{path}/history")
    if not files.exists(history):  # asked first: Spark logs a read that fails, as an error of its own
        raise VersionNotFound(f"no table at {path}")
    try:
        return (
            spark.read.schema(_HISTORY)
            .option("timestampFormat", _MICROSECONDS)
            .json(f"{path}/history")
        )
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise VersionNotFound(f"no table at {path}") from None
        raise


def _append_history(spark: SparkSession, path: str, record: dict[str, Column]) -> None:
    line = spark.range(1, numPartitions=1).select(*[c.alias(n) for n, c in record.items()])
    line.write.mode("append").option("timestampFormat", _MICROSECONDS).json(f"{path}/history")


def _newest(commits: DataFrame, path: str) -> Commit | None:
    rows = commits.orderBy(F.desc("version")).limit(2).collect()
    if not rows:
        return None
    row = rows[0]
    if len(rows) == 2 and rows[1]["version"] == row["version"]:
        live = _live(commits.where(F.col("version") == row["version"]).collect())
        if not live:
            raise VersionNotFound(f"version {row['version']} of {path} has expired")
        if len(live) > 1:
            raise ConflictingVersions(
                f"{path}: version {row['version']} was committed twice; settle_conflicts() keeps the first"
            )
        row = live[0]
    return _commit(row, path)


def _live(rows: list[Row]) -> list[Row]:
    """Commits of one version that are neither superseded nor expired, the first one first."""
    gone = {r["folder"] for r in rows if r["operation"] in (_SUPERSEDED, _EXPIRED)}
    return sorted((r for r in rows if r["folder"] not in gone), key=lambda r: (r["timestamp"], r["folder"]))


def _commit(row: Row, path: str) -> Commit:
    return Commit(
        path=path,
        version=row["version"],
        num_rows=row["num_rows"],
        in_memory_bytes=row["in_memory_bytes"],
        schema=T.StructType.fromJson(json.loads(row["schema_json"])),
        folder=row["folder"],
        upstream_folder=row["upstream_folder"],
        upstream_rows=row["upstream_rows"],
        rejected_rows=row["rejected_rows"],
    )


def settle_conflicts(spark: SparkSession, path: str) -> list[Commit]:
    """Make a table readable again after two writers committed the same version.

    Of such a version the first commit stays (by time, then by folder name, so every caller
    settles alike). The others get a line in the history that says so, and are returned: their
    rows are kept, and ``read_commit`` reads them, to be written again as a version of their own.
    """
    commits, found = _commits(spark, path), []
    repeated = commits.groupBy("version").agg(F.count("*").alias("n")).where("n > 1").select("version")
    lines: dict[int, list[Row]] = {}
    for line in commits.join(repeated, "version", "left_semi").collect():  # few: conflicts alone
        lines.setdefault(line["version"], []).append(line)
    for _, of_version in sorted(lines.items()):
        for loser in _live(of_version)[1:]:
            _append_history(spark, path, _again(loser, _SUPERSEDED, {}))
            found.append(_commit(loser, path))
    return found


def _again(line: Row, operation: str, parameters: dict[str, str]) -> dict[str, Column]:
    """A line that says what became of the commit of another one."""
    schema = T.StructType.fromDDL(_HISTORY)
    kept = [f for f in schema if f.name not in ("operation", "operationParameters")]
    record = {f.name: F.lit(line[f.name]).cast(f.dataType) for f in kept} | {"operation": F.lit(operation)}
    if parameters:
        record["operationParameters"] = F.create_map(*[F.lit(x) for pair in parameters.items() for x in pair])
    return record


def expire_snapshots(
    spark: SparkSession, path: str, *, keep_last: int = 1, older_than: datetime | None = None
) -> list[Commit]:
    """Remove the rows of old versions: all but the ``keep_last`` newest, and with ``older_than``
    only those committed before that moment. Returns what was removed, oldest first.

    The current version always stays. A line in the history says that a version has expired before
    any file of it goes, so that readers get :class:`VersionNotFound` and not a part of it; a call
    that fails half-way is made good by the next one. Queries that still read such a version fail:
    choose ``older_than`` so that none does. A table whose versions are read together, as those of
    daily arrivals are, is refused: none of them is old.
    """
    if keep_last < 1:
        raise ValueError("keep_last must be at least 1: the current version stays")
    lines = _commits(spark, path).collect()  # a line per commit
    if any((r["operationParameters"] or {}).get("mode") == _APPEND for r in lines):
        raise ValueError(f"{path}: its versions are read together, none can expire")
    by_version: dict[int, list[Row]] = {}
    for line in lines:
        by_version.setdefault(line["version"], []).append(line)
    live = [found for version in sorted(by_version) if (found := _live(by_version[version]))]
    if conflicts := [found[0]["version"] for found in live if len(found) > 1]:
        raise ConflictingVersions(f"{path}: settle_conflicts() first, versions {conflicts} were committed twice")
    bound = older_than.astimezone().replace(tzinfo=None) if older_than else None
    old = [found[0] for found in live[:-keep_last]]
    old = [r for r in old if bound is None or r["timestamp"] < bound]
    now = datetime.now(timezone.utc).isoformat()
    for line in old:
        _append_history(spark, path, _again(line, _EXPIRED, {"expiredAt": now}))
    # those of earlier calls too, which may have failed before their files were gone
    for line in [*old, *(r for r in lines if r["operation"] == _EXPIRED)]:
        if not _FOLDER.match(line["folder"]):
            raise ValueError(f"{path}: {line['folder']!r} is no folder of a version")
        folder, files = _path(spark, f"{path}/{line['folder']}")
        files.delete(folder, True)
    return [_commit(line, path) for line in old]


def _current(spark: SparkSession, path: str) -> Commit | None:
    """The current version; None when there is no table yet. Reads the history once."""
    try:
        return _newest(_commits(spark, path), path)
    except VersionNotFound:
        return None


def latest_commit(spark: SparkSession, path: str) -> Commit:
    """The current version's commit record; reads the history only, never the data."""
    commit = _newest(_commits(spark, path), path)
    if commit is None:
        raise VersionNotFound(f"no table at {path}")
    return commit


def all_commits(spark: SparkSession, path: str) -> list[Commit]:
    """Every version of the table that has not expired, oldest first; none when there is no table."""
    try:
        lines = _commits(spark, path).collect()
    except VersionNotFound:
        return []
    by_version: dict[int, list[Row]] = {}
    for line in lines:
        by_version.setdefault(line["version"], []).append(line)
    found = []
    for version in sorted(by_version):
        live = _live(by_version[version])
        if len(live) > 1:
            raise ConflictingVersions(
                f"{path}: version {version} was committed twice; settle_conflicts() keeps the first"
            )
        found += [_commit(line, path) for line in live]
    return found


def _columns(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def _laid_out(df: DataFrame, layout: Sequence[str], path: str) -> DataFrame:
    """Rows of equal values in ``layout`` in one task, or a few where they are many."""
    for name in layout:
        kind = df.schema[name].dataType
        if not isinstance(kind, _LAYOUT_TYPES):
            raise ValueError(f"{path}: a folder's name does not keep {kind.simpleString()} values, as {name} has")
    return df.hint("rebalance", *[named(c) for c in layout]) if layout else df


def write_snapshot(
    df: DataFrame,
    path: str,
    *,
    overwrite_schema: bool = False,
    committed_at: datetime | None = None,
    upstream: Commit | None = None,
    upstream_rows: int | None = None,
    source_line: str | None = None,
    partition_by: str | None = None,
    layout: Sequence[str] = (),
    adds: bool = False,
    before_commit: Callable[[str], None] | None = None,
) -> Commit:
    """Replace the table's content by ``df`` as a new version.

    Column names and types must match the current version unless ``overwrite_schema``.
    Rows are counted and sized while they are written, so neither verifying a write nor
    sizing a lookup table costs another scan. ``upstream`` is the version that ``df`` was made
    from; ``upstream_rows`` counts its rows where that is no table. ``source_line`` names a column
    with the text that a row was read from, where that did not fit: it is stored and counted in the
    same pass, but is no column of the table. ``partition_by`` lays the rows out in a folder per
    value of a column, from the tasks that hold them. ``layout`` names columns whose values get a
    folder each, after a shuffle that brings their rows together, with values of many rows split
    over several tasks: a filter on them lists and reads those folders alone. Choose columns whose
    folders hold about a hundred megabytes or more; a day and a status of 100 TB of orders have
    some ten gigabytes. ``adds`` notes that all versions are read together, see
    :func:`read_commits`. ``before_commit`` is called with the data folder's name once its rows are
    written and before the version exists: what it stores about a folder that no version names
    does not count.
    """
    spark = df.sparkSession
    current = _current(spark, path)
    schema = T.StructType([f for f in df.schema if f.name != source_line])
    if current and not overwrite_schema and _columns(current.schema) != _columns(schema):
        raise SchemaChanged(
            f"{path}: table has {_columns(current.schema)}, frame has {_columns(schema)};"
            " pass overwrite_schema=True to change it"
        )
    version = current.version + 1 if current else 0
    folder = f"v={version}-{uuid4().hex[:12]}"
    # Observed directly under the write, i.e. in the result stage, where Spark counts every
    # partition once even when tasks are retried.
    written = Observation()
    folders = [partition_by] if partition_by else list(layout)
    texts = [c for c in layout if isinstance(df.schema[c].dataType, T.StringType)]
    # the name of a folder does not tell empty text from null
    empty = sum((F.count_if(named(c) == "") for c in texts), F.lit(0))
    counted = _laid_out(df, layout, path).observe(
        written,
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_bytes(schema)).alias("bytes"),
        (F.count(F.col(source_line)) if source_line else F.count(F.lit(None))).alias("rejected"),
        empty.alias("empty"),
    )
    writer = counted.write.partitionBy(*folders) if folders else counted.write
    writer.parquet(f"{path}/{folder}")
    if texts and written.get["empty"]:
        raise ValueError(f"{path}: {texts} hold empty text, which a layout by folders would make null")
    num_rows = written.get["rows"]
    size = written.get["bytes"] if num_rows else 0
    rejected = written.get["rejected"]

    if upstream is not None:
        upstream_rows = upstream.num_rows
    upstream_folder = upstream.folder if upstream else None
    parameters = {"mode": _APPEND if adds else _OVERWRITE, "overwriteSchema": str(overwrite_schema).lower()}
    if layout:
        parameters["layout"] = ",".join(layout)
    record = {
        "version": F.lit(version),
        "timestamp": F.lit(committed_at or datetime.now(timezone.utc)),
        "operation": F.lit("WRITE"),
        "operationParameters": F.create_map(
            *[F.lit(x) for pair in parameters.items() for x in pair]
        ),
        "schema_json": F.lit(schema.json()),
        "num_rows": F.lit(num_rows),
        "in_memory_bytes": F.lit(size),
        "folder": F.lit(folder),
        "upstream_folder": F.lit(upstream_folder).cast("string"),
        "upstream_rows": F.lit(upstream_rows).cast("long"),
        "rejected_rows": F.lit(rejected).cast("long"),
    }
    if before_commit:
        before_commit(folder)
    _append_history(spark, path, record)
    return Commit(path, version, num_rows, size, schema, folder, upstream_folder, upstream_rows, rejected)


def read_commit(spark: SparkSession, commit: Commit) -> DataFrame:
    """The rows of one stored version; runs no job."""
    stored = spark.read.schema(commit.schema).parquet(f"{commit.path}/{commit.folder}")
    # columns that folders are named by come last
    return stored if stored.columns == commit.schema.names else stored.select(*map(named, commit.schema.names))


def read_commits(spark: SparkSession, commits: list[Commit]) -> DataFrame:
    """The rows of several versions of one table, which share their columns; runs no job."""
    if not commits:
        raise VersionNotFound("no version to read")
    return spark.read.schema(commits[-1].schema).parquet(*[f"{c.path}/{c.folder}" for c in commits])


def read_source_lines(spark: SparkSession, commit: Commit, source_line: str) -> DataFrame:
    """The rows of a stored version that kept their ``source_line``, with it as a last column."""
    schema = T.StructType([*commit.schema, T.StructField(source_line, T.StringType())])
    stored = spark.read.schema(schema).parquet(f"{commit.path}/{commit.folder}")
    return stored.where(F.col(source_line).isNotNull())


def read_snapshot(
    spark: SparkSession,
    path: str,
    *,
    version_as_of: int | None = None,
    timestamp_as_of: datetime | str | None = None,
) -> DataFrame:
    """The table's current rows, or those of an earlier version.

    ``timestamp_as_of`` picks the last version committed at or before that moment.
    """
    if version_as_of is not None and timestamp_as_of is not None:
        raise ValueError("give version_as_of or timestamp_as_of, not both")
    commits = _commits(spark, path)
    if version_as_of is not None:
        commits = commits.filter(F.col("version") == version_as_of)
    elif timestamp_as_of is not None:
        commits = commits.filter(F.col("timestamp") <= F.lit(timestamp_as_of).cast("timestamp"))
    commit = _newest(commits, path)
    if commit is None:
        wanted = next((w for w in (version_as_of, timestamp_as_of) if w is not None), "latest")
        raise VersionNotFound(f"no version {wanted} of {path}")
    return read_commit(spark, commit)


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """Version, commit time, operation, its parameters and row count, newest first."""
    return (
        _commits(spark, path)
        .select("version", "timestamp", "operation", "operationParameters", "num_rows")
        .orderBy(F.desc("version"))
    )
