"""Bronze: files as they arrive, plus where and when each row came from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.sources import (
    Commit,
    SchemaChanged,
    count_lines,
    latest_commit,
    lock_schema,
    read_source_lines,
    scan_csv,
    schema_by_header,
    with_ingest_audit,
    write_snapshot,
)

# Stored beside bronze rows: the line of a row whose values do not all fit the schema.
SOURCE_LINE = "__source_line"
_AUDIT = ("ingestion_timestamp", "source_file")


def bronze_rows(
    spark: SparkSession,
    files: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    lock_path: str | None = None,
    renew_lock: bool = False,
    overrides: Mapping[str, str] | None = None,
    sampling_ratio: float = 1.0,
    source_file: str | None = None,
    ingested_at: datetime | None = None,
    strict_header: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """The files' rows under a declared ``schema``, or one locked at ``lock_path``."""
    if schema is None:
        if lock_path is None:
            raise ValueError("give a schema, or a lock_path to keep the inferred one")
        schema = lock_schema(
            spark,
            files,
            lock_path,
            sampling_ratio=sampling_ratio,
            overrides=overrides,
            renew=renew_lock,
        )
    rows = scan_csv(
        spark, files, schema, strict_header=strict_header, corrupt_column=corrupt_column
    )
    return with_ingest_audit(rows, source_file, ingested_at)


def ingest(
    spark: SparkSession,
    files: str | list[str],
    table: str,
    schema: T.StructType | str | None = None,
    *,
    overwrite_schema: bool = False,
    committed_at: datetime | None = None,
    count_source: bool = False,
    keep_rejects: bool = True,
    adds: bool = False,
    before_commit: Callable[[str], None] | None = None,
    **options,
) -> Commit:
    """Replace bronze ``table`` by the files' rows: one pass over the files, no shuffle.

    Without ``schema`` it is inferred once and locked next to the table's data. Files whose
    header differs from the schema raise :class:`SchemaChanged`. ``overwrite_schema`` takes the
    files' columns as they are: a declared schema is put in their order, a locked one inferred
    again. Values that do not fit their column are null in it; their lines are kept for
    :func:`rejected_values` and counted in the commit, in the same pass, unless ``keep_rejects`` is
    off. ``count_source`` counts the files' lines in a pass of its own, for the audit.
    ``adds`` and ``before_commit`` are those of :func:`tierstone.sources.write_snapshot`, ``options``
    those of :func:`bronze_rows`.
    """
    if schema is None:
        options.setdefault("lock_path", f"{table}/schema_lock")
        options.setdefault("renew_lock", overwrite_schema)
    elif overwrite_schema and options.get("strict_header", True):
        schema = schema_by_header(spark, files, schema)
    keep = keep_rejects and not options.get("corrupt_column")
    if keep:
        options["corrupt_column"] = SOURCE_LINE
    rows = bronze_rows(spark, files, schema, **options)
    try:
        return write_snapshot(
            rows,
            table,
            overwrite_schema=overwrite_schema,
            committed_at=committed_at,
            upstream_rows=count_lines(spark, files) if count_source else None,
            source_line=SOURCE_LINE if keep else None,
            adds=adds,
            before_commit=before_commit,
        )
    except (PySparkException, Py4JJavaError) as e:
        if "CSV header" in str(e):  # of a file after the first, found by the task that reads it
            raise SchemaChanged(f"{files}: files differ in their columns") from e
        raise


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def rejected_values(spark: SparkSession, table: str | Commit) -> DataFrame:
    """What arrived in a bronze table's files but did not fit its columns, one row per value:
    ``source_file, line, column, value, expected``.

    A line with another number of fields than the table has columns has one row, without a column.
    Reads the kept lines of the current version (or of the given commit) alone.
    """
    commit = table if isinstance(table, Commit) else latest_commit(spark, table)
    data = [f for f in commit.schema if f.name not in _AUDIT]
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in data])
    lines = read_source_lines(spark, commit, SOURCE_LINE).withColumn("__texts", F.from_csv(SOURCE_LINE, _ddl(texts)))

    def value(field: T.StructField) -> Column:
        text = F.col("__texts").getField(field.name)
        lost = text.isNotNull() & F.col(f"`{field.name}`").isNull()
        return F.when(lost, F.struct(F.lit(field.name).alias("column"), text.alias("value"), F.lit(field.dataType.simpleString()).alias("expected")))

    found = F.array_compact(F.array(*[value(f) for f in data]))
    other = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), F.lit(f"{len(data)} fields").alias("expected"))
    rows = lines.select("source_file", F.col(SOURCE_LINE).alias("line"), F.when(F.size(found) > 0, found).otherwise(F.array(other)).alias("__found"))
    return rows.select("source_file", "line", F.explode("__found").alias("__r")).select("source_file", "line", "__r.*")
