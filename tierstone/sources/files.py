"""Raw files: CSV scans, schema inference and locking, landing-zone listing."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions import audit_time

_LOCK = "schema_json string"


class SchemaChanged(ValueError):
    """Columns differ from the declared, locked or stored ones and no change was requested."""


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    *,
    strict_header: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read CSV files with a header row under a declared schema; no inference pass.

    Columns are matched by position, so every file's header must name the schema's columns in
    its order, and no others: a first look at the files raises :class:`SchemaChanged`, and a
    later file with another header fails the task that reads it. ``strict_header=False`` reads
    by position whatever the headers say. ``corrupt_column`` adds the raw text of lines that
    do not fit the schema; without it their bad fields are just null.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if strict_header:
        check_header(spark, path, schema.names)
    reader = spark.read.option("header", True).option("enforceSchema", not strict_header)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def header_names(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names in the header of the files; reads the first line of the first one."""
    return spark.read.option("header", True).csv(path).columns


def check_header(spark: SparkSession, path: str | list[str], names: list[str]) -> None:
    found = header_names(spark, path)
    # files without a line have no header to differ
    if found and [c.lower() for c in found] != [c.lower() for c in names]:
        raise SchemaChanged(f"{path}: the files have columns {found}, expected {list(names)}")


def schema_by_header(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> T.StructType:
    """``schema`` in the order of the files' header: known columns keep their type, new ones
    are text, and missing ones are left out."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    known = {f.name.lower(): f.dataType for f in schema}
    return T.StructType(
        [T.StructField(c, known.get(c.lower(), T.StringType())) for c in header_names(spark, path)]
    )


def count_lines(spark: SparkSession, path: str | list[str]) -> int:
    """Rows in the files by their lines: all that are not blank, less a header per file.

    A pass of its own that parses nothing, to hold a CSV read against. Rows that span lines
    count once per line.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum(F.col("n") - 1)).first()[0] or 0


def infer_schema(
    spark: SparkSession,
    path: str | list[str],
    *,
    sampling_ratio: float = 1.0,
    overrides: Mapping[str, str] | None = None,
) -> T.StructType:
    """Infer a CSV schema from the data, then apply ``overrides`` (column -> type).

    Inference reads ``sampling_ratio`` of the lines. Override join keys to ``string``:
    digits-only keys would otherwise become numbers in one table and text in another.
    """
    found = (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
        .schema
    )
    overrides = dict(overrides or {})
    unknown = set(overrides) - set(found.names)
    if unknown:
        raise ValueError(f"no such columns in {path}: {sorted(unknown)}; have {found.names}")
    declared = {c: T.StructType.fromDDL(f"c {ddl}")[0].dataType for c, ddl in overrides.items()}
    return T.StructType(
        [T.StructField(f.name, declared.get(f.name, f.dataType), True) for f in found]
    )


def lock_schema(
    spark: SparkSession,
    path: str | list[str],
    lock_path: str,
    *,
    sampling_ratio: float = 1.0,
    overrides: Mapping[str, str] | None = None,
    renew: bool = False,
) -> T.StructType:
    """The schema stored at ``lock_path``; inferred from ``path`` and stored when absent.

    Only the first run pays for the inference scan, and later files cannot drift the types.
    ``renew`` infers again and replaces the lock, for an intended schema change.
    """
    # "ignore" leaves an existing lock alone without running a job.
    spark.createDataFrame([], _LOCK).write.mode("ignore").parquet(lock_path)
    stored = spark.read.schema(_LOCK).parquet(lock_path).first()
    if stored is not None and not renew:
        return T.StructType.fromJson(json.loads(stored["schema_json"]))
    schema = infer_schema(spark, path, sampling_ratio=sampling_ratio, overrides=overrides)
    lock = spark.range(1, numPartitions=1).select(F.lit(schema.json()).alias("schema_json"))
    lock.write.mode("overwrite").parquet(lock_path)
    return schema


def landing_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path, size in bytes and modification time of every file below ``path``.

    Listing only: the pruned ``content`` column keeps Spark from opening the files.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def with_ingest_audit(
    df: DataFrame, source_file: str | None = None, ingested_at: datetime | None = None
) -> DataFrame:
    """Add when and from which file each row arrived.

    ``source_file`` labels all rows; by default each row carries the name of the file it
    was actually read from.
    """
    name = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return df.withColumns({"ingestion_timestamp": audit_time(ingested_at), "source_file": name})
