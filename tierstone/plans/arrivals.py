"""Daily arrivals: new files only, orders merged into what is stored, reports from partial sums.

Three tables, each of which costs what arrived and not what is stored::

    bronze   one version per arrival, its rows alone; the ledger says which files it was read from
    orders   one row per order id, in buckets by the hash of the id; an arrival rewrites the
             buckets that its ids fall into, as a version of ``orders/changes``, and
             ``orders/buckets`` lists per version where the rows of each bucket lie
    sales    one version per change of ``orders``: orders, amounts and exact totals per key that the
             change added or took away; a report adds them up

Results equal those of the full build, whatever the arrivals. One writer per table at a time; every
step can be repeated after a failure and then does what is missing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions import money, named
from tierstone.functions.fixed_values import COMPLETED
from tierstone.operators import completed_only, dedupe_by_key
from tierstone.operators.metrics import EXACT_DIGITS
from tierstone.plans.bronze import ingest
from tierstone.plans.fixed_values import ORDER_KEY
from tierstone.plans.silver import trusted_orders
from tierstone.sources import (
    Commit,
    all_commits,
    new_files,
    note_files,
    read_commits,
    write_snapshot,
)

# Buckets of a new table of orders. A bucket is rewritten whole, so it should hold about a hundred
# megabytes to a gigabyte: 1,024 serve up to a terabyte, 65,536 some 30 terabytes.
BUCKETS = 1024
# Rows that one task writes; a larger bucket is written by several.
ROWS_PER_FILE = 4_000_000

_BUCKET = "__bucket"
_PLACES = "version_folder string, bucket int, buckets int, folder string, rows long"
_GLOB = re.compile(r"([\\{}\[\]*?])")


def ingest_new(
    spark: SparkSession,
    files: str | list[str],
    table: str,
    schema: T.StructType | str | None = None,
    *,
    reread_changed: bool = False,
    **options,
) -> Commit | None:
    """Add the files that ``table`` has not taken in yet, as a version of their rows alone.

    None when nothing new arrived. Files are told by path, size and time; no old file is opened.
    A file that changed raises (:func:`tierstone.sources.new_files`). All versions together,
    ``read_commits(spark, all_commits(spark, table))``, are the bronze table of a full run.
    ``options`` are those of :func:`tierstone.plans.ingest`.
    """
    found = new_files(spark, files, table, reread_changed=reread_changed)
    arrived = found.collect()  # a listing, of the files that one arrival brought
    if not arrived:
        return None
    noted = spark.createDataFrame(arrived, found.schema)
    paths = [_GLOB.sub(r"\\\1", row["file"]) for row in sorted(arrived)]
    return ingest(
        spark, paths, table, schema, adds=True, before_commit=lambda folder: note_files(noted, table, folder), **options
    )


@dataclass(frozen=True)
class _Place:
    """Where the rows of one bucket lie."""

    bucket: int
    folder: str
    rows: int


def _bucket_of(keys: Iterable[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*map(named, keys)), F.lit(buckets)).cast("int")


def _places(spark: SparkSession, table: str, commit: Commit | None) -> tuple[dict[int, _Place], int | None]:
    """The buckets of one version, and how many the table has."""
    if commit is None:
        return {}, None
    lines = spark.read.schema(_PLACES).parquet(f"{table}/buckets").where(F.col("version_folder") == commit.folder)
    found = lines.distinct().collect()  # at most one line per bucket
    buckets = found[0]["buckets"] if found else None
    return {r["bucket"]: _Place(r["bucket"], r["folder"], r["rows"]) for r in found}, buckets


def _rows(spark: SparkSession, table: str, commit: Commit, places: Iterable[_Place]) -> DataFrame:
    paths = [f"{table}/changes/{p.folder}/{_BUCKET}={p.bucket}" for p in places]
    schema = T.StructType([f for f in commit.schema if f.name != _BUCKET])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_orders(
    spark: SparkSession,
    arrived: DataFrame,
    table: str,
    keys: list[str] = ORDER_KEY,
    *,
    buckets: int = BUCKETS,
    committed_at: datetime | None = None,
    upstream: Commit | None = None,
) -> Commit | None:
    """Merge rows into ``table``, which keeps one row per key; reads and rewrites only the buckets
    that their keys fall into. None when there are no rows.

    The first row of a key, by the order of :func:`tierstone.operators.dedupe_by_key`, is the first
    of the firsts of its arrivals, so the table equals a dedupe of all arrivals at once, also when
    rows arrive again. ``buckets`` is fixed by the first arrival. With ``upstream``, the version of
    bronze that ``arrived`` is, an arrival that was merged already is not merged again.
    """
    commits = all_commits(spark, f"{table}/changes")
    if upstream is not None and any(c.upstream_folder == upstream.folder for c in commits):
        return None
    latest = commits[-1] if commits else None
    places, stored = _places(spark, table, latest)
    buckets = stored or buckets
    bucketed = arrived.withColumn(_BUCKET, _bucket_of(keys, buckets))
    touched = {r[_BUCKET]: r["n"] for r in bucketed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not touched:
        return None
    old = [places[b] for b in touched if b in places]
    rows = bucketed
    if old:
        before = _rows(spark, table, latest, old).withColumn(_BUCKET, _bucket_of(keys, buckets))
        rows = before.unionByName(bucketed)
    # map tasks send one row per key at most, so that a key with a third of the rows is harmless;
    # the second exchange moves unique keys, to lay them out by bucket
    first = dedupe_by_key(rows, [_BUCKET, *keys])
    most = max(n + (places[b].rows if b in places else 0) for b, n in touched.items())
    part = F.pmod(F.shiftright(F.xxhash64(*map(named, keys)), 32), F.lit(-(-most // ROWS_PER_FILE)))
    laid_out = first.repartition(F.col(_BUCKET), part)

    def place(folder: str) -> None:
        written = spark.read.parquet(f"{table}/changes/{folder}").groupBy(F.col(_BUCKET).cast("int").alias("b"))
        counted = {r["b"]: r["n"] for r in written.agg(F.count(F.lit(1)).alias("n")).collect()}
        now = places | {b: _Place(b, folder, n) for b, n in counted.items()}
        lines = [(folder, p.bucket, buckets, p.folder, p.rows) for p in now.values()]
        spark.createDataFrame(lines, _PLACES).coalesce(1).write.mode("append").parquet(f"{table}/buckets")

    return write_snapshot(
        laid_out,
        f"{table}/changes",
        committed_at=committed_at,
        upstream=upstream,
        partition_by=_BUCKET,
        adds=True,
        before_commit=place,
    )


def merged_orders(spark: SparkSession, table: str) -> DataFrame:
    """The current rows of a table of :func:`merge_orders`: one per key."""
    commits = all_commits(spark, f"{table}/changes")
    places, _ = _places(spark, table, commits[-1] if commits else None)
    if not places:
        raise LookupError(f"no table at {table}")
    return _rows(spark, table, commits[-1], places.values())


def _partial(orders: DataFrame, key: str, sign: int, **options) -> DataFrame:
    """Completed orders per key, as numbers to be added up."""
    kept = completed_only(trusted_orders(orders, **options), COMPLETED)
    exact = F.col("amount").try_cast(f"decimal(38, {EXACT_DIGITS})")
    return kept.groupBy(key).agg(
        (F.count(F.lit(1)) * sign).alias("rows"),
        (F.count("order_id") * sign).alias("orders"),
        (F.count("amount") * sign).alias("amounts"),
        (F.count(exact) * sign).alias("exact_amounts"),
        (F.try_sum(exact) * sign).cast(f"decimal(38, {EXACT_DIGITS})").alias("total"),
        (F.sum("amount") * sign).alias("rough_total"),
    )


def _added(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("rows", "orders", "amounts", "exact_amounts")],
        F.try_sum("total").cast(f"decimal(38, {EXACT_DIGITS})").alias("total"),
        F.sum("rough_total").alias("rough_total"),
    )


def merge_sales(spark: SparkSession, orders_table: str, table: str, key: str, **options) -> list[Commit]:
    """Bring the partial sums per ``key`` up to the current orders; the versions that were added.

    For each change of ``orders_table`` that has none yet: what its buckets hold now, less what they
    held before. Other buckets are not read. ``options`` are those of
    :func:`tierstone.plans.trusted_orders`.
    """
    changes = all_commits(spark, f"{orders_table}/changes")
    done = {c.upstream_folder for c in all_commits(spark, table)}
    before: Commit | None = None
    added = []
    for change in changes:
        if change.folder not in done:
            old, _ = _places(spark, orders_table, before)
            now, _ = _places(spark, orders_table, change)
            new = [p for p in now.values() if p.folder == change.folder]
            parts = _partial(_rows(spark, orders_table, change, new), key, 1, **options)
            replaced = [old[p.bucket] for p in new if p.bucket in old]
            if replaced:
                lost = _partial(_rows(spark, orders_table, before, replaced), key, -1, **options)
                parts = _added(parts.unionByName(lost), key)
            added.append(write_snapshot(parts, table, upstream=change, adds=True))
        before = change
    return added


def merged_sales(
    spark: SparkSession, table: str, key: str, by: str | None = None, lookup: DataFrame | None = None
) -> DataFrame:
    """Orders, revenue and average order value per ``key``, from the partial sums alone.

    With ``lookup``, which has ``key`` and ``by``, the report is per ``by``; keys that it lacks are
    null there, and one that it repeats counts as often, as in the full build. The sums are joined
    one row per key, so the lookup meets no order.
    """
    sums = _added(read_commits(spark, all_commits(spark, table)), key).where(F.col("rows") > 0)
    if by is not None:
        sums = _added(sums.join(lookup.select(key, by), key, "left"), by)
    # amounts that no decimal holds make the total a sum of doubles, as in exact_sum
    exact = F.when((F.col("exact_amounts") == F.col("amounts")), F.col("total").cast("double"))
    total = F.coalesce(exact, F.col("rough_total"))
    average = F.when(F.col("amounts") > 0, total / F.col("amounts"))
    return sums.select(
        by or key,
        F.col("orders").alias("total_orders"),
        money(total).alias("total_revenue"),
        money(average).alias("avg_order_value"),
    )
