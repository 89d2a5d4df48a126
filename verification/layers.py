"""The ten tables built once per application and scale, for queries on a single step."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tierstone import plans
from tierstone.operators.quality import AUDIT_TIMES
from tierstone.plans.fixed_values import ORDERS
from tierstone.sources import read_commits, read_snapshot, scratch_path
from verification.raw_tables import arrivals, landing


@cache
def _refreshed(spark: SparkSession, application: str, sf_dir: str) -> str:
    root = scratch_path(spark, "tables")
    plans.refresh(spark, landing(spark, sf_dir), root, count_source=True)
    return root


def tables_root(spark: SparkSession, sf_dir: str) -> str:
    return _refreshed(spark, spark.sparkContext.applicationId, sf_dir)


def stored(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_snapshot(spark, plans.table_path(tables_root(spark, sf_dir), table))


def stored_data(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table's rows without audit columns."""
    return stored(spark, sf_dir, table).drop(*AUDIT_TIMES, "source_file")


@cache
def _arrived(spark: SparkSession, application: str, sf_dir: str) -> str:
    root = scratch_path(spark, "arrivals")
    for _ in arrivals(spark, sf_dir, f"{root}/landing"):
        commit = plans.ingest_new(spark, f"{root}/landing", f"{root}/bronze", ORDERS)
        arrived = read_commits(spark, [commit])
        plans.merge_orders(spark, arrived, f"{root}/orders", buckets=16, upstream=commit)
        for key in ("customer_id", "product_id"):
            plans.merge_sales(spark, f"{root}/orders", f"{root}/sales_{key}", key)
    return root


def arrivals_root(spark: SparkSession, sf_dir: str) -> str:
    """Bronze orders, merged orders and partial sums after two arrivals."""
    return _arrived(spark, spark.sparkContext.applicationId, sf_dir)
