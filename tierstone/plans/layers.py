"""The whole refresh: raw files to bronze, silver and gold tables, and its audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tierstone.operators import sales_by
from tierstone.plans.bronze import ingest
from tierstone.plans.fixed_values import CUSTOMER_KEYS, ORDERS, PRODUCT_KEYS
from tierstone.plans.gold import enrich_orders, top_customers
from tierstone.plans.sizing import shuffles_sized_for, splits_sized_for, total_bytes
from tierstone.plans.silver import silver_customers, silver_orders, silver_products
from tierstone.sources import Commit, latest_commit, read_commit, shuffles_removed, write_snapshot

# Table -> the table its rows come from; None for raw files.
UPSTREAM = {
    "bronze_orders": None,
    "bronze_customers": None,
    "bronze_products": None,
    "silver_orders": "bronze_orders",
    "silver_customers": "bronze_customers",
    "silver_products": "bronze_products",
    "gold_enriched_orders": "silver_orders",
    "gold_sales_by_city": "gold_enriched_orders",
    "gold_sales_by_category": "gold_enriched_orders",
    "gold_top_customers": "gold_enriched_orders",
}


@dataclass(frozen=True)
class Landing:
    """Where the raw CSV files lie; each may be a file, a folder or a list of either.

    ``label_files`` stamps rows with the fixed labels below; otherwise every row carries
    the name of the file it came from.
    """

    orders: str | list[str]
    customers: str | list[str]
    products: str | list[str]
    label_files: bool = False

    def label(self, entity: str) -> str | None:
        return f"{entity}.csv" if self.label_files else None


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def refresh(
    spark: SparkSession,
    landing: Landing,
    root: str,
    *,
    at: datetime | None = None,
    flag_mode: str = "post_fill",
    overwrite_schema: bool = False,
    strict_header: bool = True,
    corrupt_column: str | None = None,
    count_source: bool = False,
    orders_layout: Sequence[str] = (),
) -> dict[str, Commit]:
    """Rebuild all ten tables under ``root`` from the raw files; returns their commits.

    Every layer is written before the next one reads it, and reads only the layer below,
    so each table is computed once and a lost executor costs at most part of one step.
    ``at`` fixes the audit time of the whole run. Files with other columns than the declared
    or locked ones raise; ``overwrite_schema`` lets them bring changed columns, and
    ``strict_header=False`` reads by position whatever the headers say. ``corrupt_column`` keeps
    the text of malformed lines in the bronze tables. ``count_source`` counts the files' lines
    apart, so that the audit can tell a row that was lost in reading. ``orders_layout`` stores
    silver orders in a folder per value of some columns, ``("order_date", "status")`` say, at the
    price of one more shuffle: queries of a few days then read those days alone, and the gold
    tables the completed orders. Safe to run again: it adds versions.

    Task sizes are set in a session of its own, a copy of the caller's, which stays as it is.
    """
    spark = _own_session(spark)
    done: dict[str, Commit] = {}
    commit = {"committed_at": at, "overwrite_schema": overwrite_schema}

    def ingested(table: str, files: str | list[str], **options) -> Commit:
        label = landing.label(table.removeprefix("bronze_"))
        options |= {"source_file": label, "ingested_at": at, "strict_header": strict_header}
        options |= {"corrupt_column": corrupt_column, "count_source": count_source}
        return ingest(spark, files, table_path(root, table), **options, **commit)

    def saved(table: str, rows: DataFrame, layout: Sequence[str] = ()) -> Commit:
        return write_snapshot(rows, table_path(root, table), upstream=done[UPSTREAM[table]], layout=layout, **commit)

    def read(table: str) -> DataFrame:
        rows = read_commit(spark, done[table])
        return rows.drop(corrupt_column) if corrupt_column else rows

    def build(**steps: Callable[[str], Commit]) -> None:
        """Tables that do not depend on each other, so their jobs share the cluster."""
        with ThreadPoolExecutor(len(steps)) as pool:
            running = {table: pool.submit(step, table) for table, step in steps.items()}
        done.update({table: job.result() for table, job in running.items()})

    with shuffles_removed(spark), splits_sized_for(spark, total_bytes(spark, landing.orders)):
        build(
            bronze_orders=lambda t: ingested(t, landing.orders, schema=ORDERS),
            bronze_customers=lambda t: ingested(t, landing.customers, overrides=CUSTOMER_KEYS),
            bronze_products=lambda t: ingested(t, landing.products, overrides=PRODUCT_KEYS),
        )
        with shuffles_sized_for(spark, done["bronze_orders"].in_memory_bytes):
            build(
                silver_orders=lambda t: saved(
                    t, silver_orders(read("bronze_orders"), flag_mode=flag_mode, updated_at=at), orders_layout
                ),
                silver_customers=lambda t: saved(
                    t, silver_customers(read("bronze_customers"), updated_at=at)
                ),
                silver_products=lambda t: saved(
                    t, silver_products(read("bronze_products"), updated_at=at)
                ),
            )
            enriched = enrich_orders(
                read("silver_orders"),
                read("silver_customers"),
                read("silver_products"),
                customer_bytes=done["silver_customers"].in_memory_bytes,
                product_bytes=done["silver_products"].in_memory_bytes,
                updated_at=at,
            )
            build(gold_enriched_orders=lambda t: saved(t, enriched))
            sales = read("gold_enriched_orders")
            # Tables hold no row order, so none is paid for here; readers sort.
            build(
                gold_sales_by_city=lambda t: saved(t, sales_by(sales, "city", ordered=False)),
                gold_sales_by_category=lambda t: saved(
                    t, sales_by(sales, "category", ordered=False)
                ),
                gold_top_customers=lambda t: saved(t, top_customers(sales, ordered=False)),
            )
    return done


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, whose changes nobody else sees."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def layer_audit(spark: SparkSession, root: str, *, read_back: bool = False) -> DataFrame:
    """Rows in, out and removed per table, for its current version.

    ``rows_in`` is what the commit recorded: the rows of the version that it was built from, or
    the lines counted in the files; null where the files were not counted. ``follows`` tells
    whether that version is still the current one of the table above, so that numbers of
    different refreshes are not taken for one. ``read_back`` counts the stored rows again, in
    ``rows_stored``, from the files.
    """
    current = {t: latest_commit(spark, table_path(root, t)) for t in UPSTREAM}
    lines = []
    for table, upstream in UPSTREAM.items():
        commit = current[table]
        rows_in, rows_out = commit.upstream_rows, commit.num_rows
        follows = upstream is None or commit.upstream_folder == current[upstream].folder
        stored = read_commit(spark, commit).count() if read_back else None
        removed = None if rows_in is None else rows_in - rows_out
        lines.append((table, table.split("_")[0], rows_in, rows_out, removed, follows, stored))
    return spark.createDataFrame(
        lines,
        "table string, layer string, rows_in long, rows_out long, rows_removed long,"
        " follows boolean, rows_stored long",
    )
