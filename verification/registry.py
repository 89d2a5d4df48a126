"""One query per operator and table build, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone import plans
from tierstone.functions import as_type, parse_day
from tierstone.operators import (
    completed_only,
    customer_spend,
    dedupe_by_key,
    dense_rank_global,
    fill_defaults,
    flag_quality,
    lookup_join,
    removed_rows,
    require_not_null,
    sales_by,
)
from tierstone.plans.fixed_values import (
    CRITICAL,
    CUSTOMERS,
    CUSTOMER_KEYS,
    NO_AMOUNT,
    ORDER_KEY,
    ORDERS,
    PRODUCT_KEYS,
    PRODUCTS,
    UNKNOWN_STATUS,
)
from tierstone.plans.silver import normalised_customers, order_issues
from tierstone.sources import (
    all_commits,
    expire_snapshots,
    file_ledger,
    infer_schema,
    landing_inventory,
    lock_schema,
    read_commits,
    read_snapshot,
    scan_csv,
    scratch_path,
    snapshot_history,
    write_snapshot,
)
from verification.layers import arrivals_root, stored, stored_data, tables_root
from verification.raw_tables import landing, spoilt_orders, write_csv

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

_DEFAULTS = {"status": UNKNOWN_STATUS, "amount": NO_AMOUNT}
_FIRST_COMMIT = datetime(2024, 1, 1, tzinfo=timezone.utc)
_SECOND_COMMIT = datetime(2024, 2, 1, tzinfo=timezone.utc)
_BETWEEN = datetime(2024, 1, 15, tzinfo=timezone.utc)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _QUERIES[name] = build
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def shown(df: DataFrame) -> DataFrame:
    """Audit times differ per run: show only that they are set."""
    for name in ("ingestion_timestamp", "updated_timestamp"):
        if name in df.columns:
            df = df.withColumn(f"has_{name}", F.col(name).isNotNull()).drop(name)
    return df


# --- sources ---------------------------------------------------------------------------


@query("bronze_rejects")
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that don't fit the declared schema, with the order they came with."""
    files = write_csv(spoilt_orders(spark, sf_dir), scratch_path(spark, "spoilt"))
    commit = plans.ingest(spark, files, scratch_path(spark, "rejects"), ORDERS, source_file="orders.csv")
    found = plans.rejected_values(spark, commit)
    order_id = F.nullif(F.split_part("line", F.lit(","), F.lit(1)), F.lit(""))
    return found.select(order_id.alias("order_id"), "source_file", "column", "value", "expected")



@query("csv_declared_schema")
def csv_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, landing(spark, sf_dir).orders, ORDERS)


@query("csv_inferred_schema")
def csv_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing(spark, sf_dir).customers
    return scan_csv(spark, files, infer_schema(spark, files))


@query("csv_locked_schema")
def csv_locked_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, lock = landing(spark, sf_dir).customers, scratch_path(spark, "lock")
    lock_schema(spark, files, lock, overrides=CUSTOMER_KEYS)
    return scan_csv(spark, files, lock_schema(spark, files, lock))


@query("landing_inventory")
def landing_inventory_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing held against the files that the rows of each extract were read from."""
    raw = landing(spark, sf_dir)
    listed = landing_inventory(spark, [raw.orders, raw.customers, raw.products])
    extracts = {
        "orders": (raw.orders, ORDERS),
        "customers": (raw.customers, CUSTOMERS),
        "products": (raw.products, PRODUCTS),
    }
    read = [
        scan_csv(spark, files, schema)
        .groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("extract", F.lit(name))
        for name, (files, schema) in extracts.items()
    ]
    # listed and read paths spell the scheme differently
    bare = F.regexp_replace("path", "^file:/+", "/")
    listed = listed.select(bare.alias("listed"), "length")
    found = reduce(DataFrame.unionByName, read).withColumn("listed", bare).join(listed, "listed", "left")
    return found.groupBy("extract").agg(
        F.sum("rows").alias("rows_read"),
        F.every(F.col("length").isNotNull()).alias("every_file_listed"),
        F.every(F.coalesce(F.col("length") == F.col("size"), F.lit(False))).alias("sizes_equal"),
    )


@query("bronze_audit_columns")
def bronze_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landing(spark, sf_dir)
    return shown(plans.bronze_rows(spark, raw.orders, ORDERS, source_file="orders.csv"))


def _ingested(spark: SparkSession, sf_dir: str, entity: str, **options) -> DataFrame:
    raw, table = landing(spark, sf_dir), scratch_path(spark, f"bronze_{entity}")
    plans.ingest(spark, getattr(raw, entity), table, source_file=raw.label(entity), **options)
    return shown(read_snapshot(spark, table))


@query("bronze_orders")
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, "orders", schema=ORDERS)


@query("bronze_customers")
def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, "customers", overrides=CUSTOMER_KEYS)


@query("bronze_products")
def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, "products", overrides=PRODUCT_KEYS, overwrite_schema=True)


# --- versioned tables ------------------------------------------------------------------


@query("snapshot_roundtrip")
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "silver_orders")
    write_snapshot(stored_data(spark, sf_dir, "silver_orders"), table)
    return read_snapshot(spark, table)


@query("snapshot_rerun_idempotent")
def snapshot_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "silver_orders")
    for _ in range(2):
        write_snapshot(stored_data(spark, sf_dir, "silver_orders"), table)
    return read_snapshot(spark, table)


def _restated_products(spark: SparkSession, sf_dir: str) -> str:
    """Version 0: the products; version 1: the same with one more column."""
    table = scratch_path(spark, "products")
    raw = scan_csv(spark, landing(spark, sf_dir).products, PRODUCTS)
    write_snapshot(raw, table, committed_at=_FIRST_COMMIT)
    wider = raw.withColumn("department", F.upper("category"))
    write_snapshot(wider, table, overwrite_schema=True, committed_at=_SECOND_COMMIT)
    return table


@query("snapshot_schema_change")
def snapshot_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshot(spark, _restated_products(spark, sf_dir))


@query("snapshot_version_as_of")
def snapshot_version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshot(spark, _restated_products(spark, sf_dir), version_as_of=0)


@query("snapshot_timestamp_as_of")
def snapshot_timestamp_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshot(spark, _restated_products(spark, sf_dir), timestamp_as_of=_BETWEEN)


@query("snapshot_history")
def snapshot_history_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _restated_products(spark, sf_dir)
    return snapshot_history(spark, table).select(
        "version",
        "operation",
        F.col("operationParameters")["mode"].alias("mode"),
        F.col("operationParameters")["overwriteSchema"].alias("schema_changed"),
        "num_rows",
        F.col("timestamp").isNotNull().alias("has_timestamp"),
    )


@query("snapshot_expiry")
def snapshot_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of a table whose first version has expired."""
    table = _restated_products(spark, sf_dir)
    expire_snapshots(spark, table, keep_last=1)
    kept = read_snapshot(spark, table).agg(F.count(F.lit(1)).alias("rows_kept"), F.count("department").alias("departments"))
    return snapshot_history(spark, table).select("version", "operation", "num_rows").crossJoin(kept)


@cache
def _by_month(spark: SparkSession, application: str, sf_dir: str) -> str:
    table = scratch_path(spark, "orders_by_month")
    orders = stored_data(spark, sf_dir, "silver_orders").withColumn("order_month", F.trunc("order_date", "MM"))
    write_snapshot(orders, table, layout=["order_month", "status"])
    return table


@query("layout_all_orders")
def layout_all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored in a folder per month and status, read back."""
    return read_snapshot(spark, _by_month(spark, spark.sparkContext.applicationId, sf_dir))


@query("layout_completed_of_a_month")
def layout_completed_of_a_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed orders of one month, from its folder alone."""
    orders = layout_all_orders(spark, sf_dir)
    return completed_only(orders).where("order_month = date'1997-03-01'")


# --- single steps ----------------------------------------------------------------------


@query("filter_completed")
def filter_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed_only(stored_data(spark, sf_dir, "bronze_orders"))


@query("drop_critical_nulls")
def drop_critical_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_not_null(stored_data(spark, sf_dir, "bronze_orders"), CRITICAL)


@query("fill_defaults")
def fill_defaults_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_defaults(stored_data(spark, sf_dir, "bronze_orders"), _DEFAULTS)


@query("dedupe_orders")
def dedupe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_by_key(stored_data(spark, sf_dir, "bronze_orders"), ORDER_KEY)


@query("parse_order_date")
def parse_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "bronze_orders").select(
        "order_id",
        F.col("order_date").alias("order_date_text"),
        parse_day(F.col("order_date")).alias("order_date"),
    )


@query("cast_numeric")
def cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From text, with some quantities that are no numbers."""
    qty = F.col("quantity")
    text = F.when(qty == 50, "fifty").otherwise(qty.cast("string"))
    return stored(spark, sf_dir, "bronze_orders").select(
        "order_id",
        as_type(text, "int").alias("quantity"),
        as_type(F.col("amount").cast("string"), "double").alias("amount"),
    )


@query("quality_flag")
def quality_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_defaults(stored(spark, sf_dir, "bronze_orders"), _DEFAULTS)
    flagged = flag_quality(filled, order_issues("post_fill"))
    return flagged.select("order_id", "amount", "status", "data_quality_flag")


@query("quality_flag_prefill")
def quality_flag_prefill(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_quality(stored(spark, sf_dir, "bronze_orders"), order_issues("pre_fill"))
    return fill_defaults(flagged, _DEFAULTS).select(
        "order_id", "amount", "status", "data_quality_flag"
    )


@query("normalise_customers")
def normalise_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalised_customers(stored_data(spark, sf_dir, "bronze_customers"))


# --- silver ----------------------------------------------------------------------------


@query("silver_orders")
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(plans.silver_orders(stored(spark, sf_dir, "bronze_orders")))


@query("silver_customers")
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(plans.silver_customers(stored(spark, sf_dir, "bronze_customers")))


@query("silver_products")
def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(plans.silver_products(stored(spark, sf_dir, "bronze_products")))


@query("removed_orders")
def removed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw order that the cleaning removes, with the rule and the copy that survived."""
    return removed_rows(stored_data(spark, sf_dir, "bronze_orders"), ORDER_KEY, CRITICAL)


@query("removed_orders_large_lookup")
def removed_orders_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the surviving copies are beyond the broadcast bound, one row counts as hot."""
    bronze = stored_data(spark, sf_dir, "bronze_orders")
    return removed_rows(bronze, ORDER_KEY, CRITICAL, broadcast="never", min_hot_rows=2)


# --- arrivals --------------------------------------------------------------------------


@query("arrivals_ledger")
def arrivals_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each arrival, and whether every file of it is in the ledger under its version."""
    table = f"{arrivals_root(spark, sf_dir)}/bronze"
    files = file_ledger(spark, table).groupBy("version").agg(F.countDistinct("file").alias("files"))
    arrivals = reduce(
        DataFrame.unionByName,
        [
            read_commits(spark, [c])
            .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("source_file").alias("read"))
            .withColumn("version", F.lit(c.version).cast("long"))
            for c in all_commits(spark, table)
        ],
    )
    return arrivals.join(files, "version").select(
        "version", "rows", (F.col("files") >= F.col("read")).alias("all_noted")
    )


@query("arrivals_bronze_orders")
def arrivals_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{arrivals_root(spark, sf_dir)}/bronze"
    return shown(read_commits(spark, all_commits(spark, table))).drop("source_file")


@query("arrivals_dedupe_orders")
def arrivals_dedupe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders merged over two arrivals, the second of which brings some rows again."""
    merged = plans.merged_orders(spark, f"{arrivals_root(spark, sf_dir)}/orders")
    return shown(merged).drop("source_file")


def _arrived_sales(spark: SparkSession, sf_dir: str, key: str, by: str, lookup: str) -> DataFrame:
    sums = f"{arrivals_root(spark, sf_dir)}/sales_{key}"
    return plans.merged_sales(spark, sums, key, by, stored(spark, sf_dir, lookup))


@query("arrivals_sales_by_city")
def arrivals_sales_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrived_sales(spark, sf_dir, "customer_id", "city", "silver_customers")


@query("arrivals_sales_by_category")
def arrivals_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrived_sales(spark, sf_dir, "product_id", "category", "silver_products")


@query("arrivals_sales_by_customer")
def arrivals_sales_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.merged_sales(spark, f"{arrivals_root(spark, sf_dir)}/sales_customer_id", "customer_id")


# --- gold ------------------------------------------------------------------------------


@query("join_customers_left")
def join_customers_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stored(spark, sf_dir, "silver_orders").select("order_id", "customer_id", "amount")
    customers = stored(spark, sf_dir, "silver_customers")
    return lookup_join(orders, customers, "customer_id", ["customer_name", "city"])


@query("join_products_left")
def join_products_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stored(spark, sf_dir, "silver_orders").select("order_id", "product_id", "amount")
    products = stored(spark, sf_dir, "silver_products")
    return lookup_join(orders, products, "product_id", ["product_name", "category"])


@query("join_large_lookup")
def join_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a lookup beyond the broadcast bound, with some keys taken as hot."""
    orders = stored(spark, sf_dir, "silver_orders").select("order_id", "customer_id", "amount")
    return lookup_join(
        orders,
        stored(spark, sf_dir, "silver_customers"),
        "customer_id",
        ["customer_name", "city"],
        broadcast="never",
        min_hot_rows=50,
    )


def _null_keys(spark: SparkSession, sf_dir: str, broadcast: str) -> DataFrame:
    """Bronze orders still have rows without a customer: they match nothing, and stay."""
    orders = stored(spark, sf_dir, "bronze_orders").select("order_id", "customer_id", "amount")
    customers = stored(spark, sf_dir, "silver_customers")
    return lookup_join(
        orders, customers, "customer_id", ["customer_name", "city"], broadcast=broadcast, min_hot_rows=50
    )


@query("join_null_keys")
def join_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_keys(spark, sf_dir, "auto")


@query("join_null_keys_large_lookup")
def join_null_keys_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_keys(spark, sf_dir, "never")


@query("gold_enriched_large_lookups")
def gold_enriched_large_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star join with both lookups beyond the broadcast bound."""
    return shown(
        plans.enrich_orders(
            stored(spark, sf_dir, "silver_orders"),
            stored(spark, sf_dir, "silver_customers"),
            stored(spark, sf_dir, "silver_products"),
            broadcast="never",
            min_hot_rows=50,
        )
    )


@query("gold_enriched_orders")
def gold_enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        plans.enrich_orders(
            stored(spark, sf_dir, "silver_orders"),
            stored(spark, sf_dir, "silver_customers"),
            stored(spark, sf_dir, "silver_products"),
        )
    )


@query("sales_by_city")
def sales_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by(stored(spark, sf_dir, "gold_enriched_orders"), "city")


@query("sales_by_category")
def sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by(stored(spark, sf_dir, "gold_enriched_orders"), "category")


@query("customer_spend")
def customer_spend_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_spend(stored(spark, sf_dir, "gold_enriched_orders"))


@query("top_customers")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_customers(stored(spark, sf_dir, "gold_enriched_orders"))


@query("top_customers_k")
def top_customers_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_customers(stored(spark, sf_dir, "gold_enriched_orders"), k=10)


@query("top_customers_distributed")
def top_customers_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking plan for tables too large for one task."""
    return plans.top_customers(stored(spark, sf_dir, "gold_enriched_orders"), buckets=16)


@query("dense_rank_distributed")
def dense_rank_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-task ranking over every raw order: many ties, a hot value, nulls."""
    amounts = stored(spark, sf_dir, "bronze_orders").select("order_id", "amount")
    return dense_rank_global(amounts, "amount", "amount_rank", buckets=64)


@query("dense_rank_text")
def dense_rank_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stored(spark, sf_dir, "bronze_orders").select("order_id", "amount", "product_id")
    return dense_rank_global(orders, "product_id", "product_rank", buckets=16)


@query("dense_rank_date")
def dense_rank_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stored(spark, sf_dir, "silver_orders").select("order_id", "order_date")
    return dense_rank_global(orders, "order_date", "day_rank", buckets=16)


# --- all layers ------------------------------------------------------------------------


@query("layer_audit")
def layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.layer_audit(spark, tables_root(spark, sf_dir), read_back=True)


@query("end_to_end_sales")
def end_to_end_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to the three gold reports, through all ten stored tables."""
    root = scratch_path(spark, "tables")
    plans.refresh(spark, landing(spark, sf_dir), root)

    def report(table: str, name: str, key: str, **columns) -> DataFrame:
        return read_snapshot(spark, plans.table_path(root, table)).select(
            F.lit(name).alias("report"),
            F.col(key).alias("key"),
            columns.get("rank", F.lit(None).cast("int")).alias("rank"),
            "total_orders",
            columns["total"].alias("total"),
            columns.get("average", F.lit(None).cast("double")).alias("avg_order_value"),
        )

    sales = {"total": F.col("total_revenue"), "average": F.col("avg_order_value")}
    return (
        report("gold_sales_by_city", "city", "city", **sales)
        .unionByName(report("gold_sales_by_category", "category", "category", **sales))
        .unionByName(
            report(
                "gold_top_customers",
                "customer",
                "customer_id",
                total=F.col("total_spent"),
                rank=F.col("rank"),
            )
        )
    )
