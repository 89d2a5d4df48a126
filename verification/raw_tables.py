"""Raw order, customer and product extracts derived from the given star-schema tables.

The given tables are clean; real extracts are not. So values (never rows) are spoilt by
conditions on the data: missing keys, statuses and amounts, unknown keys, unparseable days,
odd status spelling, untidy names. Every row of every table is used. Line numbers repeat
within an order, which gives natural duplicates with differing content.

``verification.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.plans import Landing
from tierstone.sources import scratch_path, shuffles_removed


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    heads = _table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    qty, tax, discount = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount")
    returned, state = F.col("l_returnflag"), F.col("o_orderstatus")

    no_id = (qty == 17) & (tax == 0.08) & (discount == 0)
    customer = (
        F.when(qty == 13, None)
        .when((qty == 7) & (returned == "R"), F.concat(F.lit("X"), _text("o_custkey")))
        .otherwise(_text("o_custkey"))
    )
    product = (
        F.when(qty == 29, None)
        .when((qty == 11) & (returned == "A"), F.concat(F.lit("X"), _text("l_partkey")))
        .otherwise(_text("l_partkey"))
    )
    status = (
        F.when(tax == 0, None)
        .when((state == "F") & (qty == 43), "Completed")
        .when((state == "O") & (qty == 49) & (discount == 0), "unknown")
        .when(state == "F", "completed")
        .when(state == "O", "pending")
        .otherwise("cancelled")
    )
    amount = (
        F.when(discount == 0.1, None)
        .when((qty == 50) & (discount == 0), 0.0)
        .otherwise(F.col("l_extendedprice"))
    )
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
        F.when(~no_id, F.concat(F.lit("O"), "l_orderkey", F.lit("-"), "l_linenumber")).alias(
            "order_id"
        ),
        customer.alias("customer_id"),
        product.alias("product_id"),
        qty.cast("int").alias("quantity"),
        F.when(qty == 37, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(day.cast("string"))
        .alias("order_date"),
        status.alias("status"),
        amount.alias("amount"),
    )


def spoilt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders with text in some numbers: a letter for a digit, a word for an amount."""
    orders = raw_orders(spark, sf_dir)
    quantity = F.when((F.col("quantity") == 20) & (F.col("status") == "pending"), "2O").otherwise(_text("quantity"))
    amount = F.when((F.col("quantity") == 31) & F.col("product_id").isNotNull(), "n/a").otherwise(_text("amount"))
    return orders.withColumns({"quantity": quantity, "amount": amount})


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _table(spark, sf_dir, "customer")
    nations = _table(spark, sf_dir, "nation")
    balance = F.col("c_acctbal")
    return people.join(nations, people.c_nationkey == nations.n_nationkey).select(
        _text("c_custkey").alias("customer_id"),
        F.concat(
            F.lit("  "),
            F.lower("c_mktsegment"),
            F.lit("  "),
            F.upper(F.replace("c_name", F.lit("#"), F.lit(" "))),
            F.lit(" "),
        ).alias("customer_name"),
        F.when(balance >= -900, F.concat("c_name", F.lit("@Example.COM"))).alias("email"),
        F.when(balance >= 5000, F.lower("n_name"))
        .when(balance >= -950, F.upper("n_name"))
        .alias("city"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, edge spaces kept (Spark's writer trims them by default)."""
    with shuffles_removed(df.sparkSession):
        df.write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    return path


@cache
def _landing(spark: SparkSession, application: str, sf_dir: str) -> Landing:
    base = scratch_path(spark, "landing")
    return Landing(
        orders=write_csv(raw_orders(spark, sf_dir), f"{base}/orders"),
        customers=write_csv(raw_customers(spark, sf_dir), f"{base}/customers"),
        products=write_csv(raw_products(spark, sf_dir), f"{base}/products"),
        label_files=True,
    )


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    """The three extracts as CSV files; written once per application and scale."""
    return _landing(spark, spark.sparkContext.applicationId, sf_dir)


def arrivals(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[str]:
    """All raw orders in two arrivals, by day; the second brings orders of three pieces again."""
    orders = raw_orders(spark, sf_dir)
    early = F.col("order_date") < "1998"
    yield write_csv(orders.where(early), f"{folder}/first")
    yield write_csv(orders.where(~early | (F.col("quantity") == 3)), f"{folder}/second")
