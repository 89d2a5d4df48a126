"""Silver: one trusted row per order, typed, filled and flagged; tidy dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions import as_type, audit_time, parse_day, proper_case
from tierstone.operators import dedupe_by_key, fill_defaults, flag_quality, require_not_null
from tierstone.plans.fixed_values import (
    CRITICAL,
    MISSING_AMOUNT,
    MISSING_STATUS,
    NO_AMOUNT,
    ORDER_KEY,
    UNKNOWN_STATUS,
)


def order_issues(mode: str = "post_fill") -> dict[str, Column]:
    """Quality rules by flag name.

    ``post_fill`` judges by value after defaults are filled in, so a genuine zero amount or
    a literal ``unknown`` is flagged too. ``pre_fill`` judges what was null on arrival.
    """
    if mode == "post_fill":
        no_amount = F.col("amount") == NO_AMOUNT
        no_status = F.col("status") == UNKNOWN_STATUS
    elif mode == "pre_fill":
        no_amount = F.col("amount").isNull() | F.isnan("amount")
        no_status = F.col("status").isNull()
    else:
        raise ValueError(f"mode must be 'post_fill' or 'pre_fill', not {mode!r}")
    return {MISSING_AMOUNT: no_amount, MISSING_STATUS: no_status}


def typed_orders(df: DataFrame, strict: bool = False) -> DataFrame:
    """Order day as a date, quantity as int, amount as double."""
    return df.withColumns(
        {
            "order_date": parse_day(F.col("order_date"), strict=strict),
            "quantity": as_type(F.col("quantity"), "int", strict),
            "amount": as_type(F.col("amount"), "double", strict),
        }
    )


def silver_orders(
    bronze_orders: DataFrame,
    *,
    prefer: Sequence[Column] = (),
    **options,
) -> DataFrame:
    """Dedupe, reject, fill, type and flag, in that order: it decides which rows survive.

    Duplicates go first, so an order whose surviving copy lacks a customer or product is
    rejected. One shuffle (by order id); everything after it runs in the same stage.
    ``options`` are those of :func:`trusted_orders`.
    """
    return trusted_orders(dedupe_by_key(bronze_orders, ORDER_KEY, prefer=prefer), **options)


def trusted_orders(
    orders: DataFrame,
    *,
    flag_mode: str = "post_fill",
    normalise_status: bool = False,
    strict: bool = False,
    updated_at: datetime | None = None,
) -> DataFrame:
    """Orders without repeats: reject, fill, type and flag. No shuffle."""
    orders = require_not_null(orders, CRITICAL)
    if normalise_status:
        orders = orders.withColumn("status", F.lower(F.trim("status")))
    defaults = {"status": UNKNOWN_STATUS, "amount": NO_AMOUNT}
    issues = order_issues(flag_mode)
    if flag_mode == "pre_fill":
        # Judge the values as they arrived, then fill them.
        orders = typed_orders(fill_defaults(flag_quality(orders, issues), defaults), strict)
    else:
        orders = flag_quality(typed_orders(fill_defaults(orders, defaults), strict), issues)
    return orders.withColumn("updated_timestamp", audit_time(updated_at))


def normalised_customers(df: DataFrame) -> DataFrame:
    """Names trimmed and capitalised, emails lower-cased, cities capitalised."""
    return df.withColumns(
        {
            "customer_name": proper_case(F.col("customer_name")),
            "email": F.lower("email"),
            "city": F.initcap("city"),
        }
    )


def silver_customers(
    bronze_customers: DataFrame, *, updated_at: datetime | None = None
) -> DataFrame:
    return normalised_customers(bronze_customers).withColumn(
        "updated_timestamp", audit_time(updated_at)
    )


def silver_products(
    bronze_products: DataFrame, *, updated_at: datetime | None = None
) -> DataFrame:
    """Products arrive clean and pass through."""
    return bronze_products.withColumn("updated_timestamp", audit_time(updated_at))
