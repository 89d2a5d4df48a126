"""Gold: completed orders with their customer and product, and the customer ranking.

Sales reports are :func:`tierstone.operators.sales_by` over the enriched orders.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.functions import audit_time
from tierstone.functions.fixed_values import COMPLETED
from tierstone.operators import (
    completed_only,
    customer_spend,
    dense_rank_global,
    fits_broadcast,
    hot_key_rows,
    lookup_join,
    top_ranked,
)
from tierstone.operators.lookup import HOT_KEY_ROWS
from tierstone.plans.fixed_values import ENRICHED
from tierstone.sources import stage


def enrich_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    customer_bytes: int | None = None,
    product_bytes: int | None = None,
    updated_at: datetime | None = None,
    **lookup_options,
) -> DataFrame:
    """Completed orders with customer and product details; orders without a match are kept.

    Orders are filtered in the scan and pruned to the columns used. While both dimensions
    are within the broadcast bound this is map-only. ``customer_bytes`` and
    ``product_bytes`` are known size bounds, measured when absent; ``lookup_options`` are
    those of :func:`tierstone.operators.lookup_join`.
    """
    details = ("customer_name", "city", "product_name", "category")
    facts = completed_only(orders, COMPLETED).select([c for c in ENRICHED if c not in details])
    dims = {
        "customer_id": (customers, ["customer_name", "city"], customer_bytes),
        "product_id": (products, ["product_name", "category"], product_bytes),
    }
    small = {
        key: fits_broadcast(dim.select(key, *columns), size, **lookup_options)
        for key, (dim, columns, size) in dims.items()
    }
    large = [key for key, fits in small.items() if not fits]
    # all keys are counted in one pass over the facts, never over the first join
    min_rows = lookup_options.get("min_hot_rows", HOT_KEY_ROWS)
    hot = hot_key_rows(facts, large, min_rows) if large else {}
    full = facts
    for key, (dim, columns, _) in dims.items():
        options = lookup_options | {"broadcast": "measured" if small[key] else "never"}
        full = lookup_join(full, dim, key, columns, hot=hot.get(key), **options)
    return full.select(ENRICHED).withColumn("updated_timestamp", audit_time(updated_at))


def top_customers(
    enriched: DataFrame, k: int | None = None, *, ordered: bool = True, **rank_options
) -> DataFrame:
    """Customers ranked by total spend, ties sharing a rank without gaps.

    All customers by default, or those of the first ``k`` ranks. The spend per customer is
    written once and then ranked: ranking reads it several times, and sums of doubles may
    differ in the last digit when computed again. ``rank_options`` are those of
    :func:`tierstone.operators.dense_rank_global`.
    """
    spend = stage(customer_spend(enriched), "customer-spend")
    if k is None:
        ranked = dense_rank_global(spend, "total_spent", **rank_options)
    else:
        ranked = top_ranked(spend, "total_spent", k)
    return ranked.orderBy("rank") if ordered else ranked
