from tierstone.plans.arrivals import ingest_new, merge_orders, merged_orders, merged_sales, merge_sales
from tierstone.plans.bronze import bronze_rows, ingest, rejected_values
from tierstone.plans.gold import enrich_orders, top_customers
from tierstone.plans.layers import Landing, layer_audit, refresh, table_path
from tierstone.plans.silver import silver_customers, silver_orders, silver_products, trusted_orders

__all__ = [
    "Landing",
    "bronze_rows",
    "enrich_orders",
    "ingest",
    "ingest_new",
    "layer_audit",
    "merge_orders",
    "merge_sales",
    "merged_orders",
    "merged_sales",
    "refresh",
    "rejected_values",
    "silver_customers",
    "silver_orders",
    "silver_products",
    "table_path",
    "top_customers",
    "trusted_orders",
]
