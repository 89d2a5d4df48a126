"""Fixed values of the data contract: they must be exactly these for right results.

Those that column expressions need are in ``tierstone.functions.fixed_values``.
"""

# Raw file columns, in file order. Keys are text; the order day stays text until silver.
ORDERS = (
    "order_id string, customer_id string, product_id string, quantity int,"
    " order_date string, status string, amount double"
)
CUSTOMERS = "customer_id string, customer_name string, email string, city string"
PRODUCTS = "product_id string, product_name string, category string"

# Types forced on top of an inferred schema, so that keys join as text.
CUSTOMER_KEYS = {"customer_id": "string"}
PRODUCT_KEYS = {"product_id": "string"}

# Order cleaning.
ORDER_KEY = ["order_id"]
CRITICAL = ["customer_id", "product_id"]
UNKNOWN_STATUS = "unknown"
NO_AMOUNT = 0.0
MISSING_AMOUNT = "missing_amount"
MISSING_STATUS = "missing_status"

# Columns of the enriched order table, in order.
ENRICHED = [
    "order_id",
    "order_date",
    "customer_id",
    "customer_name",
    "city",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "amount",
    "data_quality_flag",
]
