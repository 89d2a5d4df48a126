"""The same results in plain SQL (DuckDB dialect) over the same Parquet tables."""

from __future__ import annotations

import re

_ORDER_COLUMNS = "order_id, customer_id, product_id, quantity, order_date, status, amount"


def _proper(text: str) -> str:
    """Capitalise each space-separated word."""
    words = f"string_split(lower({text}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _money(value: str) -> str:
    """Half-up on the printed value, which is how Spark rounds doubles."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 12)), 2) as double)"


_DAY = "cast(try_strptime(order_date, '%Y-%m-%d') as date)"


def _flag(no_amount: str, no_status: str) -> str:
    return f"""case when {no_amount} and {no_status} then 'missing_amount&missing_status'
      when {no_amount} then 'missing_amount'
      when {no_status} then 'missing_status'
      else 'clean' end"""


_POST_FILL = _flag("coalesce(amount, 0.0) = 0.0", "coalesce(status, 'unknown') = 'unknown'")
_PRE_FILL = _flag("amount is null", "status is null")


def _sales(key: str) -> str:
    return f"""select {key}, count(order_id) as total_orders,
      {_money("sum(amount)")} as total_revenue, {_money("avg(amount)")} as avg_order_value
    from enriched group by {key}"""


_EXACT = "cast(sum(cast(cast(amount as varchar) as decimal(38, 12))) as double)"

# Named steps; each may use the ones above it.
_STEPS = {
    "raw_orders": """
    select
      case when l_quantity = 17 and l_tax = 0.08 and l_discount = 0 then null
        else concat('O', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar))
      end as order_id,
      case when l_quantity = 13 then null
        when l_quantity = 7 and l_returnflag = 'R' then concat('X', cast(o_custkey as varchar))
        else cast(o_custkey as varchar) end as customer_id,
      case when l_quantity = 29 then null
        when l_quantity = 11 and l_returnflag = 'A' then concat('X', cast(l_partkey as varchar))
        else cast(l_partkey as varchar) end as product_id,
      cast(l_quantity as integer) as quantity,
      case when l_quantity = 37 then strftime(o_orderdate, '%d/%m/%Y')
        else strftime(o_orderdate, '%Y-%m-%d') end as order_date,
      case when l_tax = 0 then null
        when o_orderstatus = 'F' and l_quantity = 43 then 'Completed'
        when o_orderstatus = 'O' and l_quantity = 49 and l_discount = 0 then 'unknown'
        when o_orderstatus = 'F' then 'completed'
        when o_orderstatus = 'O' then 'pending'
        else 'cancelled' end as status,
      case when l_discount = 0.1 then null
        when l_quantity = 50 and l_discount = 0 then 0.0
        else l_extendedprice end as amount
    from lineitem join orders on l_orderkey = o_orderkey""",
    "raw_customers": """
    select cast(c_custkey as varchar) as customer_id,
      concat('  ', lower(c_mktsegment), '  ', upper(replace(c_name, '#', ' ')), ' ')
        as customer_name,
      case when c_acctbal >= -900 then concat(c_name, '@Example.COM') end as email,
      case when c_acctbal >= 5000 then lower(n_name)
        when c_acctbal >= -950 then upper(n_name) end as city
    from customer join nation on c_nationkey = n_nationkey""",
    "raw_products": """
    select cast(p_partkey as varchar) as product_id, p_name as product_name,
      p_type as category
    from part""",
    "deduped": f"""
    select {_ORDER_COLUMNS} from (
      select *, row_number() over (partition by order_id order by
        customer_id nulls last, product_id nulls last, quantity nulls last,
        order_date nulls last, status nulls last, amount nulls last) as copy_no
      from raw_orders) as numbered
    where copy_no = 1""",
    "silver": f"""
    select order_id, customer_id, product_id, quantity, {_DAY} as order_date,
      coalesce(status, 'unknown') as status, coalesce(amount, 0.0) as amount,
      {_POST_FILL} as data_quality_flag
    from deduped where customer_id is not null and product_id is not null""",
    "silver_people": f"""
    select customer_id, {_proper("trim(customer_name)")} as customer_name,
      lower(email) as email, {_proper("city")} as city
    from raw_customers""",
    "enriched": """
    select s.order_id, s.order_date, s.customer_id, c.customer_name, c.city, s.product_id,
      p.product_name, p.category, s.quantity, s.amount, s.data_quality_flag
    from silver s
      left join silver_people c on s.customer_id = c.customer_id
      left join raw_products p on s.product_id = p.product_id
    where s.status = 'completed'""",
    "by_city": _sales("city"),
    "by_category": _sales("category"),
    # small groups end on half a cent more often, so the totals are exact here as in the library
    "by_customer": f"""select customer_id, count(order_id) as total_orders,
      {_money(_EXACT)} as total_revenue, {_money(f"{_EXACT} / count(amount)")} as avg_order_value
    from enriched group by customer_id""",
    "spend": f"""
    select customer_id, customer_name, count(order_id) as total_orders,
      {_money("sum(amount)")} as total_spent
    from enriched group by customer_id, customer_name""",
    "ranked": """
    select *, cast(dense_rank() over (order by total_spent desc nulls last) as integer) as rank
    from spend""",
}


def _sql(body: str) -> str:
    """``body`` preceded by the named steps it needs."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & (_STEPS.keys() - needed):
            needed.add(name)
            todo.append(_STEPS[name])
    steps = [f"{name} as ({sql})" for name, sql in _STEPS.items() if name in needed]
    return f"with {', '.join(steps)}\n{body}" if steps else body


_AUDIT = "true as has_ingestion_timestamp"
_UPDATED = "true as has_updated_timestamp"
_RAW_ORDERS = f"select {_ORDER_COLUMNS} from raw_orders"
_BRONZE_ORDERS = f"select *, 'orders.csv' as source_file, {_AUDIT} from raw_orders"
_RESTATED = "select *, upper(category) as department from raw_products"

_NULL_KEYS = (
    "select o.order_id, o.customer_id, o.amount, c.customer_name, c.city"
    " from raw_orders o left join silver_people c on o.customer_id = c.customer_id"
)

_EARLY = "order_date < '1998'"
_MONTH = "cast(date_trunc('month', order_date) as date)"

_OTHERS = ("customer_id", "product_id", "quantity", "order_date", "status", "amount")
_COPIES = f"(partition by order_id order by {', '.join(f'{c} nulls last' for c in _OTHERS)})"
_REMOVED = f"""
    select {_ORDER_COLUMNS}, reason, count(*) as copies,
      case when reason = 'duplicate' then first_customer_id is not null and first_product_id is not null end
        as survivor_kept,
      {', '.join(f"case when reason = 'duplicate' then first_{c} end as survivor_{c}" for c in _OTHERS)}
    from (select *, case when copy_no > 1 then 'duplicate'
        when customer_id is null and product_id is null then 'missing_customer_id&missing_product_id'
        when customer_id is null then 'missing_customer_id'
        when product_id is null then 'missing_product_id' end as reason
      from (select *, row_number() over {_COPIES} as copy_no,
          {', '.join(f"first_value({c}) over {_COPIES} as first_{c}" for c in _OTHERS)}
        from raw_orders) as numbered) as judged
    where reason is not null group by all"""

_BODIES = {
    # sources
    "csv_declared_schema": _RAW_ORDERS,
    "csv_inferred_schema": "select * replace (cast(customer_id as integer) as customer_id)"
    " from raw_customers",
    "csv_locked_schema": "select * from raw_customers",
    "landing_inventory": """select *, true as every_file_listed, true as sizes_equal from (
      select 'orders' as "extract", count(*) as rows_read from raw_orders
      union all select 'customers', count(*) from raw_customers
      union all select 'products', count(*) from raw_products) as extracts""",
    "bronze_audit_columns": _BRONZE_ORDERS,
    "bronze_orders": _BRONZE_ORDERS,
    "bronze_customers": f"select *, 'customers.csv' as source_file, {_AUDIT} from raw_customers",
    "bronze_products": f"select *, 'products.csv' as source_file, {_AUDIT} from raw_products",
    # versioned tables
    "snapshot_roundtrip": "select * from silver",
    "snapshot_rerun_idempotent": "select * from silver",
    "snapshot_schema_change": _RESTATED,
    "snapshot_version_as_of": "select * from raw_products",
    "snapshot_timestamp_as_of": "select * from raw_products",
    "snapshot_history": """select cast(version as bigint) as version, 'WRITE' as operation,
      'Overwrite' as mode, schema_changed, num_rows, true as has_timestamp
    from (select 0 as version, 'false' as schema_changed, count(*) as num_rows from raw_products
      union all select 1, 'true', count(*) from raw_products) as commits""",
    "snapshot_expiry": """select cast(version as bigint) as version, operation, num_rows,
      num_rows as rows_kept, num_rows as departments
    from (select 0 as version, 'WRITE' as operation union all select 0, 'EXPIRED' union all select 1, 'WRITE') as log,
      (select count(*) as num_rows from raw_products) as products""",
    "layout_all_orders": f"select *, {_MONTH} as order_month from silver",
    "layout_completed_of_a_month": f"select *, {_MONTH} as order_month from silver"
    f" where status = 'completed' and {_MONTH} = date '1997-03-01'",
    # single steps
    "filter_completed": f"{_RAW_ORDERS} where status = 'completed'",
    "drop_critical_nulls": f"{_RAW_ORDERS} where customer_id is not null"
    " and product_id is not null",
    "fill_defaults": "select * replace (coalesce(status, 'unknown') as status,"
    " coalesce(amount, 0.0) as amount) from raw_orders",
    "dedupe_orders": "select * from deduped",
    "parse_order_date": f"select order_id, order_date as order_date_text, {_DAY} as order_date"
    " from raw_orders",
    "cast_numeric": "select order_id, try_cast(quantity_text as integer) as quantity,"
    " try_cast(amount_text as double) as amount from ("
    " select order_id, case when quantity = 50 then 'fifty' else cast(quantity as varchar) end"
    " as quantity_text, cast(amount as varchar) as amount_text from raw_orders) as texts",
    "quality_flag": f"select order_id, coalesce(amount, 0.0) as amount,"
    f" coalesce(status, 'unknown') as status, {_POST_FILL} as data_quality_flag from raw_orders",
    "quality_flag_prefill": f"select order_id, coalesce(amount, 0.0) as amount,"
    f" coalesce(status, 'unknown') as status, {_PRE_FILL} as data_quality_flag from raw_orders",
    "normalise_customers": "select * from silver_people",
    # silver
    "silver_orders": f"select *, 'orders.csv' as source_file, {_AUDIT}, {_UPDATED} from silver",
    "silver_customers": f"select *, 'customers.csv' as source_file, {_AUDIT}, {_UPDATED}"
    " from silver_people",
    "silver_products": f"select *, 'products.csv' as source_file, {_AUDIT}, {_UPDATED}"
    " from raw_products",
    "removed_orders": _REMOVED,
    "removed_orders_large_lookup": _REMOVED,
    # arrivals
    "arrivals_ledger": f"""select cast(0 as bigint) as version, count(*) as "rows", true as all_noted
      from raw_orders where {_EARLY}
      union all select 1, count(*), true from raw_orders where not {_EARLY} or quantity = 3""",
    "arrivals_bronze_orders": f"""select *, {_AUDIT} from (
      select * from raw_orders where {_EARLY}
      union all select * from raw_orders where not {_EARLY} or quantity = 3) as arrived""",
    "arrivals_dedupe_orders": f"select *, {_AUDIT} from deduped",
    "arrivals_sales_by_city": "select * from by_city",
    "arrivals_sales_by_category": "select * from by_category",
    "arrivals_sales_by_customer": "select * from by_customer",
    # gold
    "join_customers_left": "select s.order_id, s.customer_id, s.amount, c.customer_name, c.city"
    " from silver s left join silver_people c on s.customer_id = c.customer_id",
    "join_products_left": "select s.order_id, s.product_id, s.amount, p.product_name, p.category"
    " from silver s left join raw_products p on s.product_id = p.product_id",
    "join_large_lookup": "select s.order_id, s.customer_id, s.amount, c.customer_name, c.city"
    " from silver s left join silver_people c on s.customer_id = c.customer_id",
    "join_null_keys": _NULL_KEYS,
    "join_null_keys_large_lookup": _NULL_KEYS,
    "gold_enriched_large_lookups": f"select *, {_UPDATED} from enriched",
    "gold_enriched_orders": f"select *, {_UPDATED} from enriched",
    "bronze_rejects": """select order_id, 'orders.csv' as source_file, 'quantity' as "column", '2O' as "value", 'int' as expected
      from raw_orders where quantity = 20 and status = 'pending'
      union all select order_id, 'orders.csv', 'amount', 'n/a', 'double'
      from raw_orders where quantity = 31 and product_id is not null""",
    "sales_by_city": "select * from by_city",
    "sales_by_category": "select * from by_category",
    "customer_spend": "select * from spend",
    "top_customers": "select * from ranked",
    "top_customers_distributed": "select * from ranked",
    "top_customers_k": "select * from ranked where rank <= 10",
    "dense_rank_distributed": "select *, cast(dense_rank() over (order by amount desc nulls last)"
    " as integer) as amount_rank from (select order_id, amount from raw_orders) as amounts",
    "dense_rank_text": "select *, cast(dense_rank() over (order by product_id desc nulls last)"
    " as integer) as product_rank from (select order_id, amount, product_id from raw_orders) as o",
    "dense_rank_date": "select *, cast(dense_rank() over (order by order_date desc nulls last)"
    " as integer) as day_rank from (select order_id, order_date from silver) as o",
    # all layers
    "layer_audit": """select *, rows_in - rows_out as rows_removed, true as follows,
      rows_out as rows_stored from (
      select 'bronze_orders' as "table", 'bronze' as layer, count(*) as rows_in,
        count(*) as rows_out from raw_orders
      union all select 'bronze_customers', 'bronze', count(*), count(*) from raw_customers
      union all select 'bronze_products', 'bronze', count(*), count(*) from raw_products
      union all select 'silver_orders', 'silver', (select count(*) from raw_orders),
        count(*) from silver
      union all select 'silver_customers', 'silver', (select count(*) from raw_customers),
        count(*) from silver_people
      union all select 'silver_products', 'silver', count(*), count(*) from raw_products
      union all select 'gold_enriched_orders', 'gold', (select count(*) from silver),
        count(*) from enriched
      union all select 'gold_sales_by_city', 'gold', (select count(*) from enriched),
        count(*) from by_city
      union all select 'gold_sales_by_category', 'gold', (select count(*) from enriched),
        count(*) from by_category
      union all select 'gold_top_customers', 'gold', (select count(*) from enriched),
        count(*) from ranked) as counts""",
    "end_to_end_sales": """
      select 'city' as report, city as "key", cast(null as integer) as rank, total_orders,
        total_revenue as total, avg_order_value from by_city
      union all select 'category', category, null, total_orders, total_revenue, avg_order_value
        from by_category
      union all select 'customer', customer_id, rank, total_orders, total_spent, null
        from ranked""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(body) for name, body in _BODIES.items()}
