"""Order counts and revenue by any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions import money


# Digits behind the point that exact totals keep, of the 38 that Spark's decimals have.
EXACT_DIGITS = 12


def exact_sum(amount: str) -> Column:
    """The sum of a column of doubles, the same bit for bit in whatever order rows are added.

    Values are added as decimals, by their shortest spelling with up to ``EXACT_DIGITS`` digits
    behind the point. A group with a value or a total that does not fit (infinite, not a number,
    26 digits before the point) is summed as doubles, where the last digit may depend on order.
    """
    return F.coalesce(F.when(_exact(amount), _decimals(amount)), F.sum(amount).cast("double"))


def exact_avg(amount: str) -> Column:
    """The average of a column of doubles, from its exact sum."""
    return F.coalesce(F.when(_exact(amount), _decimals(amount) / F.count(amount)), F.avg(amount).cast("double"))


def _decimal(amount: str) -> Column:
    return F.col(amount).try_cast(f"decimal(38, {EXACT_DIGITS})")


def _decimals(amount: str) -> Column:
    return F.try_sum(_decimal(amount)).cast("double")


def _exact(amount: str) -> Column:
    return F.count(_decimal(amount)) == F.count(amount)


def _orders(column: str = "order_id") -> Column:
    return F.count(column).alias("total_orders")


def sales_by(
    df: DataFrame, keys: str | Sequence[str], amount: str = "amount", ordered: bool = True
) -> DataFrame:
    """Orders, revenue and average order value per key; null is a group of its own.

    Sums are exact, so a report does not depend on how its rows were dealt to tasks.

    Partial aggregation in every map task leaves one row per key and task to shuffle, so
    a key with a third of the orders is no heavier than any other. ``ordered`` sorts the
    report by revenue; a table written from it needs no order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    report = df.groupBy(*keys).agg(
        _orders(),
        money(exact_sum(amount)).alias("total_revenue"),
        money(exact_avg(amount)).alias("avg_order_value"),
    )
    return report.orderBy(F.desc_nulls_last("total_revenue")) if ordered else report


def customer_spend(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Orders and total spend per customer."""
    return df.groupBy("customer_id", "customer_name").agg(
        _orders(), money(exact_sum(amount)).alias("total_spent")
    )
