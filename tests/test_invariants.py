"""Relations that hold between the stored layers, checked on whole tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import plan
from tierstone.operators import sales_by
from tierstone.plans import enrich_orders
from verification.layers import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return lambda name: stored(spark, SF_DIR, name)


def test_one_row_per_order(table):
    silver, bronze = table("silver_orders"), table("bronze_orders")
    assert silver.count() == silver.select("order_id").distinct().count()
    assert silver.join(bronze, "order_id", "left_anti").filter("order_id is not null").count() == 0
    assert silver.filter("customer_id is null or product_id is null").count() == 0


def test_nothing_lost_in_enrichment(table):
    completed = table("silver_orders").filter("status = 'completed'")
    enriched = table("gold_enriched_orders")
    assert enriched.count() == completed.count()
    assert enriched.filter("city is null").count() > 0  # unmatched customers are kept
    assert enriched.filter("category is null").count() > 0


def test_reports_agree(table):
    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    enriched = table("gold_enriched_orders")
    revenue = total(enriched, "amount")
    assert total(table("gold_sales_by_city"), "total_revenue") == pytest.approx(revenue)
    assert total(table("gold_sales_by_category"), "total_revenue") == pytest.approx(revenue)
    assert total(table("gold_top_customers"), "total_spent") == pytest.approx(revenue)
    for name in ("gold_sales_by_city", "gold_sales_by_category", "gold_top_customers"):
        assert total(table(name), "total_orders") == enriched.count()


def test_ranks_have_no_gaps_and_follow_spend(table):
    top = table("gold_top_customers")
    ranks = [r[0] for r in top.select("rank").distinct().orderBy("rank").collect()]
    assert ranks == list(range(1, len(ranks) + 1))
    again = top.withColumn(
        "again", F.dense_rank().over(Window.orderBy(F.desc("total_spent")))
    )
    assert again.filter("again <> rank").count() == 0


def test_enrichment_plan(spark):
    """Filtered and pruned in the scan, no shuffle of the orders."""
    tables = [stored(spark, SF_DIR, f"silver_{t}") for t in ("orders", "customers", "products")]
    shown = plan(enrich_orders(*tables))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,completed)]" in shown
    assert shown.count("BroadcastHashJoin LeftOuter BuildRight") == 2
    assert "hashpartitioning" not in shown and "SortMergeJoin" not in shown
    for unused in ("source_file", "ingestion_timestamp", "email"):
        assert unused not in shown


def test_report_reads_three_columns(spark):
    shown = plan(sales_by(stored(spark, SF_DIR, "gold_enriched_orders"), "city"))
    assert "ReadSchema: struct<order_id:string,city:string,amount:double>" in shown
