"""Arrivals: new files only, merged orders and partial sums against the full build."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tierstone import plans
from tierstone.operators import dedupe_by_key, sales_by
from tierstone.plans.fixed_values import ORDER_KEY, ORDERS
from tierstone.sources import FileChanged, all_commits, file_ledger, read_commits, write_snapshot

HEADER = "order_id,customer_id,product_id,quantity,order_date,status,amount\n"


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{x}\n" for x in lines))


def orders(spark, *lines):
    return spark.createDataFrame([tuple(x) for x in lines], ORDERS)


def bronze(spark, table):
    return read_commits(spark, all_commits(spark, table))


def test_only_new_files_are_read(spark, tmp_path):
    landing, table = tmp_path / "in", str(tmp_path / "bronze")
    land(landing, "day [1].csv", "a,c,p,1,2024-01-01,completed,5")
    first = plans.ingest_new(spark, str(landing), table, ORDERS)
    assert plans.ingest_new(spark, str(landing), table, ORDERS) is None
    land(landing, "day2.csv", "b,c,p,1,2024-01-02,completed,6", "c,c,p,x,2024-01-02,completed,7")
    second = plans.ingest_new(spark, str(landing), table, ORDERS)
    assert (first.version, first.num_rows, second.version, second.num_rows) == (0, 1, 1, 2)
    assert {os.path.basename(f) for f in read_commits(spark, [second]).select("source_file").first()} == {"day2.csv"}
    full = plans.bronze_rows(spark, str(landing), ORDERS)
    times = ("ingestion_timestamp",)
    assert rows(bronze(spark, table).drop(*times)) == rows(full.drop(*times))
    assert second.rejected_rows == 1
    noted = {os.path.basename(r["file"]).replace("%20", " "): r["version"] for r in file_ledger(spark, table).collect()}
    assert noted == {"day [1].csv": 0, "day2.csv": 1}


def test_changed_files_raise(spark, tmp_path):
    landing, table = tmp_path / "in", str(tmp_path / "bronze")
    land(landing, "day1.csv", "a,c,p,1,2024-01-01,completed,5")
    plans.ingest_new(spark, str(landing), table, ORDERS)
    time.sleep(0.01)
    land(landing, "day1.csv", "a,c,p,1,2024-01-01,completed,5", "b,c,p,1,2024-01-01,completed,5")
    with pytest.raises(FileChanged, match="day1.csv"):
        plans.ingest_new(spark, str(landing), table, ORDERS)
    assert plans.ingest_new(spark, str(landing), table, ORDERS, reread_changed=True).num_rows == 2


def test_a_failed_attempt_leaves_files_new(spark, tmp_path, monkeypatch):
    landing, table = tmp_path / "in", str(tmp_path / "bronze")
    land(landing, "day1.csv", "a,c,p,1,2024-01-01,completed,5")

    def fail(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr("tierstone.sources.snapshots._append_history", fail)
        with pytest.raises(RuntimeError):
            plans.ingest_new(spark, str(landing), table, ORDERS)
    assert plans.ingest_new(spark, str(landing), table, ORDERS).num_rows == 1
    assert rows(bronze(spark, table).select("order_id")) == [("a",)]


DAYS = [
    [("a", "c2", "p", 1, "2024-01-01", "completed", 1.0), ("b", "c1", "p", 1, "2024-01-01", "completed", 0.1),
     (None, "c1", "p", 1, "2024-01-01", "completed", 9.0), ("n", None, "p", 1, "2024-01-01", "completed", 2.0)],
    # a smaller copy of a, a repeat of b, another order without an id, a copy of n that has a customer
    [("a", "c1", "p", 1, "2024-01-01", "completed", 4.0), ("b", "c1", "p", 1, "2024-01-01", "completed", 0.1),
     (None, "c0", "p", 1, "2024-01-02", "completed", 8.0), ("n", "c1", "p", 1, "2024-01-01", "completed", 2.0)],
    [("d", "c2", "q", 1, "2024-01-03", "pending", 3.0), ("e", "c1", "q", 1, "2024-01-03", "completed", None)],
]


def test_merged_tables_equal_the_full_build(spark, tmp_path):
    table, sums = str(tmp_path / "orders"), str(tmp_path / "sales")
    for upto, day in enumerate(DAYS, 1):
        plans.merge_orders(spark, orders(spark, *day), table, buckets=4)
        everything = orders(spark, *[x for d in DAYS[:upto] for x in d])
        assert rows(plans.merged_orders(spark, table)) == rows(dedupe_by_key(everything, ORDER_KEY))
        assert len(plans.merge_sales(spark, table, sums, "customer_id")) == 1
        trusted = plans.silver_orders(everything).where("status = 'completed'")
        assert rows(plans.merged_sales(spark, sums, "customer_id")) == rows(sales_by(trusted, "customer_id"))
    assert plans.merge_sales(spark, table, sums, "customer_id") == []
    assert plans.merge_orders(spark, orders(spark), table) is None


def test_late_sums_catch_up(spark, tmp_path):
    table, sums = str(tmp_path / "orders"), str(tmp_path / "sales")
    for day in DAYS:
        plans.merge_orders(spark, orders(spark, *day), table, buckets=4)
    assert len(plans.merge_sales(spark, table, sums, "product_id")) == 3
    lookup = spark.createDataFrame([("p", "one"), ("q", "one")], "product_id string, category string")
    trusted = plans.silver_orders(orders(spark, *[x for d in DAYS for x in d])).where("status = 'completed'")
    full = sales_by(trusted.join(lookup, "product_id", "left"), "category")
    assert rows(plans.merged_sales(spark, sums, "product_id", "category", lookup)) == rows(full)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = str(tmp_path / "orders")
    many = spark.range(4000).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.lit("c").alias("customer_id"), F.lit("p").alias("product_id"),
        F.lit(1).alias("quantity"), F.lit("2024-01-01").alias("order_date"), F.lit("completed").alias("status"),
        F.lit(1.0).alias("amount"),
    )
    plans.merge_orders(spark, many, table, buckets=32)
    again = many.where("order_id in ('o7', 'o8')").withColumn("amount", F.lit(0.5))
    change = plans.merge_orders(spark, again, table)
    assert change.num_rows < 400
    merged = plans.merged_orders(spark, table)
    assert merged.count() == 4000
    assert rows(merged.where("amount < 1").select("order_id")) == [("o7",), ("o8",)]
    first, second = all_commits(spark, f"{table}/changes")
    files = [f for f in merged.inputFiles() if second.folder in f]
    assert 0 < len({os.path.dirname(f) for f in files}) <= 2
    assert "Exchange" not in plan(merged)


def test_an_arrival_is_merged_once(spark, tmp_path):
    table = str(tmp_path / "orders")
    commit = write_snapshot(orders(spark, *DAYS[0]), str(tmp_path / "bronze"))
    assert plans.merge_orders(spark, read_commits(spark, [commit]), table, buckets=4, upstream=commit)
    assert plans.merge_orders(spark, read_commits(spark, [commit]), table, upstream=commit) is None


def test_infinite_amounts_are_summed_as_doubles(spark, tmp_path):
    table, sums = str(tmp_path / "orders"), str(tmp_path / "sales")
    day = [("a", "c", "p", 1, "2024-01-01", "completed", float("inf")), ("b", "c", "p", 1, "2024-01-01", "completed", 1.0)]
    plans.merge_orders(spark, orders(spark, *day), table, buckets=4)
    plans.merge_sales(spark, table, sums, "customer_id")
    assert rows(plans.merged_sales(spark, sums, "customer_id").select("total_revenue")) == [(float("inf"),)]
