import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tierstone.operators import dedupe_by_key, fill_defaults, require_not_null
from tierstone.plans import silver_orders
from tierstone.plans.fixed_values import ORDERS


def order(spark, *lines):
    return spark.createDataFrame(lines, ORDERS)


def flags(df):
    return {r["order_id"]: r["data_quality_flag"] for r in df.collect()}


def test_null_key_keeps_one_row(spark):
    df = order(
        spark,
        (None, "c", "p", 2, "2024-01-01", "completed", 1.0),
        (None, "c", "p", 1, "2024-01-01", "completed", 1.0),
    )
    assert [r["quantity"] for r in dedupe_by_key(df, ["order_id"]).collect()] == [1]


def test_complete_copy_wins_and_dedupe_comes_before_rejection(spark):
    df = order(
        spark,
        ("7", None, "p", 1, "2024-01-01", "completed", 1.0),
        ("7", "c", "p", 1, "2024-01-01", "completed", 2.0),
        # The surviving copy (lowest customer) has no product, so the order is lost.
        ("8", "a", None, 1, "2024-01-01", "completed", 1.0),
        ("8", "b", "p", 1, "2024-01-01", "completed", 1.0),
    )
    assert [(r["order_id"], r["amount"]) for r in silver_orders(df).collect()] == [("7", 2.0)]
    complete_first = [F.col("product_id").isNull().asc()]
    kept = silver_orders(df, prefer=complete_first).orderBy("order_id").collect()
    assert [(r["order_id"], r["customer_id"]) for r in kept] == [("7", "c"), ("8", "b")]


def test_equal_copies_from_two_files_keep_the_first_file(spark):
    df = order(spark, ("k", "c", "p", 1, None, "s", 1.0))
    files = [df.withColumn("source_file", F.lit(f"{n}.csv")) for n in "cab"]
    copies = files[0].unionByName(files[1]).unionByName(files[2])
    assert dedupe_by_key(copies, ["order_id"]).first()["source_file"] == "a.csv"


def test_survivor_ignores_audit_times_and_input_order(spark):
    lines = [("k", f"c{i % 5}", f"p{i % 7}", i % 3, None, "s", float(i)) for i in range(40)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(lines)
        df = order(spark, *lines).repartition(3 + seed).withColumn("updated_timestamp", F.rand())
        got = rows(dedupe_by_key(df, ["order_id"]).drop("updated_timestamp"))
        assert got == (want or got) and len(got) == 1
        want = got


def test_one_hot_key_sends_one_row_per_map_task(spark):
    df = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    kept = dedupe_by_key(df, ["k"])
    shown = plan(kept)
    assert shown.index("WindowGroupLimit") < shown.index("Exchange")
    assert shown.count("Partial") == 1 and shown.count("Final") >= 1
    assert kept.count() == df.select("k").distinct().count()
    assert kept.filter("k = 'hot'").first()["v"] == 0


def test_fully_equal_copies_and_key_only_tables(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(dedupe_by_key(df, ["k"])) == [("a",), ("b",)]


def test_require_not_null_equals_dropna(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), (None, 1.0, 2), ("b", None, 3), ("c", float("nan"), 4), (None, None, 5)],
        "s string, d double, i int",
    )
    for columns in (["s"], ["d"], ["s", "d"]):
        # As text, because NaN does not equal itself.
        assert repr(rows(require_not_null(df, columns))) == repr(rows(df.dropna(subset=columns)))


def test_required_columns_are_pushed_to_the_scan(spark, tmp_path):
    order(spark, ("1", "c", "p", 1, "d", "s", 1.0)).write.parquet(str(tmp_path / "t"))
    shown = plan(
        require_not_null(spark.read.parquet(str(tmp_path / "t")), ["customer_id", "product_id"])
    )
    assert "PushedFilters: [IsNotNull(customer_id), IsNotNull(product_id)]" in shown


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, None, None), ("x", float("nan"), 3)], "s string, d double, i int")
    filled = fill_defaults(df, {"s": "unknown", "d": 0.0, "i": 7})
    assert rows(filled) == [("unknown", 0.0, 7), ("x", 0.0, 3)]


@pytest.mark.parametrize("column, value", [("i", "x"), ("s", 1), ("i", 0.5), ("d", True)])
def test_fill_defaults_rejects_values_spark_would_skip(spark, column, value):
    df = spark.createDataFrame([(1, "a", 1.0)], "i int, s string, d double")
    with pytest.raises(TypeError):
        fill_defaults(df, {column: value})


def test_fill_defaults_rejects_unknown_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        fill_defaults(spark.range(1), {"nope": 1})


def test_flags_by_value_or_by_arrival(spark):
    df = order(
        spark,
        ("both", "c", "p", 1, "2024-01-01", None, None),
        ("amount", "c", "p", 1, "2024-01-01", "completed", None),
        ("nan", "c", "p", 1, "2024-01-01", "completed", float("nan")),
        ("status", "c", "p", 1, "2024-01-01", None, 5.0),
        ("zero", "c", "p", 1, "2024-01-01", "completed", 0.0),
        ("word", "c", "p", 1, "2024-01-01", "unknown", 5.0),
        ("clean", "c", "p", 1, "2024-01-01", "completed", 5.0),
    )
    by_value = {
        "both": "missing_amount&missing_status",
        "amount": "missing_amount",
        "nan": "missing_amount",
        "status": "missing_status",
        "zero": "missing_amount",
        "word": "missing_status",
        "clean": "clean",
    }
    assert flags(silver_orders(df)) == by_value
    assert flags(silver_orders(df, flag_mode="pre_fill")) == by_value | {
        "zero": "clean",
        "word": "clean",
    }
    assert silver_orders(df).schema == silver_orders(df, flag_mode="pre_fill").schema
    with pytest.raises(ValueError):
        silver_orders(df, flag_mode="other")


def test_status_spelling_is_kept_unless_asked(spark):
    df = order(
        spark,
        ("1", "c", "p", 1, "2024-01-01", "Completed", 1.0),
        ("2", "c", "p", 1, "2024-01-01", "completed ", 1.0),
        ("3", "c", "p", 1, "2024-01-01", "completed", 1.0),
    )
    assert silver_orders(df).filter("status = 'completed'").count() == 1
    assert silver_orders(df, normalise_status=True).filter("status = 'completed'").count() == 3


def test_cleaning_orders_shuffles_once(spark):
    df = order(spark, ("1", "c", "p", 1, "2024-01-01", "completed", 1.0)).repartition(4)
    text = io_tree(plan(silver_orders(df)))
    assert text.count("Exchange") == 2  # our repartition above, then the dedupe


def io_tree(shown):
    """The operator tree at the top of a formatted plan."""
    return shown.split("\n\n\n")[0]
