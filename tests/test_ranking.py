import math
import random
from datetime import date, datetime, timedelta
from decimal import Decimal
from unittest import mock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tierstone.operators import ranking
from tierstone.operators import customer_spend, dense_rank_global, exact_avg, exact_sum, sales_by, top_ranked
from tierstone.plans import top_customers


def brute_force(values):
    """Dense ranks, highest first; NaN above all numbers, null below."""

    def order(v):
        if v is None:
            return (2, 0)
        return (0, 0) if isinstance(v, float) and math.isnan(v) else (1, -v)

    places = {k: i + 1 for i, k in enumerate(sorted({order(v) for v in values}))}
    return [places[order(v)] for v in values]


def ranked(spark, values, spark_type="double", **options):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {spark_type}").repartition(5)
    out = dense_rank_global(df, "v", **options)
    assert out.columns == ["i", "v", "rank"]
    assert out.schema["rank"].dataType.simpleString() == "int"
    found = {r["i"]: r["rank"] for r in out.collect()}
    assert len(found) == len(values)
    return [found[i] for i in range(len(values))]


@pytest.mark.parametrize("options", [{}, {"buckets": 1}, {"buckets": 2}, {"buckets": 7}])
def test_ties_and_nulls(spark, options):
    assert ranked(spark, [10.0, 10.0, 5.0, None], **options) == [1, 1, 2, 3]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("buckets", [3, 16])
def test_random_values_with_hot_ones(spark, seed, buckets):
    dice = random.Random(seed)
    pool = [dice.uniform(-50, 50) for _ in range(60)]
    values = [dice.choice(pool) for _ in range(400)]
    values += [0.0] * 250 + [max(pool)] * 60 + [min(pool)] * 60  # a third on one value
    values += [None] * 30 + [float("nan")] * 5 + [float("inf")] * 3 + [float("-inf")] * 2
    dice.shuffle(values)
    assert ranked(spark, values, buckets=buckets) == brute_force(values)


@pytest.mark.parametrize("values", [[1.0] * 50, [None] * 20, [float("nan")] * 20 + [1.0]])
def test_single_valued_tables(spark, values):
    assert ranked(spark, values, buckets=4) == brute_force(values)


def test_negative_zero_is_zero(spark):
    values = [0.0, -0.0] * 40 + [1.0, -1.0] * 10
    assert ranked(spark, values, buckets=6) == brute_force(values)


def test_empty_table(spark):
    assert ranked(spark, [], buckets=4) == ranked(spark, []) == []


@pytest.mark.parametrize("spark_type", ["int", "bigint", "decimal(12,2)", "decimal(38,10)"])
def test_exact_types(spark, spark_type):
    from decimal import Decimal

    numbers = [i % 13 for i in range(200)] + [5] * 100
    values = [Decimal(n) if "decimal" in spark_type else n for n in numbers]
    assert ranked(spark, values, spark_type, buckets=5) == brute_force(numbers)


def test_wide_integers_that_share_a_double(spark):
    base = 2**60
    values = [base + (i % 3) for i in range(300)] + [7] * 100
    assert ranked(spark, values, "bigint", buckets=6) == brute_force(values)


TYPED = {
    "string": ["Customer#" + str(i % 40) for i in range(120)] + ["Customer#7"] * 60 + ["", "é", None],
    "date": [date(2024, 1, 1) + timedelta(i % 50) for i in range(150)] + [None],
    "timestamp": [datetime(2024, 1, 1) + timedelta(microseconds=i % 70) for i in range(150)] + [None],
    "boolean": [True, False, None, True],
    "double": [float("nan"), float("inf"), -0.0, 0.0, 1.5, None] * 9 + [3.0] * 40,
    "binary": [bytes([i % 9]) for i in range(60)] + [None],
    "struct<a:int,b:string>": [(i % 4, str(i % 3)) for i in range(60)] + [None],
}


@pytest.mark.parametrize("spark_type", TYPED)
def test_every_type_ranks_alike_at_any_size(spark, spark_type):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(TYPED[spark_type])], f"i int, v {spark_type}")
    small = rows(dense_rank_global(df, "v").select("i", "rank"))
    assert rows(dense_rank_global(df, "v", single_task_rows=1).select("i", "rank")) == small
    assert rows(dense_rank_global(df, "v", buckets=4).select("i", "rank")) == small
    kept = [r for r in small if r[1] <= 3]
    for limit in (ranking.MAX_BROADCAST_K, 2):
        with mock.patch.object(ranking, "MAX_BROADCAST_K", limit):
            assert rows(top_ranked(df, "v", 3).select("i", "rank")) == kept


@pytest.mark.parametrize("buckets", [None, 3])
def test_a_column_named_like_the_rank_is_replaced(spark, buckets):
    df = spark.createDataFrame([(1.0, "x", 9), (2.0, "y", 9)], "v double, t string, rank int")
    found = dense_rank_global(df, "v", buckets=buckets)
    assert found.columns == ["v", "t", "rank"] and rows(found) == [(1.0, "x", 2), (2.0, "y", 1)]
    assert rows(top_ranked(df, "v", 1)) == [(2.0, "y", 1)]


def test_values_that_cannot_be_sorted_fail_at_any_size(spark):
    df = spark.range(3).select(F.create_map(F.lit(1), "id").alias("v"))
    for buckets in (None, 2):
        with pytest.raises(AnalysisException):
            dense_rank_global(df, "v", buckets=buckets).collect()
    with pytest.raises(ValueError, match="buckets"):
        dense_rank_global(spark.range(3), "id", buckets=0)


def test_a_million_ranges_are_planned(spark):
    """Ranks come from a table of offsets: no literal, and no number of ranges, is too large."""
    df = spark.range(3_000).select((F.col("id") * 7 % 1013).cast("double").alias("v"))
    found = dense_rank_global(df, "v", buckets=10**6, rank_type="bigint")
    assert found.schema["rank"].dataType.simpleString() == "bigint" and len(plan(found)) < 100_000
    assert rows(found) == rows(dense_rank_global(df, "v", rank_type="bigint"))


@pytest.mark.parametrize("buckets", [64, 512])
def test_no_task_holds_two_ranges(spark, buckets):
    values = spark.range(5_000).select((F.col("id") % 700).alias("v")).distinct()
    dealt = values.repartitionByRange(buckets, F.desc("v")).groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("v").alias("a"), F.max("v").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(dealt, dealt[1:])) and len(dealt) > buckets / 2


def test_no_task_sees_the_whole_table(spark):
    df = spark.range(5_000).select((F.col("id") % 700).cast("double").alias("v"))
    small, large = dense_rank_global(df, "v"), dense_rank_global(df, "v", buckets=8)
    assert "SinglePartition" in plan(small)
    assert "SinglePartition" not in plan(large)
    assert "SinglePartition" in plan(dense_rank_global(df, "v", single_task_rows=5_000))
    assert "SinglePartition" not in plan(dense_rank_global(df, "v", single_task_rows=4_999))


@pytest.mark.parametrize("k", [1, 3, 100])
def test_top_ranked_keeps_ties(spark, k):
    values = [10.0] * 5 + [9.0, 8.0, 8.0, 7.0] + [None] * 2
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = [(v, r) for v, r in zip(values, brute_force(values)) if r <= k]
    assert rows(top_ranked(df, "v", k)) == sorted(want, key=repr)


def test_top_ranked_moves_no_rows_of_the_table(spark, tmp_path):
    spark.range(1_000).select((F.col("id") % 50).cast("double").alias("v"), "id").write.parquet(
        str(tmp_path / "t")
    )
    shown = plan(top_ranked(spark.read.parquet(str(tmp_path / "t")), "v", 3))
    assert "TakeOrderedAndProject" in shown and "BroadcastHashJoin Inner" in shown
    assert "ReadSchema: struct<v:double>" in shown  # the side that is distributed by value


def test_top_customers(spark):
    orders = [("a", "Ann", "o1", 5.0), ("a", "Ann", "o2", 5.01), ("b", None, "o3", 10.01)]
    orders += [("c", "Cy", "o4", 1.0), ("d", "Di", "o5", 20.0)]
    df = spark.createDataFrame(
        orders, "customer_id string, customer_name string, order_id string, amount double"
    )
    want = [
        ("d", "Di", 1, 20.0, 1),
        ("a", "Ann", 2, 10.01, 2),
        ("b", None, 1, 10.01, 2),
        ("c", "Cy", 1, 1.0, 3),
    ]
    for options in ({}, {"buckets": 2}, {"k": 5}):
        found = top_customers(df, **options)
        assert [r["rank"] for r in found.collect()] == [1, 2, 2, 3]
        assert rows(found) == sorted(want, key=repr)
    assert rows(top_customers(df, k=2)) == sorted(want[:3], key=repr)


def test_sales_by(spark):
    df = spark.createDataFrame(
        [("x", "o1", 1.0), ("x", "o2", 0.0), (None, "o3", 2.0), ("y", None, 5.0)],
        "city string, order_id string, amount double",
    )
    want = [("y", 0, 5.0, 5.0), (None, 1, 2.0, 2.0), ("x", 2, 1.0, 0.5)]
    assert [tuple(r) for r in sales_by(df, "city").collect()] == want
    assert rows(sales_by(df, ["city"], ordered=False)) == sorted(want, key=repr)


def test_totals_do_not_depend_on_the_order_of_rows(spark):
    """Bit for bit, over 50 ways of dealing rows whose double sums differ."""
    values = [0.1, 0.7, 1e15, -1e15, 0.005, 1234567.89, 3.3333333, None] * 40
    df = spark.createDataFrame(
        [(f"o{i}", f"c{i % 3}", "n", f"x{i % 2}", v) for i, v in enumerate(values)],
        "order_id string, customer_id string, customer_name string, city string, amount double",
    ).withColumn("other", F.rand(7))
    double, exact, reports = set(), set(), set()
    for i in range(50):
        dealt = df.repartition(1 + i % 9, F.xxhash64("order_id", F.lit(i))).sortWithinPartitions(F.xxhash64("order_id", F.lit(-i)))
        double.add(dealt.agg(F.sum("amount")).first()[0])
        exact.add(dealt.agg(exact_sum("amount"), exact_avg("amount")).first())
        if i % 10 == 0:
            reports.add((tuple(rows(sales_by(dealt, "city", ordered=False))), tuple(rows(customer_spend(dealt)))))
    assert len(exact) == len(reports) == 1 and len(double) > 1
    total = sum(Decimal(str(v)) for v in values if v is not None)
    assert exact.pop() == (float(total), float(total) / 280)


def test_totals_that_no_decimal_holds(spark):
    df = spark.createDataFrame(
        [("a", 1e300), ("a", 1e300), ("b", float("inf")), ("b", 1.0), ("c", float("nan")), ("d", None), ("e", 9e25), ("e", 9e25)],
        "k string, v double",
    )
    found = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert found["a"] == 2e300 and found["b"] == float("inf") and found["c"] != found["c"]
    assert found["d"] is None and found["e"] == 1.8e26


def test_totals_combine_before_the_shuffle(spark):
    df = spark.range(100, numPartitions=4).selectExpr(
        "'c' as customer_id", "'n' as customer_name", "'x' as city", "id as order_id",
        "cast(id as double) as amount",
    )
    for report in (sales_by(df, "city", ordered=False), customer_spend(df)):
        shown = plan(report)
        assert "partial_sum" in shown and shown.count("Exchange (") <= 2
