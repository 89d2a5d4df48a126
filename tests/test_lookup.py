import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tierstone.operators import hot_key_rows, hot_keys, lookup_join
from tierstone.plans import enrich_orders
from tierstone.plans.fixed_values import ENRICHED


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [(1, "c1"), (2, "c2"), (3, "C9"), (4, None), (5, "c1")], "id int, k string"
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("c1", "one", "x"), ("c2", "two", "y"), (None, "null key", "z")],
        "k string, name string, unused string",
    )


WANT = [("C9", 3, None), ("c1", 1, "one"), ("c1", 5, "one"), ("c2", 2, "two"), (None, 4, None)]
MODES = [
    {},
    {"broadcast": "never"},
    {"broadcast": "never", "min_hot_rows": 2},
    {"broadcast": "never", "min_hot_rows": 1},
    {"max_broadcast_bytes": 0},
    {"max_broadcast_bytes": 0, "min_hot_rows": 1},
    {"dim_bytes": 1},
    {"dim_bytes": 10**12},
]


@pytest.mark.parametrize("mode", MODES)
def test_every_fact_row_is_kept(fact, dim, mode):
    joined = lookup_join(fact, dim, "k", ["name"], **mode)
    assert joined.columns == ["k", "id", "name"]
    assert rows(joined) == sorted(WANT, key=repr)


@pytest.mark.parametrize("mode", MODES)
def test_repeated_lookup_key_repeats_the_fact(spark, fact, dim, mode):
    repeated = dim.unionByName(spark.createDataFrame([("c1", "uno", "x")], dim.schema))
    joined = lookup_join(fact, repeated, "k", ["name"], **mode)
    assert joined.count() == 7
    assert rows(joined.filter("id = 5").select("name")) == [("one",), ("uno",)]
    with pytest.raises(ValueError, match="c1"):
        lookup_join(fact, repeated, "k", ["name"], require_unique=True, **mode)


def test_repeated_null_keys_are_unique_enough(fact, dim):
    doubled = dim.unionByName(dim.filter("k is null"))
    joined = lookup_join(fact, doubled, "k", ["name"], require_unique=True)
    assert rows(joined) == sorted(WANT, key=repr)


def test_clashing_columns(fact, dim):
    with pytest.raises(ValueError, match="name"):
        lookup_join(fact.withColumn("name", F.lit("x")), dim, "k", ["name"])


def test_unknown_mode(fact, dim):
    with pytest.raises(ValueError, match="always"):
        lookup_join(fact, dim, "k", ["name"], broadcast="always")


def skewed(spark, size=60_000):
    """A third of the rows on one key, a tenth without key."""
    n = F.col("id")
    key = F.when(n % 10 == 3, None).when(n % 3 == 0, "hot").otherwise((n % 997).cast("string"))
    return spark.range(size, numPartitions=8).select(n, key.alias("k"))


def lookups(spark):
    named = spark.range(0, 900).select(
        F.col("id").cast("string").alias("k"), F.concat(F.lit("n"), "id").alias("name")
    )
    return named.unionByName(spark.createDataFrame([("hot", "hottest")], "k string, name string"))


def test_hot_keys(spark):
    fact = skewed(spark)
    assert hot_keys(fact, "k", 10_000) == ["hot"]
    assert hot_keys(fact, "k", 10**9) == []
    assert len(hot_keys(fact, "k", 1, limit=5)) == 5
    assert hot_keys(fact, "k", 1, limit=1) == ["hot"]


def test_hot_and_missing_keys_are_dealt_to_several_tasks(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "fact"))
    lookups(spark).write.parquet(str(tmp_path / "dim"))
    fact, dim = (spark.read.parquet(str(tmp_path / t)) for t in ("fact", "dim"))
    want = rows(fact.join(dim, "k", "left"))
    assert hot_key_rows(fact, ["k", "id"], 4_000) == {"k": {"hot": 18_000, None: 6_000}, "id": {}}
    joined = lookup_join(fact, dim, "k", ["name"], broadcast="never", min_hot_rows=4_000)
    assert rows(joined) == want
    tree = plan(joined).split("\n\n")[0].split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in tree and "BroadcastHashJoin" not in tree and "Union" not in tree
    assert tree.count("Scan parquet") == 2  # the facts once, the lookup once
    few = lookup_join(fact, dim, "k", ["name"], broadcast="never", hot={"hot": 18_000, None: 6_000}, min_hot_rows=4_000)
    assert rows(few) == want


def test_star_join_beyond_the_bound_scans_the_orders_once(spark, tmp_path):
    n = F.col("id")
    orders = spark.range(4_000, numPartitions=4).select(
        n.cast("string").alias("order_id"), F.when(n % 7 > 0, (n % 5).cast("string")).alias("customer_id"),
        F.when(n % 3 > 0, (n % 11).cast("string")).alias("product_id"), F.lit(1).alias("quantity"),
        F.lit("completed").alias("status"), F.lit(1.0).alias("amount"), F.lit("clean").alias("data_quality_flag"),
        F.lit("2024-01-01").alias("order_date"),
    )
    orders.write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    people = spark.range(4).selectExpr("cast(id as string) customer_id", "concat('c', id) customer_name", "'x' city")
    goods = spark.range(9).selectExpr("cast(id as string) product_id", "concat('p', id) product_name", "'y' category")
    found = enrich_orders(orders, people, goods, broadcast="never", min_hot_rows=300).drop("updated_timestamp")
    plain = enrich_orders(orders, people, goods).drop("updated_timestamp")
    assert rows(found) == rows(plain)
    initial = plan(found).split("\n\n")[0].split("== Initial Plan ==")[0]
    assert initial.count("Scan parquet") == 1 and initial.count("SortMergeJoin") == 2


def test_hot_lookup_rows_beyond_the_bound_stay_in_the_shuffle_join(spark):
    fact, dim = skewed(spark, 6_000), lookups(spark)
    joined = lookup_join(
        fact, dim, "k", ["name"], max_broadcast_bytes=0, min_hot_rows=1_000
    )
    assert rows(joined) == rows(fact.join(dim, "k", "left"))


def test_small_lookup_leaves_the_fact_in_place(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "fact"))
    lookups(spark).write.parquet(str(tmp_path / "dim"))
    fact, dim = (spark.read.parquet(str(tmp_path / t)) for t in ("fact", "dim"))
    shown = plan(lookup_join(fact, dim, "k", ["name"]))
    assert "BroadcastHashJoin LeftOuter BuildRight" in shown
    assert "BroadcastExchange" in shown and "Exchange hashpartitioning" not in shown
    assert "SortMergeJoin" not in shown


def test_enriched_orders(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "p1", 1, "completed", 5.0, "clean", "x"),
            ("o2", "c9", "p9", 1, "completed", 6.0, "clean", "x"),
            ("o3", "c1", "p1", 1, "Completed", 7.0, "clean", "x"),
            ("o4", "c1", "p1", 1, None, 8.0, "clean", "x"),
        ],
        "order_id string, customer_id string, product_id string, quantity int, status string,"
        " amount double, data_quality_flag string, source_file string",
    ).selectExpr("*", "date'2024-01-01' as order_date", "current_timestamp() as updated_timestamp")
    customers = spark.createDataFrame(
        [("c1", "Ann", "a@b", "Oslo", "f")],
        "customer_id string, customer_name string, email string, city string, source_file string",
    )
    products = spark.createDataFrame(
        [("p1", "Pen", "Office", "f")],
        "product_id string, product_name string, category string, source_file string",
    )
    for mode in ({}, {"broadcast": "never"}, {"customer_bytes": 1, "product_bytes": 1}):
        found = enrich_orders(orders, customers, products, **mode)
        assert found.columns == [*ENRICHED, "updated_timestamp"]
        assert rows(found.select("order_id", "customer_name", "city", "product_name")) == [
            ("o1", "Ann", "Oslo", "Pen"),
            ("o2", None, None, None),
        ]
