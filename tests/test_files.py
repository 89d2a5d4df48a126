import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import rows
from tierstone.operators import dedupe_by_key
from tierstone.plans import bronze_rows, ingest, rejected_values
from tierstone.plans.fixed_values import CUSTOMER_KEYS, ORDERS
from tierstone.sources import (
    SchemaChanged,
    count_lines,
    infer_schema,
    landing_inventory,
    latest_commit,
    lock_schema,
    read_snapshot,
    scan_csv,
)
from verification.raw_tables import write_csv


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    return write


def test_malformed_lines(spark, csv):
    path = csv("id,quantity\na,x\nb,1.0\nc\nd,4,5\ne,5\n")
    plain = scan_csv(spark, path, "id string, quantity int")
    assert rows(plain) == [("a", None), ("b", None), ("c", None), ("d", 4), ("e", 5)]
    kept = scan_csv(spark, path, "id string, quantity int", corrupt_column="bad_line")
    bad = {r["id"]: r["bad_line"] for r in kept.collect()}
    assert bad == {"a": "a,x", "b": "b,1.0", "c": "c", "d": "d,4,5", "e": None}
    typed = T.StructType.fromDDL("id string, quantity int")
    assert rows(scan_csv(spark, path, typed, corrupt_column="bad_line")) == rows(kept)


def test_quoted_empty_text_is_null(spark, csv):
    assert rows(scan_csv(spark, csv('a,b\n"",1\n'), "a string, b int")) == [(None, 1)]


def test_reordered_header(spark, csv):
    path = csv("amount,order_id\n5,o1\n")
    schema = "order_id string, amount string"
    assert rows(scan_csv(spark, path, schema, strict_header=False)) == [("5", "o1")]
    with pytest.raises(SchemaChanged, match="amount"):
        scan_csv(spark, path, schema)


@pytest.mark.parametrize("second", ["amount,order_id\n5,o1\n", "order_id,amount,x\no1,5,7\n", "order_id\no1\n"])
def test_later_files_with_another_header_fail(spark, tmp_path, second):
    (tmp_path / "a.csv").write_text("order_id,amount\no1,5\n" * 1)
    (tmp_path / "b.csv").write_text(second)
    with pytest.raises(SchemaChanged):
        ingest(spark, str(tmp_path / "*.csv"), str(tmp_path / "t"), "order_id string, amount string")


def test_lines_are_counted_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n\n3,4\n")
    (tmp_path / "b.csv").write_text("a,b\n")
    assert count_lines(spark, str(tmp_path / "*.csv")) == 2


def test_export_keeps_edge_spaces(spark, tmp_path):
    df = spark.createDataFrame([("  a b ", None), ("c", 1.5)], "t string, d double")
    path = write_csv(df, str(tmp_path / "out"))
    assert rows(scan_csv(spark, path, "t string, d double")) == rows(df)


def test_inference_with_text_keys(spark, csv):
    path = csv("customer_id,age,day\n1,30,2024-01-01\n2,31,2024-01-02\n")
    assert infer_schema(spark, path).simpleString() == "struct<customer_id:int,age:int,day:date>"
    forced = infer_schema(spark, path, overrides=CUSTOMER_KEYS)
    assert forced.simpleString() == "struct<customer_id:string,age:int,day:date>"
    with pytest.raises(ValueError, match="nope"):
        infer_schema(spark, path, overrides={"nope": "string"})


def test_locked_schema_outlives_the_file(spark, csv, tmp_path):
    lock = str(tmp_path / "lock")
    first = lock_schema(spark, csv("id,n\na,1\n"), lock)
    later = csv("id,n\na,text\n")
    assert infer_schema(spark, later) != first
    assert lock_schema(spark, later, lock) == first
    assert lock_schema(spark, "/no/such/file", lock) == first


def test_rows_carry_the_file_they_came_from(spark, csv, tmp_path):
    csv("id\na\n", "one.csv")
    csv("id\nb\n", "two.csv")
    paths = [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]
    found = bronze_rows(spark, paths, "id string")
    assert rows(found.select("id", "source_file")) == [("a", "one.csv"), ("b", "two.csv")]
    labelled = bronze_rows(spark, paths, "id string", source_file="feed")
    assert {r[0] for r in labelled.select("source_file").collect()} == {"feed"}
    assert found.filter(F.col("ingestion_timestamp").isNull()).count() == 0


def test_bronze_needs_a_schema_or_a_place_for_the_lock(spark, csv):
    with pytest.raises(ValueError, match="lock_path"):
        bronze_rows(spark, csv("id\na\n"))


def test_ingest_infers_once(spark, csv, tmp_path):
    table = str(tmp_path / "bronze")
    assert ingest(spark, csv("id,n\na,1\nb,2\n"), table).num_rows == 2
    # A later file with text in ``n`` is read under the locked int, not re-inferred.
    assert ingest(spark, csv("id,n\nc,x\n"), table).version == 1
    assert rows(read_snapshot(spark, table).select("id", "n")) == [("c", None)]


def test_awkward_header_names(spark, csv, tmp_path):
    table = str(tmp_path / "bronze")
    ingest(spark, csv("a.b,c d,e`f\nx,1,y\nx,2,y\n"), table, corrupt_column="bad_line")
    kept = dedupe_by_key(read_snapshot(spark, table).drop("bad_line"), ["`a.b`"])
    assert rows(kept.select("c d")) == [(1,)]


def test_intended_schema_change_renews_the_lock(spark, csv, tmp_path):
    table = str(tmp_path / "bronze")
    ingest(spark, csv("id,n\na,1\n"), table)
    changed = csv("id,n,extra\nb,x,2.5\n")
    ingest(spark, changed, table, overwrite_schema=True)
    assert rows(read_snapshot(spark, table).select("id", "n", "extra")) == [("b", "x", 2.5)]
    assert rows(read_snapshot(spark, table, version_as_of=0).select("id", "n")) == [("a", 1)]
    ingest(spark, changed, table)  # the renewed lock holds without asking again
    assert rows(read_snapshot(spark, table).select("extra")) == [(2.5,)]


def test_inventory(spark, csv, tmp_path):
    csv("12345", "a.csv")
    csv("1", "b.csv")
    listed = landing_inventory(spark, str(tmp_path))
    assert rows(listed.select(F.element_at(F.split("path", "/"), -1), "length")) == [
        ("a.csv", 5),
        ("b.csv", 1),
    ]


def test_declared_orders_schema(spark):
    assert spark.createDataFrame([], ORDERS).columns == [
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "order_date",
        "status",
        "amount",
    ]


def test_values_of_another_type_are_kept(spark, tmp_path):
    """A column locked as a number keeps the text that arrives later, with its line and file."""
    first, second, table = tmp_path / "a.csv", tmp_path / "b.csv", str(tmp_path / "t")
    first.write_text("id,zip,when\nk1,200,2024-01-02\n")
    assert ingest(spark, str(first), table).rejected_rows == 0
    second.write_text('id,zip,when\nk2,2O0-B,2024-01-03\nk3,7,soon\nk4,x,"late, or never"\nk5,8,2024-01-04\nk6,9,2024-01-05,extra\nk7,,\n')
    commit = ingest(spark, str(second), table)
    assert (commit.num_rows, commit.rejected_rows) == (6, 4) and "__source_line" not in commit.schema.names
    found = {(r["line"][:2], r["column"]): (r["value"], r["expected"], r["source_file"]) for r in rejected_values(spark, table).collect()}
    assert found == {
        ("k2", "zip"): ("2O0-B", "int", "b.csv"), ("k3", "when"): ("soon", "date", "b.csv"), ("k4", "zip"): ("x", "int", "b.csv"),
        ("k4", "when"): ("late, or never", "date", "b.csv"), ("k6", None): (None, "3 fields", "b.csv"),
    }
    stored = read_snapshot(spark, table)
    assert stored.columns == ["id", "zip", "when", "ingestion_timestamp", "source_file"] and stored.where("zip is null").count() == 3
    assert latest_commit(spark, table).rejected_rows == 4
    assert rejected_values(spark, ingest(spark, str(second), table, keep_rejects=False)).count() == 0
