"""The whole refresh on the 13 / 7 / 5-row sample, with every published result."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

import pytest

from tests.helpers import rows
from tierstone.__main__ import main
from tierstone.plans import Landing, layer_audit, refresh, table_path
from tierstone.plans.layers import UPSTREAM
from tierstone.plans.sizing import shuffle_partitions, split_bytes, total_bytes
from tierstone.plans import ingest
from tierstone.plans.fixed_values import ORDERS as ORDER_COLUMNS
from tierstone.sources import SchemaChanged, read_snapshot, snapshot_history

ORDERS = """order_id,customer_id,product_id,quantity,order_date,status,amount
1001,C001,P001,1,2024-01-10,completed,1500.0
1001,C001,P001,1,2024-01-10,completed,1500.0
1002,C002,P002,2,2024-01-11,completed,1400.0
1003,C001,P002,1,2024-01-12,completed,1200.0
1004,C001,P003,3,2024-01-13,completed,150.0
1005,C002,P004,1,2024-01-14,completed,600.0
1006,C003,P001,1,2024-01-15,completed,1500.0
1007,C005,P005,2,2024-01-16,completed,450.0
1008,C006,P004,1,2024-01-17,cancelled,300.0
1009,C007,P003,2,2024-01-18,pending,200.0
1010,C004,P003,1,2024-01-19,completed,
1011,,P002,1,2024-01-20,completed,700.0
1012,C003,P005,1,2024-01-21,,250.0
"""
CUSTOMERS = """customer_id,customer_name,email,city
C001,  alice smith ,Alice.Smith@Example.COM,mumbai
C002,BOB JONES,BOB@EXAMPLE.COM,DELHI
C003,carol  white,carol@example.com,Pune
C004, Dev Rao,Dev@Example.com,pune
C005,eSHA gupta ,esha@example.com,CHENNAI
C006,Farid Khan,farid@example.com,Delhi
C007,gita n'air,,Mumbai
"""
PRODUCTS = """product_id,product_name,category
P001,Laptop,Electronics
P002,Phone,Electronics
P003,Shirt,Fashion
P004,Mixer,Appliances
P005,Racket,Sports
"""
AT = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
TABLES = list(UPSTREAM)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    texts = {"orders": ORDERS, "customers": CUSTOMERS, "products": PRODUCTS}
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return Landing(**{name: str(folder / f"{name}.csv") for name in texts})


@pytest.fixture(scope="module")
def root(spark, landing, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    refresh(spark, landing, path, at=AT)
    return path


@pytest.fixture(scope="module")
def table(spark, root):
    return lambda name: read_snapshot(spark, table_path(root, name))


@pytest.mark.parametrize(
    "name, count",
    {
        "bronze_orders": 13,
        "bronze_customers": 7,
        "bronze_products": 5,
        "silver_orders": 11,
        "silver_customers": 7,
        "silver_products": 5,
        "gold_enriched_orders": 8,
        "gold_sales_by_city": 4,
        "gold_sales_by_category": 4,
        "gold_top_customers": 5,
    }.items(),
)
def test_row_counts(table, name, count):
    assert table(name).count() == count


def test_audit_matches_row_counts(spark, root):
    audit = {r["table"]: tuple(r)[1:] for r in layer_audit(spark, root).collect()}
    assert list(audit) == TABLES
    assert audit["bronze_orders"] == ("bronze", None, 13, None, True, None)
    assert audit["silver_orders"] == ("silver", 13, 11, 2, True, None)
    assert audit["silver_customers"] == ("silver", 7, 7, 0, True, None)
    assert audit["gold_enriched_orders"] == ("gold", 11, 8, 3, True, None)
    assert audit["gold_top_customers"] == ("gold", 8, 5, 3, True, None)


def test_bronze_keeps_rows_as_they_came(table):
    orders = table("bronze_orders")
    assert orders.filter("order_id = '1001'").count() == 2
    assert orders.filter("order_id = '1010'").first()["amount"] is None
    assert orders.schema["order_date"].dataType.simpleString() == "string"
    stamp = orders.select("source_file", "ingestion_timestamp").distinct().collect()
    assert [r["source_file"] for r in stamp] == ["orders.csv"]
    names = {r[0] for r in table("bronze_customers").select("customer_name").collect()}
    assert {"  alice smith ", "BOB JONES", " Dev Rao"} <= names


def test_dirty_orders_are_resolved(table):
    orders = {r["order_id"]: r for r in table("silver_orders").collect()}
    assert "1011" not in orders
    assert (orders["1010"]["amount"], orders["1010"]["data_quality_flag"]) == (
        0.0,
        "missing_amount",
    )
    assert (orders["1012"]["status"], orders["1012"]["data_quality_flag"]) == (
        "unknown",
        "missing_status",
    )
    clean = [r for r in orders.values() if r["data_quality_flag"] == "clean"]
    assert len(clean) == 9
    assert orders["1001"]["order_date"] == date(2024, 1, 10)


def test_customers_are_normalised(table):
    people = {
        r["customer_id"]: (r["customer_name"], r["email"], r["city"])
        for r in table("silver_customers").collect()
    }
    assert people["C001"] == ("Alice Smith", "alice.smith@example.com", "Mumbai")
    assert people["C002"] == ("Bob Jones", "bob@example.com", "Delhi")
    assert people["C003"][0] == "Carol  White"
    assert people["C005"] == ("Esha Gupta", "esha@example.com", "Chennai")
    assert people["C007"] == ("Gita N'air", None, "Mumbai")


def test_sales_reports(table):
    assert rows(table("gold_sales_by_city"), "city") == [
        ("Chennai", 1, 450.0, 450.0),
        ("Delhi", 2, 2000.0, 1000.0),
        ("Mumbai", 3, 2850.0, 950.0),
        ("Pune", 2, 1500.0, 750.0),
    ]
    assert rows(table("gold_sales_by_category"), "category") == [
        ("Appliances", 1, 600.0, 600.0),
        ("Electronics", 4, 5600.0, 1400.0),
        ("Fashion", 2, 150.0, 75.0),
        ("Sports", 1, 450.0, 450.0),
    ]


def test_top_customers(table):
    assert rows(table("gold_top_customers"), "rank") == [
        ("C001", "Alice Smith", 3, 2850.0, 1),
        ("C002", "Bob Jones", 2, 2000.0, 2),
        ("C003", "Carol  White", 1, 1500.0, 3),
        ("C005", "Esha Gupta", 1, 450.0, 4),
        ("C004", "Dev Rao", 1, 0.0, 5),
    ]


@pytest.mark.parametrize(
    "name, columns",
    {
        "bronze_orders": "order_id:string,customer_id:string,product_id:string,quantity:int,"
        "order_date:string,status:string,amount:double,ingestion_timestamp:timestamp,"
        "source_file:string",
        "silver_orders": "order_id:string,customer_id:string,product_id:string,quantity:int,"
        "order_date:date,status:string,amount:double,ingestion_timestamp:timestamp,"
        "source_file:string,data_quality_flag:string,updated_timestamp:timestamp",
        "silver_customers": "customer_id:string,customer_name:string,email:string,city:string,"
        "ingestion_timestamp:timestamp,source_file:string,updated_timestamp:timestamp",
        "silver_products": "product_id:string,product_name:string,category:string,"
        "ingestion_timestamp:timestamp,source_file:string,updated_timestamp:timestamp",
        "gold_enriched_orders": "order_id:string,order_date:date,customer_id:string,"
        "customer_name:string,city:string,product_id:string,product_name:string,"
        "category:string,quantity:int,amount:double,data_quality_flag:string,"
        "updated_timestamp:timestamp",
        "gold_sales_by_city": "city:string,total_orders:bigint,total_revenue:double,"
        "avg_order_value:double",
        "gold_sales_by_category": "category:string,total_orders:bigint,total_revenue:double,"
        "avg_order_value:double",
        "gold_top_customers": "customer_id:string,customer_name:string,total_orders:bigint,"
        "total_spent:double,rank:int",
    }.items(),
)
def test_schemas(table, name, columns):
    assert table(name).schema.simpleString() == f"struct<{columns}>"


def test_second_run_adds_a_version_with_the_same_rows(spark, landing, tmp_path):
    root = str(tmp_path)
    refresh(spark, landing, root, at=AT)
    commits = refresh(spark, landing, root, at=AT)
    assert {c.version for c in commits.values()} == {1}
    for name in TABLES:
        path = table_path(root, name)
        before, after = (read_snapshot(spark, path, version_as_of=v) for v in (0, 1))
        assert rows(before) == rows(after), name
        assert [r["version"] for r in snapshot_history(spark, path).collect()] == [1, 0]


def test_files_with_more_columns(spark, landing, tmp_path):
    root = str(tmp_path / "tables")
    refresh(spark, landing, root, at=AT)
    wider = tmp_path / "products.csv"
    wider.write_text("product_id,product_name,category,brand\nP001,Laptop,Electronics,Acme\n")
    changed = Landing(landing.orders, landing.customers, str(wider))
    refresh(spark, changed, root, at=AT, overwrite_schema=True)
    path = table_path(root, "silver_products")
    assert read_snapshot(spark, path).first()["brand"] == "Acme"
    assert "brand" not in read_snapshot(spark, path, version_as_of=0).columns
    assert read_snapshot(spark, table_path(root, "gold_enriched_orders")).count() == 8


def test_orders_laid_out_by_day_and_status(spark, landing, root, tmp_path):
    laid = str(tmp_path / "tables")
    refresh(spark, landing, laid, orders_layout=["order_date", "status"])
    for name in ("silver_orders", "gold_sales_by_city", "gold_top_customers"):
        stored = (read_snapshot(spark, table_path(r, name)) for r in (root, laid))
        want, got = (x.drop("ingestion_timestamp", "updated_timestamp", "source_file") for x in stored)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_task_sizes_follow_the_data():
    mb, tb = 1024**2, 1024**4
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 * 256 * mb + 1, 8) == 101
    assert shuffle_partitions(100 * 256 * mb, 200) == 200
    assert shuffle_partitions(100 * tb, 200) == 50_000
    assert split_bytes(0) == split_bytes(tb) == 128 * mb
    assert 500 * mb < split_bytes(50 * tb) < 600 * mb
    assert split_bytes(10_000 * tb) == 1024 * mb


def test_session_settings_are_restored(spark, landing, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    refresh(spark, landing, str(tmp_path), at=AT)
    assert [spark.conf.get(n) for n in names] == before
    assert total_bytes(spark, landing.orders) == len(ORDERS)


def test_command_line(spark, landing, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    arguments = ["--root", str(tmp_path)]
    for name in ("orders", "customers", "products"):
        arguments += [f"--{name}", getattr(landing, name)]
    main(arguments)
    printed = capsys.readouterr().out
    assert "gold_top_customers" in printed and "Alice Smith" in printed and "orders.csv" in printed


def _files(folder, **texts):
    folder.mkdir()
    texts = {"orders": ORDERS, "customers": CUSTOMERS, "products": PRODUCTS} | texts
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return Landing(**{name: str(folder / f"{name}.csv") for name in texts})


def _columns(text, order):
    return "\n".join(",".join((line.split(",") + ["new"])[i] for i in order) for line in text.strip().split("\n")) + "\n"


@pytest.mark.parametrize("entity, text", [("orders", ORDERS), ("customers", CUSTOMERS), ("products", PRODUCTS)])
def test_changed_files_raise_and_come_in_when_asked_for(spark, tmp_path, entity, text):
    n = text.split("\n")[0].count(",") + 1
    tables = str(tmp_path / "tables")
    refresh(spark, _files(tmp_path / "first"), tables, at=AT)
    swapped = _columns(text, [1, 0, *range(2, n)])
    for i, changed in enumerate((_columns(text, range(n + 1)), _columns(text, range(n - 1)), swapped)):
        landing = _files(tmp_path / f"changed{i}", **{entity: changed})
        with pytest.raises(SchemaChanged):
            refresh(spark, landing, tables, at=AT)
    refresh(spark, landing, tables, at=AT, overwrite_schema=True)
    found = read_snapshot(spark, table_path(tables, f"bronze_{entity}"))
    key = f"{entity[:-1]}_id"
    assert {r[0] for r in found.select(key).collect()} == {x.split(",")[0] for x in text.strip().split("\n")[1:]}
    assert found.columns[:2] == swapped.split("\n")[0].split(",")[:2]


def test_audit_tells_lost_rows_and_mixed_refreshes(spark, landing, tmp_path):
    root = str(tmp_path / "tables")
    refresh(spark, landing, root, at=AT, count_source=True)
    audit = {r["table"]: r for r in layer_audit(spark, root, read_back=True).collect()}
    assert all(r["follows"] and r["rows_stored"] == r["rows_out"] for r in audit.values())
    assert (audit["bronze_orders"]["rows_in"], audit["bronze_orders"]["rows_removed"]) == (13, 0)

    # a quoted line feed swallows a row: the files have one line more than the table has rows
    broken = ORDERS.replace("1004,C001", '"1004,C001').replace("600.0\n", '600.0"\n')
    lost = _files(tmp_path / "lost", orders=broken)
    refresh(spark, lost, root, at=AT, count_source=True)
    audit = {r["table"]: r for r in layer_audit(spark, root).collect()}
    stored = read_snapshot(spark, table_path(root, "bronze_orders"))
    assert audit["bronze_orders"]["rows_in"] == 13 and audit["bronze_orders"]["rows_out"] == stored.count()

    ingest(spark, landing.orders, table_path(root, "bronze_orders"), ORDER_COLUMNS, source_file="again")
    audit = {r["table"]: r for r in layer_audit(spark, root).collect()}
    assert not audit["silver_orders"]["follows"] and audit["silver_customers"]["follows"]
    assert audit["silver_orders"]["rows_removed"] >= 0 and audit["bronze_orders"]["rows_in"] is None
    part = next((tmp_path / "tables" / "gold_top_customers").glob("v=1-*/part-*.parquet"))
    keep = spark.read.parquet(str(part)).limit(1).toPandas()
    keep.to_parquet(part)
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    audit = {r["table"]: r for r in layer_audit(spark, root, read_back=True).collect()}
    assert audit["gold_top_customers"]["rows_stored"] < audit["gold_top_customers"]["rows_out"]


def test_overlapping_refreshes_leave_the_settings_alone(spark, landing, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(refresh, spark, landing, str(tmp_path / f"t{i}"), at=AT) for i in range(2)]
        assert all(r.result()["gold_top_customers"].num_rows == 5 for r in runs)
    assert [spark.conf.get(n) for n in names] == before


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    root = str(tmp_path / "tables")
    landing = _files(tmp_path / "bad", orders=ORDERS + "1013,C001,P001,many,2024-01-22,completed,5.0\n")
    refresh(spark, landing, root, at=AT, corrupt_column="bad_line")
    bronze = read_snapshot(spark, table_path(root, "bronze_orders"))
    assert [r[0] for r in bronze.select("bad_line").where("bad_line is not null").collect()] == [
        "1013,C001,P001,many,2024-01-22,completed,5.0"
    ]
    assert "bad_line" not in read_snapshot(spark, table_path(root, "silver_orders")).columns
