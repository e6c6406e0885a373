"""Raw files to report, end to end."""

import json

import pytest

from helpers import at, rows
from siltstone.plans import medallion
from siltstone.plans.medallion import run
from siltstone.sources.files import read_sheet
from siltstone.sources.lake import Lake
from siltstone.workload import tables

CUSTOMERS = "customer_id,name,email,age,country,last_updated\n"
FILES = {
    "customers_1_full.csv": CUSTOMERS
    + "1,ANN lee,ANN@X.COM,30,France,2024-01-01T00:00:00Z\n"
    + "2,bo,bo-no-at,70,Peru,2024-01-02T00:00:00Z\n"
    + "2,bo again,bo@y.org,,UAE,2024-01-01T00:00:00Z\n",
    "customers_2_.csv": CUSTOMERS
    + "A7,odd,odd@id.org,40,France,2024-01-03T00:00:00Z\n"
    + "9,undated,u@u.u,40,France,soon\n"
    + " 01,ann NEW,ann@new.com,31,Canada,2024-01-03T00:00:00Z\n"
    + "3,late,l@l.l,20,India,2024-01-02T00:00:00Z\n",
    "customers_3_.csv": "email,customer_id,last_updated\nc@c.c,4,2024-01-04T00:00:00Z\n",
    "book/orders.csv": "Order ID,customer_id,order_amount,order_date,order_status,product_id\n"
    + "O1,1,2000.50,2024-01-05, cancelled ,P1\n"
    + "O1,1,1,2024-01-06,shipped,P1\n"
    + "O2,2,oops,2024-02-05 10:00:00,Shipped,P2\n"
    + "O3,x,1500,05/01/2024,refunded,P9\n",
    "book/accounts.csv": "customer_id,account_type,country\n"
    + "1, gold plus ,france\n1,basic,france\nx,basic,uae\n",
    "book/sales_history.csv": "customer_id,spend,sales_amount,channel\n"
    + '1,"November 10, 2027",9000,online\n'
    + "1,2024-01-05,1500.5, IN store\n"
    + "1,01/05/2024,1500.5,web\n"
    + "2,never,,web\n"
    + ",2024-01-05,5,web\n",
    "products.json": json.dumps(
        [
            {
                "product_id": f"P{i}",
                "name": f"Product {i}",
                "category": "c",
                "specs": {"storage": {"capacity_gb": [64, 128]}},
                "pricing": {"base_price": 10.0 * i, "discounts": [{"amount": 1}]},
            }
            for i in (1, 2)
        ]
    ),
}
CONFIG = {
    "csv_files": {
        "baseline": "customers_1_full.csv",
        "incremental": ["customers_2_.csv", "customers_3_.csv"],
    },
    "json_files": ["products.json"],
    "sheets": {"folder": "book", "names": ["orders", "accounts", "sales_history", "notes"]},
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "book").mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return folder


@pytest.fixture(scope="module")
def result(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return run(spark, str(raw), str(out), CONFIG), Lake(spark, str(out))


def test_all_tables_are_written(result):
    _, lake = result
    for name in ("customers", "products_raw", "orders", "accounts", "sales_history"):
        assert lake.exists("bronze", name)
    for name in ("customers", "products", "orders", "accounts", "sales_history"):
        assert lake.exists("silver", name)
    assert lake.exists("gold", "report_data")
    assert lake.last_commit("bronze", "customers").watermark == "2024-01-04 00:00:00"


def test_silver_contents(result):
    _, lake = result
    customers = lake.read("silver", "customers").select(
        "customer_id", "name", "email", "age_group", "email_domain", "region", "last_updated"
    )
    assert rows(customers) == [
        ("1", "Ann New", "ann@new.com", "25-34", "new.com", "Americas", at("2024-01-03")),
        ("2", "Bo", "bo-no-at", "65+", None, "Other", at("2024-01-02")),
        ("4", None, "c@c.c", "65+", "c.c", "Other", at("2024-01-04")),
        ("A7", "Odd", "odd@id.org", "35-44", "id.org", "Europe", at("2024-01-03")),
    ]
    assert rows(lake.read("silver", "accounts")) == [(1, "Gold Plus", "FRANCE")]
    sales = lake.read("silver", "sales_history")
    assert rows(sales.select("customer_id", "channel", "is_future_date", "spend_quarter")) == [
        (1, "In Store", False, "Q1"),
        (1, "Online", True, "Q4"),
        (2, "Web", None, None),
    ]
    assert all("ingest_seq" not in lake.read("silver", t).columns for t in ("orders", "customers"))


def test_report(result):
    (report, _), lake = result
    assert len(report.columns) == 52
    got = report.select(
        "order_id",
        "customer_id",
        "name",
        "order_amount",
        "order_status",
        "is_cancelled",
        "order_date_parsed",
        "product_name",
        "max_storage_gb",
        "effective_price",
        "total_sales_amount",
        "avg_sales_amount",
        "sales_transaction_count",
        "is_high_value_order",
        "is_high_value_customer",
    )
    assert rows(got) == [
        ("O1", 1, "Ann New", 2000.5, "CANCELLED", True, at("2024-01-05"), "Product 1", 128, 9.0)
        + (10500.5, 5250.25, 2, True, True),
        ("O2", 2, "Bo", None, "SHIPPED", False, at("2024-02-05T10:00:00"), "Product 2", 128, 19.0)
        + (None, None, 0, None, None),
        ("O3", None, None, 1500.0, "REFUNDED", True, None, None, None, None)
        + (None, None, None, False, None),
    ]
    assert report.select("order_id").distinct().count() == report.count()
    assert report.count() == lake.read("silver", "orders").count()


def test_checks(result):
    (_, quality), _ = result
    values = {(r.table_name, r.check_name, r.column_name): r.value for r in quality.collect()}
    assert values["customers_bronze", "duplicate_rows", "customer_id"] == 1
    assert values["customers_silver", "duplicate_rows", "customer_id"] == 0
    assert values["customers_bronze", "undated_delta_rows", "last_updated"] == 1
    assert values["orders_bronze", "duplicate_rows", "order_id"] == 1
    assert values["orders_bronze", "missing_column", "order_id"] == 0
    assert values["sales_history_bronze", "null_count", "customer_id"] == 1
    assert values["sales_history_silver", "duplicate_rows", "customer_id"] == 1
    assert values["report_table", "row_count", None] == 3
    assert ("sales_history_bronze", "duplicate_rows", "customer_id") not in values
    assert ("report_table", "duplicate_rows", "order_id") not in values


def test_second_run_replays_everything(spark, raw, result):
    (report, _), lake = result
    before = rows(report)
    again = run(spark, str(raw), lake.root, CONFIG, fail_on=["empty_rows"])
    assert rows(again.report) == before
    assert lake.last_commit("gold", "report_data").version == 1


def test_sales_and_accounts_are_optional(spark, raw, tmp_path):
    config = {**CONFIG, "sheets": {"folder": "book", "names": ["orders"]}}
    report, quality = run(spark, str(raw), str(tmp_path), config)
    assert report.count() == 3 and "total_sales_amount" not in report.columns
    assert quality.filter("table_name like 'accounts%'").isEmpty()


def test_repeated_product_stops_the_run(spark, raw, tmp_path):
    import shutil

    other = tmp_path / "raw"
    shutil.copytree(raw, other)
    record = {"product_id": "P1", "name": "twice", "category": "c"}
    (other / "more.json").write_text(json.dumps([record]))
    config = {**CONFIG, "json_files": ["products.json", "more.json"]}
    with pytest.raises(ValueError, match="product_id is not unique"):
        run(spark, str(other), str(tmp_path / "out"), config)


def test_a_failing_check_leaves_gold_as_it_was(spark, raw, tmp_path):
    """Checks are counted as a table is written and end the run before it is replaced."""
    first = run(spark, str(raw), str(tmp_path), CONFIG)
    lake, before = Lake(spark, str(tmp_path)), rows(first.report)
    values = {(r.table_name, r.check_name, r.column_name): r.value for r in first.quality.collect()}
    assert values["sales_history_silver", "future_dates", "is_future_date"] == 1
    assert values["orders_silver", "removed_rows", None] == 1
    commits = {t: lake.last_commit(*t) for t in [("gold", "report_data"), ("silver", "orders"), ("bronze", "orders")]}
    with pytest.raises(ValueError, match="quality check failed.*null_count"):
        run(spark, str(raw), str(tmp_path), CONFIG, fail_on=["null_count"])
    assert {t: lake.last_commit(*t) for t in commits}["gold", "report_data"] == commits["gold", "report_data"]
    assert lake.last_commit("silver", "orders") == commits["silver", "orders"]
    assert rows(lake.read("gold", "report_data")) == before
    found = lake.read("quality", "checks")
    assert not found.filter("check_name = 'null_count' and value > 0").isEmpty()
    assert found.filter("table_name = 'report_table'").isEmpty()


def test_silver_sorts_by_numbers_not_file_names(spark, raw, tmp_path, monkeypatch):
    """What a row carries through the sort and shuffle of its deduplication."""
    kinds = {}

    def seen(name, plan):
        def spy(bronze):
            kinds[name] = bronze.schema["ingest_seq"].dataType.simpleString()
            return plan(bronze)

        return spy

    for name, plan in medallion.SHEET_PLANS.items():
        monkeypatch.setitem(medallion.SHEET_PLANS, name, seen(name, plan))
    monkeypatch.setattr(medallion.silver, "customers", seen("customers", medallion.silver.customers))
    run(spark, str(raw), str(tmp_path), CONFIG)
    assert kinds == dict.fromkeys(["customers", "orders", "accounts", "sales_history"], "bigint")
    lake = Lake(spark, str(tmp_path))
    assert lake.read("bronze", "orders").schema["ingest_seq"].dataType.simpleString().startswith("struct")
    assert [r[0] for r in lake.read("silver", "orders").filter("order_id = 'O1'").select("order_amount").collect()] == [2000.5]


def test_raw_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    """No raw file is plain or holds more than RAW_RECORDS, and all rows come back in order."""
    import gzip
    from pathlib import Path

    monkeypatch.setattr(tables, "RAW_RECORDS", 4)
    monkeypatch.setattr(tables, "shared_folder", lambda _, purpose: f"{tmp_path}/{purpose}")
    day = "cast(timestamp'1997-03-05 00:00:00' as timestamp_ntz)"
    sources = {
        "customer": "id as c_custkey, 'n' || id as c_name, 'BUILDING' as c_mktsegment",
        "part": "id as p_partkey, 'p' as p_name, 'b' as p_brand, 't' as p_type, cast(id as int) as p_size, 1.5D as p_retailprice",
        "orders": f"id as o_orderkey, id as o_custkey, 'F' as o_orderstatus, 10D as o_totalprice, {day} as o_orderdate",
        "lineitem": f"id as l_orderkey, id as l_partkey, cast(id % 3 as int) as l_linenumber, 10D as l_extendedprice, {day} as l_shipdate",
    }
    for name, columns in sources.items():
        spark.range(1, 24, 1, 1).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    root, config = tables._raw_files(spark, f"{tmp_path}/sf")
    files = [f for f in Path(root).rglob("part-*") if f.is_file()]
    assert files and all(f.name.endswith(".gz") for f in files)
    assert all(gzip.open(f, "rt").read().count("\n") <= 5 for f in files)
    assert len(list(Path(root, "products.jsonl").glob("part-*"))) == 6
    assert spark.read.text(f"{root}/products.jsonl").count() == 23
    sales = tables.raw.SALES.frame(spark, f"{tmp_path}/sf")
    got = read_sheet(spark, f"{root}/book/sales_history.csv").orderBy("ingest_seq").select("customer_id", "sales_amount").collect()
    assert got == sales.select("customer_id", "sales_amount").collect()
