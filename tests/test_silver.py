"""Silver tables from inputs with columns missing or of another type."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from siltstone.constants import INGEST_SEQ
from siltstone.plans import silver
from siltstone.session import shared_folder
from siltstone.sources.lake import Lake


def test_orders_without_date_or_status(spark):
    df = spark.createDataFrame([("O1", "1"), ("O1", "2")], "order_id string, customer_id string")
    assert rows(silver.orders(df)) == [("O1", 1)]


def test_orders_with_null_ids_collapse_into_one(spark):
    df = spark.createDataFrame(
        [(None, "a", 1), (None, "b", 0), ("O1", "c", 2)],
        f"order_id string, order_status string, {INGEST_SEQ} int",
    )
    assert rows(silver.orders(df)) == [(None, "B", False), ("O1", "C", False)]


def test_accounts_with_ids_only(spark):
    df = spark.createDataFrame([("1",), ("1",), ("x",), (None,)], "customer_id string")
    assert rows(silver.accounts(df)) == [(1,)]


def test_sales_without_dates_or_channel(spark):
    df = spark.createDataFrame(
        [("1", "5"), ("1", "5.0"), ("1", "x"), ("1", None), ("y", "1")],
        "customer_id string, sales_amount string",
    )
    assert rows(silver.sales(df)) == [(1, None, False), (1, 5.0, True)]


def test_sales_repeats_are_found_after_parsing(spark):
    df = spark.createDataFrame(
        [
            ("1", "2024-01-05", "5", "web", 0),
            ("1", "01/05/2024", "5.0", "store", 1),
            ("1", "2024-01-05 00:00:01", "5", "web", 2),
        ],
        f"customer_id string, spend string, sales_amount string, channel string, {INGEST_SEQ} int",
    )
    got = silver.sales(df, max_valid_date=date(2024, 1, 5))
    assert got.columns == [
        "customer_id",
        "spend",
        "sales_amount",
        "channel",
        "spend_date_parsed",
        "is_future_date",
        "spend_year",
        "spend_month",
        "spend_quarter",
        "has_valid_date",
        "has_valid_amount",
    ]
    assert rows(got.select("spend_date_parsed", "channel", "is_future_date")) == [
        (at("2024-01-05"), "Web", False),
        (at("2024-01-05T00:00:01"), "Web", True),
    ]


def test_files_are_sorted_by_key(spark, tmp_path):
    i = F.col("id")
    ids = spark.range(2000).select(
        ((i * 7919) % 2000).cast("string").alias("customer_id"), i.alias("v")
    )
    lake = Lake(spark, str(tmp_path))
    lake.publish("silver", "accounts", silver.accounts(ids))
    files = [str(f) for f in (tmp_path / "silver" / "accounts").glob("_slot0/*.parquet")]
    assert files
    for file in files:
        keys = [r.customer_id for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_empty_input_can_be_published(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    empty = spark.createDataFrame([], "customer_id string, account_type string")
    assert lake.publish("silver", "accounts", silver.accounts(empty)).row_count == 0
    assert lake.read("silver", "accounts").columns == ["customer_id", "account_type"]


def test_shared_folder_follows_the_session(spark, settings):
    assert shared_folder(spark, "a") != shared_folder(spark, "a")
    root = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/siltstone"
    assert shared_folder(spark, "a").startswith(f"{root}/a-")


@pytest.mark.parametrize("kind", ["bigint", "int", "double"])
def test_ids_that_are_numbers_already(spark, kind):
    df = spark.sql(f"select cast(1 as {kind}) customer_id, 'x' account_type")
    assert rows(silver.accounts(df)) == [(1, "X")]
