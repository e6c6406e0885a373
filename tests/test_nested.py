"""Product records."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import applied
from siltstone.functions.nested import json_array_status
from siltstone.plans import silver
from siltstone.sources.files import records_of_arrays, snapshot_records

COLUMNS = """product_id product_name category height width depth diameter storage_options_gb
max_storage_gb storage_type battery_capacity_mah fast_charging playback_hours screen_type
screen_size_inches processor_brand processor_model ram_gb sensors ports features connectivity
compatibility base_price currency discount_count total_discount discount_types
effective_price""".split()


def product(**parts):
    return {"product_id": "P1", "name": "Phone", "category": "phones", **parts}


def flat(spark, record):
    df = spark.createDataFrame([(json.dumps(record),)], "raw_json string")
    result = silver.products(snapshot_records(df))
    assert result.columns == COLUMNS
    return result.first().asDict()


def test_full_record(spark):
    got = flat(
        spark,
        product(
            specs={
                "dimensions": {"height": 10, "width": 5.5, "depth": 1, "diameter": None},
                "storage": {"capacity_gb": [64, 128], "type": "SSD"},
                "battery": {"capacity_mAh": 4000, "fast_charging": "65W", "playback_hours": 12},
                "screen": {"type": "OLED", "size_inches": 6.1},
                "processor": {"brand": "X", "model": "Y1"},
                "ram_gb": 8,
                "sensors": ["gyro", "light"],
                "connectivity": ["wifi"],
            },
            pricing={
                "base_price": 100,
                "currency": "EUR",
                "discounts": [{"type": "sale", "amount": 5.5}, {"amount": 4}, {"type": "clear"}],
            },
        ),
    )
    assert (got["height"], got["width"], got["diameter"]) == (10.0, 5.5, None)
    assert (got["storage_options_gb"], got["max_storage_gb"]) == ("64,128", 128)
    assert (got["battery_capacity_mah"], got["playback_hours"]) == (4000, 12.0)
    assert (got["sensors"], got["ports"], got["connectivity"]) == ("gyro,light", "", "wifi")
    assert (got["discount_count"], got["total_discount"]) == (3, 9.5)
    assert (got["discount_types"], got["effective_price"]) == ("sale,,clear", 90.5)


@pytest.mark.parametrize(
    "capacity, options, largest",
    [
        ([64, 512, 128], "64,512,128", 512),
        (256, "256", 256),
        (64.9, "64", 64),
        ("256", None, None),
        (None, None, None),
        ([], "", None),
    ],
)
def test_capacity_of_any_form(spark, capacity, options, largest):
    got = flat(spark, product(specs={"storage": {"capacity_gb": capacity}}))
    assert (got["storage_options_gb"], got["max_storage_gb"]) == (options, largest)


def test_missing_parts_give_null_empty_text_or_zero(spark):
    got = flat(spark, product())
    assert got["height"] is None and got["base_price"] is None and got["storage_type"] is None
    assert got["sensors"] == got["discount_types"] == ""
    assert (got["discount_count"], got["total_discount"], got["effective_price"]) == (0, 0.0, 0.0)


def test_null_specs_and_price_without_base(spark):
    got = flat(spark, product(specs=None, pricing={"discounts": [{"amount": 3}]}))
    assert (got["base_price"], got["effective_price"]) == (None, -3.0)


def test_json_array_status(spark):
    given = ['[{"a":1}]', "[]", '{"a":1}', '[{"a":1}', "5", "", ' \n[{"a":[1]}]', "[1] x", "[1][2]", "[1],[2]", "[1]]", "1 x"]
    expected = ["ok", "ok", "not_array", "malformed", "not_array", "malformed", "ok"] + ["malformed"] * 5
    assert applied(spark, json_array_status, given) == expected


def test_records_keep_their_own_text(spark):
    first = '{"product_id":"P1","z":1,"a":[1,2],"name":"n","category":"c"}'
    df = spark.createDataFrame([(f"[{first},\n {first}]",)], "value string")
    got = snapshot_records(records_of_arrays(df))
    assert [tuple(r) for r in got.collect()] == [("P1", "n", "c", first)] * 2


def test_snapshot_has_the_four_bronze_columns(spark):
    df = spark.createDataFrame([(json.dumps(product(extra=1)),)], "raw_json string")
    assert snapshot_records(df).columns == ["product_id", "name", "category", "raw_json"]
    assert snapshot_records(df).select(F.get_json_object("raw_json", "$.extra")).first()[0] == "1"
