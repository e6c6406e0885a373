"""Joins and the report table."""

import pytest
from pyspark.sql import functions as F

from helpers import final_plan_of, plan_of, rows
from siltstone.operators.aggregates import amounts_by_key
from siltstone.operators.joins import align_key, left_join, require_unique
from siltstone.plans import gold, silver


@pytest.fixture
def tables(spark):
    orders = spark.createDataFrame(
        [
            ("O1", 1, 2000.0, "P1"),
            ("O2", 1, 1500.0, "P2"),
            ("O3", 2, None, None),
            ("O4", 9, 10.0, "P9"),
            ("O5", None, 1600.0, "P1"),
            ("O6", 4, 1.0, "P1"),
        ],
        "order_id string, customer_id bigint, order_amount double, product_id string",
    )
    customers = spark.createDataFrame(
        [(1, "Ann"), (2, "Bo"), (3, "Cy"), (None, "No id")], "customer_id bigint, name string"
    )
    products = spark.createDataFrame(
        [("P1", "Phone"), ("P2", "Tab")], "product_id string, product_name string"
    )
    sales = spark.createDataFrame(
        [(1, 9000.0), (1, 1500.5), (1, None), (2, None), (4, 10000.0), (3, 5.0)],
        "customer_id bigint, sales_amount double",
    )
    return {"orders": orders, "customers": customers, "products": products, "sales": sales}


def test_report(tables):
    got = gold.build_report(**tables)
    assert got.columns == [
        "order_id",
        "customer_id",
        "order_amount",
        "product_id",
        "name",
        "product_name",
        "total_sales_amount",
        "avg_sales_amount",
        "sales_transaction_count",
        "is_high_value_order",
        "is_high_value_customer",
    ]
    assert rows(got) == [
        ("O1", 1, 2000.0, "P1", "Ann", "Phone", 10500.5, 5250.25, 2, True, True),
        ("O2", 1, 1500.0, "P2", "Ann", "Tab", 10500.5, 5250.25, 2, False, True),
        ("O3", 2, None, None, "Bo", None, None, None, 0, None, None),
        ("O4", 9, 10.0, "P9", None, None, None, None, None, False, None),
        ("O5", None, 1600.0, "P1", None, "Phone", None, None, None, True, None),
        ("O6", 4, 1.0, "P1", None, "Phone", 10000.0, 10000.0, 1, False, False),
    ]


def test_report_without_sales_or_product_ids(tables):
    orders = tables["orders"].drop("product_id")
    got = gold.build_report(tables["customers"], orders, tables["products"])
    assert got.columns == ["order_id", "customer_id", "order_amount", "name", "is_high_value_order"]
    assert got.count() == 6


def test_report_without_flag_inputs(tables):
    orders = tables["orders"].drop("order_amount")
    got = gold.build_report(tables["customers"], orders, tables["products"])
    assert "is_high_value_order" not in got.columns


def test_clashing_names_take_the_suffix_of_their_side(spark, tables):
    customers = tables["customers"].withColumn("product_id", F.lit("c"))
    products = tables["products"].withColumn("name", F.lit("p"))
    orders = tables["orders"].withColumn("total_sales_amount", F.lit(1.0))
    got = gold.build_report(customers, orders, products, tables["sales"])
    for name in ("product_id_cust", "name_prod", "total_sales_amount_sale"):
        assert name in got.columns
    assert got.columns.count("customer_id") == got.columns.count("product_id") == 1


def test_text_keys_are_aligned(spark, tables):
    texts = tables["orders"].withColumn("customer_id", F.lit("1"))
    assert align_key(texts, "customer_id").schema["customer_id"].dataType.simpleString() == "bigint"
    got = gold.build_report(tables["customers"], texts, tables["products"], tables["sales"])
    assert {r.name for r in got.collect()} == {"Ann"}
    assert align_key(texts, "absent") is texts


def test_left_join_keeps_rows_without_a_match(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "id int, v string")
    assert rows(left_join(left, right, "id", "_r")) == [
        (None, "c", None),
        (1, "a", "x"),
        (2, "b", None),
    ]


def test_repeated_product_is_rejected(spark):
    df = spark.createDataFrame([("P1",), ("P2",), ("P1",), (None,), (None,)], "product_id string")
    with pytest.raises(ValueError, match="'P1' occurs 2 times"):
        require_unique(df, "product_id")
    require_unique(df.distinct(), "product_id")


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.lit(0.1).alias("v"))
    assert rows(amounts_by_key(df, "k", "v", 2)) == [(1, 1000.0, 0.1, 10_000)]


@pytest.fixture
def skewed(spark):
    """A third of the orders belongs to one customer, a third has no customer id,
    and half of them are for one product."""
    i = F.col("id")
    orders = spark.range(0, 60_000, 1, 12).select(
        F.concat(F.lit("O"), i).alias("order_id"),
        F.when(i % 3 == 0, 7).when(i % 3 == 1, None).otherwise(i % 5000).alias("customer_id"),
        i.cast("double").alias("order_amount"),
        F.concat(F.lit("P"), F.when(i % 2 == 0, 1).otherwise(i % 500)).alias("product_id"),
        F.sha2(i.cast("string"), 256).alias("note"),
    )
    customers = spark.range(5000).select(
        i.alias("customer_id"), F.concat(F.lit("C"), i).alias("name")
    )
    products = spark.range(500).select(
        F.concat(F.lit("P"), i).alias("product_id"), i.alias("base_price")
    )
    sales = spark.range(0, 60_000, 1, 12).select(
        F.when(i % 3 == 0, 7).otherwise(i % 6000).alias("customer_id"),
        F.lit(1.0).alias("sales_amount"),
    )
    return {"orders": orders, "customers": customers, "products": products, "sales": sales}


def test_hot_customer_product_and_null_id_are_split(spark, settings, skewed):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    report = gold.build_report(**skewed)
    plan = final_plan_of(report).split("Initial Plan")[0]
    assert plan.count("skew=true") == 2
    assert report.count() == 60_000
    hot = report.filter("customer_id = 7").agg(F.count("*"), F.max("total_sales_amount")).first()
    assert hot[0] >= 20_000 and hot[1] >= 20_000


def test_left_join_splits_a_hot_key_beside_an_aggregate(spark, settings, skewed):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    figures = amounts_by_key(skewed["sales"], "customer_id", "sales_amount")
    joined = left_join(skewed["orders"], figures, "customer_id", "_sale")
    assert "skew=true" in final_plan_of(joined)
    assert joined.count() == 60_000


def test_orders_cross_the_network_once_per_key(spark, settings, skewed):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(gold.build_report(**skewed))
    # orders and products once each by product; orders, the customer side and its
    # two parts by customer, one of them the aggregate's own.
    assert plan.count("Exchange hashpartitioning") == 6
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_silver_tables_stay_in_the_jvm(spark):
    raw = spark.createDataFrame(
        [("1", "1.5", "2024-01-01", "web")],
        "customer_id string, sales_amount string, spend string, channel string",
    )
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEval", "MapInPandas"):
        assert node not in plan_of(silver.sales(raw))
