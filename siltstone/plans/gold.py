"""The unified report table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.constants import HIGH_VALUE_CUSTOMER, HIGH_VALUE_ORDER
from siltstone.operators.aggregates import amounts_by_key
from siltstone.operators.joins import align_key, left_join, suffixed


def flag_high_value(
    df: DataFrame,
    order_above: float = HIGH_VALUE_ORDER,
    customer_above: float = HIGH_VALUE_CUSTOMER,
) -> DataFrame:
    """Strictly-above flags, null where the figure is; each only if its input exists."""
    flags = {
        "is_high_value_order": ("order_amount", order_above),
        "is_high_value_customer": ("total_sales_amount", customer_above),
    }
    present = {
        flag: F.col(source) > F.lit(bound)
        for flag, (source, bound) in flags.items()
        if source in df.columns
    }
    return df.withColumns(present) if present else df


def build_report(
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    sales: DataFrame | None = None,
    decimals: int = 6,
    order_above: float = HIGH_VALUE_ORDER,
    customer_above: float = HIGH_VALUE_CUSTOMER,
) -> DataFrame:
    """Every order with its customer, product and the customer's sales figures.

    Sales are summed per customer before any join, so they cannot multiply
    orders, and are put beside the customers first: both are one row per
    customer. Orders then cross the network once by customer and once by product.
    Each of the two is a single join in its stage, the shape in which AQE can
    split a customer, product or null id that holds a large share of the orders.
    """
    orders = align_key(orders, "customer_id")
    customers = align_key(customers, "customer_id")
    with_product = "product_id" in orders.columns + customers.columns

    right = suffixed(customers, "customer_id", orders.columns, "_cust")
    columns = orders.columns + [c for c in right.columns if c != "customer_id"]
    catalogue = None
    if with_product and "product_id" in products.columns:
        catalogue = suffixed(products, "product_id", columns, "_prod")
        columns += [c for c in catalogue.columns if c != "product_id"]
    if sales is not None and "sales_amount" in sales.columns:
        figures = amounts_by_key(
            align_key(sales, "customer_id"), "customer_id", "sales_amount", decimals
        )
        figures = suffixed(figures, "customer_id", columns, "_sale")
        columns += [c for c in figures.columns if c != "customer_id"]
        right = right.join(figures, "customer_id", "full")

    report = left_join(orders, right, "customer_id", "_cust")
    if catalogue is not None:
        report = left_join(report, catalogue, "product_id", "_prod")
    return flag_high_value(report.select(*columns), order_above, customer_above)
