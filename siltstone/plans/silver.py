"""Silver tables.

Rows are reduced before columns are added: where the key of a deduplication is
raw, the parsing comes after it, so the shuffle carries raw columns of the rows
that stay. Output is sorted by key within each file, as the window leaves it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.constants import MAX_VALID_DATE, PRODUCT_SCHEMA
from siltstone.functions import buckets, dates, nested, text
from siltstone.operators.columns import (
    apply_where_present,
    cast_leniently,
    with_parsed_date,
    without_ingest_seq,
)
from siltstone.operators.dedup import keep_first, keep_latest


def customers(bronze: DataFrame) -> DataFrame:
    """Newest row per customer, tidy name and email, age group, domain, region."""
    newest = keep_latest(bronze, ["customer_id"], "last_updated")
    tidy = newest.withColumns(
        {"name": text.title_case(F.col("name")), "email": F.lower("email")}
    )
    derived = tidy.withColumns(
        {
            "age_group": buckets.age_group(F.col("age")),
            "email_domain": text.email_domain(F.col("email")),
            "region": buckets.region(F.col("country")),
        }
    )
    return without_ingest_seq(derived)


def products(bronze: DataFrame) -> DataFrame:
    """Flat columns of the records in `raw_json`."""
    parsed = bronze.select(F.from_json("raw_json", PRODUCT_SCHEMA).alias("_p"))
    return parsed.select(
        *[column.alias(name) for name, column in nested.product_columns(F.col("_p")).items()]
    )


def product_misfits(bronze: DataFrame) -> DataFrame:
    """(column, misfits): records of `raw_json` whose value there is no number, one row per column."""
    parsed = bronze.select(F.from_json("raw_json", PRODUCT_SCHEMA).alias("_p"))
    flags = nested.misfits(F.col("_p"))
    counts = parsed.select(*[flag.alias(name) for name, flag in flags.items()]).agg(
        *[F.count_if(F.col(name)).alias(name) for name in flags]
    )
    return counts.unpivot([], list(flags), "column", "misfits")


def orders(bronze: DataFrame) -> DataFrame:
    """First row per order; typed ids and amounts, parsed date, cancel flag."""
    first = keep_first(bronze, ["order_id"])
    typed = cast_leniently(first, {"customer_id": "bigint", "order_amount": "double"})
    typed = apply_where_present(typed, {"order_status": text.clean_upper})
    if "order_date" in typed.columns:
        typed = with_parsed_date(
            typed, "order_date", "order_date_parsed", text.strip, dates.day_or_second
        )
        typed = typed.withColumns(dates.calendar_parts(F.col("order_date_parsed"), "order"))
    if "order_status" in typed.columns:
        typed = typed.withColumn("is_cancelled", buckets.is_cancelled(F.col("order_status")))
    return without_ingest_seq(typed)


def accounts(bronze: DataFrame) -> DataFrame:
    """First account per customer; rows without a usable customer id dropped."""
    typed = cast_leniently(bronze, {"customer_id": "bigint"})
    first = keep_first(typed.filter(F.col("customer_id").isNotNull()), ["customer_id"])
    clean = apply_where_present(first, {"account_type": text.strip, "country": text.clean_upper})
    return without_ingest_seq(apply_where_present(clean, {"account_type": text.title_case}))


def sales(bronze: DataFrame, max_valid_date: date = MAX_VALID_DATE) -> DataFrame:
    """Sales without repeats, dates parsed from four spellings and flagged.

    Repeats are rows equal in customer, amount and parsed date, so those are
    worked out first. Future dates are flagged, not dropped.
    """
    typed = cast_leniently(bronze, {"customer_id": "bigint", "sales_amount": "double"})
    typed = typed.filter(F.col("customer_id").isNotNull())
    keys = ["customer_id", "sales_amount"]
    dated = "spend" in typed.columns
    if dated:
        typed = with_parsed_date(
            typed, "spend", "spend_date_parsed", dates.unquoted, dates.spend_timestamp
        )
        keys.append("spend_date_parsed")
    first = apply_where_present(keep_first(typed, keys), {"channel": text.strip})
    result = apply_where_present(first, {"channel": text.title_case})
    if dated:
        parsed = F.col("spend_date_parsed")
        result = result.withColumns(
            {
                "is_future_date": dates.is_after(parsed, max_valid_date),
                **dates.calendar_parts(parsed, "spend"),
                "has_valid_date": parsed.isNotNull(),
            }
        )
    result = result.withColumn("has_valid_amount", F.col("sales_amount").isNotNull())
    return without_ingest_seq(result)
