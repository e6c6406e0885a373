"""Grouped and global aggregates. Each one combines on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Amounts from here on are summed as doubles: 10**8 of those below fit the exact sum.
INEXACT_FROM = 1e24


def amounts_by_key(df: DataFrame, key: str, amount: str, decimals: int = 6) -> DataFrame:
    """Total, mean and number of amounts per key.

    Amounts are summed exactly, to `decimals` places, so the total does not depend on the
    order of addition, which Spark does not fix. Amounts of INEXACT_FROM or more, and
    those that are no finite number, are summed as they are.
    """
    value = F.col(amount)
    large = F.coalesce(~(F.abs(value) < INEXACT_FROM), F.lit(False)) | F.isnan(value.cast("double"))
    exact = F.sum(F.when(~large, value).try_cast(f"decimal(38,{decimals})")).cast("double")
    rest = F.sum(F.when(large, value)).cast("double")
    total = F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)
    return df.groupBy(key).agg(
        total.alias("total_sales_amount"),
        (total / F.nullif(F.count(value), F.lit(0))).alias("avg_sales_amount"),
        F.count(value).alias("sales_transaction_count"),
    )


def count_where_true(df: DataFrame, flag: str, name: str) -> DataFrame:
    return df.agg(F.count_if(F.col(flag)).alias(name))


def distinct_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of different keys, null counted as a value."""
    return df.select(*keys).distinct().agg(F.count("*").alias(name))


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def most_repeated(df: DataFrame, keys: Sequence[str], k: int = 10, name: str = "cnt") -> DataFrame:
    """The k most frequent keys; ties go to the smaller key."""
    return repeated_keys(df, keys, name).orderBy(F.desc(name), *keys).limit(k)


def case_styles(df: DataFrame, column: str) -> DataFrame:
    """One row: values all in upper case, all in lower case, and neither.

    A value without letters is both, so it counts twice and `mixed` may be low.
    """
    text = F.col(column)
    upper = F.count_if(text == F.upper(text))
    lower = F.count_if(text == F.lower(text))
    return df.agg(
        upper.alias("all_upper"),
        lower.alias("all_lower"),
        (F.count("*") - upper - lower).alias("mixed"),
    )
