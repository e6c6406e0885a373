"""Data-quality checks as rows of (table, check, column, value).

Null counts, empty rows and the row count come from one pass without a shuffle
of rows. Repeated keys are counted in a second pass that reads only the key
columns; folding both into one aggregate would shuffle every column's partial
count once per key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.dedup import rows_beyond_first


class Check(NamedTuple):
    """A table to profile: its required columns and the key that should be unique."""

    table: str
    df: DataFrame
    required: Sequence[str] = ()
    key: Sequence[str] = ()


def _metric(table: str, check: str, column: str | None, value: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).cast("string").alias("column_name"),
        value.cast("bigint").alias("value"),
    )


def _as_rows(one_row: DataFrame, metrics: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*metrics)).alias("_m")).select("_m.*")


def _pass(df: DataFrame, table: str, counts: dict[tuple[str, str | None], Column]) -> DataFrame:
    names = {label: f"_c{i}" for i, label in enumerate(counts)}
    totals = df.agg(*[value.alias(names[label]) for label, value in counts.items()])
    return _as_rows(
        totals, [_metric(table, *label, F.col(name)) for label, name in names.items()]
    )


def _row_count() -> dict[tuple[str, str | None], Column]:
    return {("row_count", None): F.count("*")}


def _required(df: DataFrame, required: Sequence[str]) -> dict[tuple[str, str | None], Column]:
    return {("missing_column", c): F.lit(int(c not in df.columns)) for c in required}


def _nulls(df: DataFrame) -> dict[tuple[str, str | None], Column]:
    return {("null_count", c): F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}


def _empty_rows(df: DataFrame) -> dict[tuple[str, str | None], Column]:
    all_null = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in df.columns])
    return {("empty_rows", None): F.count_if(all_null)}


def check_schema(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """Row count, and 1 or 0 per required column for missing or there."""
    return _pass(df, table, {**_row_count(), **_required(df, required)})


def check_nulls(df: DataFrame, table: str) -> DataFrame:
    return _pass(df, table, _nulls(df))


def check_empty_rows(df: DataFrame, table: str) -> DataFrame:
    return _pass(df, table, _empty_rows(df))


def check_duplicates(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key, null counted as a value."""
    extra = rows_beyond_first(df, key, "_extra")
    return _as_rows(extra, [_metric(table, "duplicate_rows", ",".join(key), F.col("_extra"))])


def counts_at_write(df: DataFrame) -> dict[tuple[str, str | None], Column]:
    """The counts of `profile` that can be taken while the table is written."""
    return {**_row_count(), **_nulls(df), **_empty_rows(df)}


def missing_columns(df: DataFrame, required: Sequence[str]) -> dict[tuple[str, str | None], int]:
    return {("missing_column", c): int(c not in df.columns) for c in required}


def profile(check: Check) -> DataFrame:
    """All checks on one table; the duplicate check only if a key is given."""
    df, table = check.df, check.table
    result = _pass(
        df, table, {**_row_count(), **_required(df, check.required), **_nulls(df), **_empty_rows(df)}
    )
    if check.key:
        result = result.unionByName(check_duplicates(df, table, check.key))
    return result


def profile_all(checks: Iterable[Check]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [profile(check) for check in checks])


def failures(metrics: DataFrame, fail_on: Sequence[str]) -> DataFrame:
    """Metrics of the named checks that are not zero."""
    return metrics.filter(F.col("check_name").isin(list(fail_on)) & (F.col("value") > 0))


def require_passed(metrics: DataFrame, fail_on: Sequence[str]) -> None:
    """Raise ValueError if one of the named checks found something."""
    bad = failures(metrics, fail_on).limit(1).collect() if fail_on else []
    if bad:
        raise ValueError(f"quality check failed: {bad[0].asDict()}")
