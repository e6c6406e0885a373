"""Keeping one row per key.

All forms are `row_number() == 1`. Spark plans that with a group limit on both
sides of the shuffle, so each task sends at most one row per key: a key that
holds a third of the table costs its reducer one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.constants import INGEST_SEQ

_UNSORTABLE = (T.MapType, T.VariantType)


def reading_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Ingest position if the frame carries one, else all other columns.

    The second form has no notion of first, but makes the choice repeatable.
    """
    if INGEST_SEQ in df.columns:
        return [F.col(INGEST_SEQ)]
    return [
        F.col(f"`{field.name}`")
        for field in df.schema
        if field.name not in keys and not isinstance(field.dataType, _UNSORTABLE)
    ]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row per key; null keys form one group."""
    order = [*order, *reading_order(df, keys)] or [F.lit(0)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def keep_latest(df: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Newest row per key. Undated rows lose; ties go to the row read first."""
    return keep_first(df, keys, [F.desc_nulls_last(stamp)])


def rows_beyond_first(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row: how many rows keeping one per key would remove."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))
