"""Bands, groups and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.constants import (
    AGE_BANDS,
    CANCELLED_STATUSES,
    OLDEST_BAND,
    OTHER_REGION,
    REGION_COUNTRIES,
)


def band(value: Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first upper bound above `value`; null falls to `rest`."""
    (first_bound, first_label), *others = bands
    chain = F.when(value < first_bound, first_label)
    for bound, label in others:
        chain = chain.when(value < bound, label)
    return chain.otherwise(rest)


def group_of(value: Column, members: Mapping[str, Sequence[str]], rest: str) -> Column:
    """Name of the group listing `value`; unlisted and null fall to `rest`."""
    hits = [F.when(value.isin(list(names)), group) for group, names in members.items()]
    return F.coalesce(*hits, F.lit(rest))


def age_group(age: Column) -> Column:
    return band(age, AGE_BANDS, OLDEST_BAND)


def region(country: Column) -> Column:
    return group_of(country, REGION_COUNTRIES, OTHER_REGION)


def is_cancelled(status: Column, statuses: Sequence[str] = tuple(CANCELLED_STATUSES)) -> Column:
    return status.isin(list(statuses))
