"""Date parsing. Results are TIMESTAMP_NTZ, so no session time zone is involved.

Each format is tried behind a cheap shape test: values of another shape never
reach the parser, and the casts used are the JVM's fast paths. The text is used
several times, so pass a column that is already stripped, not an expression.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.constants import MAX_VALID_DATE
from siltstone.functions.text import strip

_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"


def _when_shaped(text: Column, shape: str, value: Column) -> Column:
    return F.when(text.rlike(f"^{shape}$"), value)


def iso_timestamp(text: Column) -> Column:
    """`2024-01-05T10:00:00Z`; anything else is null."""
    bare = F.replace(text, F.lit("Z"), F.lit(""))
    return _when_shaped(text, f"{_DAY}T{_CLOCK}Z", bare.try_cast("timestamp_ntz"))


def day_or_second(text: Column) -> Column:
    """`2024-01-05` or `2024-01-05 10:00:00`."""
    return _when_shaped(text, f"{_DAY}( {_CLOCK})?", text.try_cast("timestamp_ntz"))


def csv_timestamp(text: Column) -> Column:
    """Any of the timestamp spellings a CSV file may carry."""
    plain = _when_shaped(
        text, rf"{_DAY}([ T]{_CLOCK}([.]\d{{1,6}})?)?", text.try_cast("timestamp_ntz")
    )
    return F.coalesce(iso_timestamp(text), plain)


def us_date(text: Column) -> Column:
    """`01/05/2024`, month first."""
    day = F.try_to_date(text, "M/d/yyyy")
    return _when_shaped(text, r"\d{1,2}/\d{1,2}/\d{4}", day.cast("timestamp_ntz"))


def long_date(text: Column) -> Column:
    """`November 10, 2026`: full month names in any case, commas optional."""
    bare = F.replace(text, F.lit(","), F.lit(""))
    day = F.try_to_date(F.regexp_replace(strip(bare), r"(?U)\s+", " "), "MMMM d yyyy")
    shape = r"(?U)\s*[A-Za-z]+\s+\d{1,2}\s+\d{4}\s*"
    return F.when(bare.rlike(f"^{shape}$"), day.cast("timestamp_ntz"))


def unquoted(text: Column) -> Column:
    return F.replace(strip(text), F.lit('"'), F.lit(""))


def spend_timestamp(clean: Column) -> Column:
    """First of the four accepted spellings that fits."""
    return F.coalesce(day_or_second(clean), us_date(clean), long_date(clean))


def calendar_parts(stamp: Column, prefix: str) -> dict[str, Column]:
    """`<prefix>_year`, `<prefix>_month` and `<prefix>_quarter` (`Q1`..`Q4`)."""
    return {
        f"{prefix}_year": F.year(stamp),
        f"{prefix}_month": F.month(stamp),
        f"{prefix}_quarter": F.concat(F.lit("Q"), F.quarter(stamp).cast("string")),
    }


def is_after(stamp: Column, last: date = MAX_VALID_DATE) -> Column:
    """Past midnight at the start of `last`; null for an undated row."""
    return stamp > F.lit(last).cast("timestamp_ntz")
