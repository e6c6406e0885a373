"""Casts that give null instead of failing.

A failing TRY cast raises and catches an exception per row, so a shape test
turns bad values away first. Spark ignores whitespace around a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import strip

_WHOLE = r"^\s*[+-]?0*[0-9]{1,19}\s*$"
# Plain decimal or exponent notation. Spark alone would also take `1d` and `NaN`.
_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_long(text: Column) -> Column:
    """Whole numbers only: `12.0` gives null."""
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def to_id(text: Column) -> Column:
    """Whole numbers in plain digits (`007` and ` 7` are `7`), other text stripped."""
    return F.coalesce(to_long(text).cast("string"), strip(text))


def to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))
