"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.constants import WHITESPACE

# Whitespace that initcap does not treat as a word break.
_BREAKS_BESIDE_SPACE = WHITESPACE.replace(" ", "")


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def title_case(text: Column) -> Column:
    """First letter after each whitespace upper, the rest lower.

    initcap breaks words on the space alone, so the rare value with another
    break is cut into runs first. `text` is used three times: pass a column, not
    an expression, so that it is worked out once.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(?U)\S+|\s+"), F.lit(0))
    return F.when(
        F.translate(text, _BREAKS_BESIDE_SPACE, " " * len(_BREAKS_BESIDE_SPACE)) == text,
        F.initcap(text),
    ).otherwise(F.array_join(F.transform(runs, F.initcap), ""))


def clean_upper(text: Column) -> Column:
    return F.upper(strip(text))


def email_domain(email: Column) -> Column:
    """Part between the first and second `@`; null when there is no `@`."""
    return F.get(F.split(email, "@"), 1)


def header_name(name: str) -> str:
    """`" Order ID "` becomes `order_id`."""
    return name.strip().lower().replace(" ", "_")
