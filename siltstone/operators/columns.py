"""Adding columns only where their inputs exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.constants import INGEST_SEQ
from siltstone.functions.casts import to_double, to_long
from siltstone.functions.text import header_name, strip


def apply_where_present(df: DataFrame, rules: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Rewrite each named column that the frame has; ignore the others."""
    present = {name: rule(F.col(name)) for name, rule in rules.items() if name in df.columns}
    return df.withColumns(present) if present else df


_FROM_TEXT = {"bigint": to_long, "double": to_double}


def cast_leniently(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Give the named columns, where present, the type `bigint` or `double`.

    Values that do not fit become null; a column of that type is left alone.
    """
    changed = {}
    for name, kind in kinds.items():
        if name not in df.columns:
            continue
        current = df.schema[name].dataType.simpleString()
        if current == "string":
            changed[name] = _FROM_TEXT[kind](F.col(name))
        elif current != kind:
            changed[name] = F.col(name).try_cast(kind)
    return df.withColumns(changed) if changed else df


def with_parsed_date(
    df: DataFrame,
    source: str,
    target: str,
    clean: Callable[[Column], Column],
    parse: Callable[[Column], Column],
) -> DataFrame:
    """Add `target` parsed from `source`, cleaning each text once for all formats."""
    cleaned = df.withColumn("_clean", clean(F.col(source)))
    return cleaned.withColumn(target, parse(F.col("_clean"))).drop("_clean")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(name) for name in df.columns])


def as_clean_strings(df: DataFrame) -> DataFrame:
    """Every column as a stripped string; null stays null."""
    return df.select(*[strip(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def with_ingest_seq(scan: DataFrame, ordinal: int) -> DataFrame:
    """Number the rows of a file scan in reading order.

    A task may read splits in any order, so the position is the file's place in
    the load, its name, the split's offset, and the row's place within the task.
    Store the result before using it: the number belongs to one scan.
    """
    position = F.struct(
        F.lit(ordinal).alias("load"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.select("*", position.alias(INGEST_SEQ))


def with_short_seq(stored: DataFrame) -> DataFrame:
    """The positions of `with_ingest_seq` as one number each, in the same order.

    A position holds its file's name, which a shuffle or sort would carry with every row.
    Here the splits of the load are numbered in order, and the number takes the name's
    place. `stored` is read once more for its splits, of which there are as many as tasks
    that read the files; so give a stored table. Other positions stay as they are.
    """
    if INGEST_SEQ not in stored.columns or not isinstance(stored.schema[INGEST_SEQ].dataType, StructType):
        return stored
    row = F.col(f"{INGEST_SEQ}.row")
    # monotonically_increasing_id: the task's number above 33 bits of the row's place within it
    parts = {f"_{name}": F.col(f"{INGEST_SEQ}.{name}") for name in ("load", "file", "block")}
    parts["_task"] = F.shiftright(row, 33)
    splits = stored.select(*[part.alias(name) for name, part in parts.items()]).distinct()
    ranked = splits.withColumn("_split", F.row_number().over(Window.orderBy(*parts)).cast("bigint"))
    same_split = [part == F.col(name) for name, part in parts.items()]
    short = F.shiftleft("_split", 33).bitwiseOR(row.bitwiseAND(F.lit(2**33 - 1)))
    numbered = stored.join(F.broadcast(ranked), same_split, "left")
    return numbered.withColumn(INGEST_SEQ, short).drop("_split", *parts)


def without_ingest_seq(df: DataFrame) -> DataFrame:
    return df.drop(INGEST_SEQ)
