"""Incremental loading: conform, high-water mark, keyed upsert, fold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.joins import with_own_shuffle

DELTA_SEQ = "_delta_seq"


def conform(delta: DataFrame, base: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Columns of `base` in its order: absent ones null, unknown ones dropped."""
    columns = []
    for field in base.schema:
        name = f"`{field.name}`"
        if field.name not in delta.columns:
            column = F.lit(None).cast(field.dataType)
        elif delta.schema[field.name].dataType == field.dataType:
            column = F.col(name)
        else:
            column = F.col(name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return delta.select(*columns, *extra)


def high_watermark(df: DataFrame, stamp: str, name: str = "high_watermark") -> DataFrame:
    """One row: the greatest timestamp, null if there is none."""
    if stamp not in df.columns:
        raise ValueError(f"no column {stamp!r} to take the watermark from")
    return df.agg(F.max(stamp).alias(name))


def newer_than(df: DataFrame, stamp: str, mark: Column) -> DataFrame:
    """Rows strictly past the mark; all rows while there is no mark."""
    return df.filter(mark.isNull() | (F.col(stamp) > mark))


def upsert(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Drop the base rows whose key is in the delta, then add every delta row.

    Keys are made distinct before the join, so a key repeated through the delta
    is sent once per task. A null key matches nothing.
    """
    delta = conform(delta, base)
    keys = with_own_shuffle(delta.select(key).distinct(), key)
    return base.join(keys, key, "left_anti").unionByName(delta)


def number_deltas(base: DataFrame, deltas: Sequence[DataFrame]) -> DataFrame:
    """Stack deltas, conformed to the base, with their position as DELTA_SEQ."""
    numbered = [
        conform(delta, base).withColumn(DELTA_SEQ, F.lit(place))
        for place, delta in enumerate(deltas)
    ]
    return reduce(lambda a, b: a.unionByName(b), numbered)


class Part(NamedTuple):
    """A delta of which rows have been applied already, and the mark before it."""

    number: int
    floor: str | None

    def mark(self) -> Column:
        return F.lit(self.floor).cast("timestamp_ntz")


def past_mark(deltas: DataFrame, stamp: str, mark: Column, seq: str | None, part: Part | None = None) -> DataFrame:
    """Rows that may be fresh: past the mark, or past the one before `part` if they belong to it.

    A row past the mark without a number, or of a delta before `part`, ends the job:
    its place among the deltas is not known, or taken.
    """
    if seq is None:
        return newer_than(deltas, stamp, mark)
    number = F.col(seq)
    if part is not None:
        late = F.concat(F.lit("rows of delta "), number, F.lit(f" came after rows of delta {part.number}"))
        mark = (
            F.when(number < part.number, F.raise_error(late).cast("timestamp_ntz"))
            .when(number == part.number, part.mark())
            .otherwise(mark)
        )
    unnumbered = F.raise_error(F.lit("delta row without a delta number")).cast(deltas.schema[seq].dataType)
    return newer_than(deltas, stamp, mark).withColumn(seq, F.coalesce(number, unnumbered))


def delta_floors(deltas: DataFrame, stamp: str, mark: Column, seq: str, part: Part | None = None) -> DataFrame:
    """(seq, _floor): the mark in force when each delta is applied.

    Applied one by one, a delta only adds rows past the mark, so the mark after it is
    the greatest timestamp seen so far, and the mark before each a running maximum.
    Rows of `part` keep the mark that its first rows met. One row per delta.
    """
    tops = deltas.groupBy(seq).agg(F.max(stamp).alias("_top"))
    earlier = Window.orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    floor = F.greatest(F.max("_top").over(earlier), mark)
    if part is not None:
        floor = F.when(F.col(seq) == part.number, part.mark()).otherwise(floor)
    return tops.select(seq, floor.alias("_floor"))


def fresh_rows(deltas: DataFrame, stamp: str, mark: Column, seq: str | None, part: Part | None = None) -> DataFrame:
    """Rows of each delta past the mark in force when it is applied: the whole sequence is one filter.

    The window and the broadcast hold one row per delta, whatever the deltas' sizes. No
    mark is below the first, so that one filters at the scan. Without `seq` the frame is
    a single delta. `deltas` is read twice; give a table rather than raw files.
    """
    deltas = past_mark(deltas, stamp, mark, seq, part)
    if seq is None:
        return deltas
    floors = delta_floors(deltas, stamp, mark, seq, part)
    return newer_than(deltas.join(F.broadcast(floors), seq), stamp, F.col("_floor")).drop("_floor")


def merge_fresh(
    base: DataFrame, fresh: DataFrame, key: str, seq: str | None, stamp: str | None = None, part: Part | None = None
) -> DataFrame:
    """Put fresh rows over the base: a row stays unless a later delta has its key.

    Base rows go through one anti join however many deltas there are. With `part`, base
    rows past the mark before it are rows of the same delta, which do not replace each other.
    """
    if seq is None:
        return upsert(base, fresh, key)
    last = (
        fresh.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(seq).alias("_last"))
    )
    last = with_own_shuffle(last, "_key")
    columns = base.columns
    same_key = F.col(key) == F.col("_key")
    replaced = same_key & F.col("_last").isNotNull()
    if part is not None:
        of_part = F.col(stamp).isNotNull() & (part.mark().isNull() | (F.col(stamp) > part.mark()))
        replaced &= ~((F.col("_last") == part.number) & of_part)
    kept = base.join(last, replaced, "left_anti")
    # A left join, as Catalyst would push an anti join into every stacked delta.
    newest = fresh.join(last, same_key, "left").filter(
        F.col("_last").isNull() | (F.col(seq) == F.col("_last"))
    )
    return kept.unionByName(newest.select(*columns))


def fold(
    base: DataFrame, deltas: Sequence[DataFrame], key: str, stamp: str, mark: Column
) -> DataFrame:
    """Apply deltas in order, in one pass. Equals repeated filter and upsert."""
    if len(deltas) == 1:
        stacked, seq = conform(deltas[0], base), None
    else:
        stacked, seq = number_deltas(base, deltas), DELTA_SEQ
    return merge_fresh(base, fresh_rows(stacked, stamp, mark, seq), key, seq)
