"""Bronze loads of a table fed by a full file and later delta files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siltstone.operators.merge import (
    DELTA_SEQ,
    Part,
    conform,
    delta_floors,
    fresh_rows,
    merge_fresh,
    number_deltas,
    past_mark,
)
from siltstone.sources.lake import BUCKETS, Commit, Lake


def full_load(
    lake: Lake, table: str, df: DataFrame, stamp: str, key: str | None = None, buckets: int = BUCKETS
) -> Commit:
    """Replace the table and start its watermark anew.

    With `key` it is kept in buckets of that key, and later loads write only the
    buckets they touch. Take as many that one is worked off by a task or two.
    """
    if stamp not in df.columns:
        raise ValueError(f"no column {stamp!r} to take the watermark from")
    if key is not None:
        return lake.publish_buckets("bronze", table, df, key, stamp, buckets)
    return lake.publish("bronze", table, df, stamp, carry_watermark=False)


def incremental_load(
    lake: Lake,
    table: str,
    deltas: DataFrame | Sequence[DataFrame],
    key: str,
    stamp: str,
    seq: str | None = DELTA_SEQ,
    writer: str | None = None,
    batch_id: int | None = None,
    in_parts: bool = False,
) -> Commit:
    """Apply deltas in order to the stored table.

    `deltas` is a list, or one frame that carries its delta number in `seq`. Rows past
    the mark are written to `staging` first, in the only scan of the raw files; marks,
    touched buckets and the merge are taken from there. Without such rows the table
    stays as it is; rows without a timestamp are turned away once there is a mark, and counted
    in the commit given back. A table in buckets of `key` has only the touched ones rewritten.

    With `in_parts`, numbers go on from load to load, and further rows of the last delta
    meet the mark that its first rows met; rows of an earlier one end the load.
    """
    last = lake.last_commit("bronze", table)
    if last is None:
        raise FileNotFoundError(f"no table bronze/{table} under {lake.root}: load it in full first")
    base = lake.read("bronze", table)
    if isinstance(deltas, DataFrame):
        stacked = conform(deltas, base, [seq])
    elif len(deltas) == 1:
        stacked, seq = conform(deltas[0], base), None
    else:
        stacked = number_deltas(base, deltas)
    mark = F.lit(last.watermark).cast("timestamp_ntz")
    part = Part(last.delta, last.floor) if in_parts and last.delta is not None else None
    seen = Observation(f"deltas_{table}")
    stacked = stacked.observe(seen, F.count_if(F.col(stamp).isNull()).alias("undated"))
    staged = lake.publish("staging", table, past_mark(stacked, stamp, mark, seq, part))
    undated = seen.get["undated"]
    if not staged.row_count:
        return last._replace(undated=undated)
    rows = lake.read("staging", table)
    fields = {"writer": writer, "batch_id": batch_id, "undated": undated}
    if in_parts:
        newest = delta_floors(rows, stamp, mark, seq, part).orderBy(F.desc(seq)).first()
        floor = newest["_floor"]
        fields |= {"delta": newest[seq], "floor": None if floor is None else str(floor)}
    fresh = fresh_rows(rows, stamp, mark, seq, part)
    if last.key != key:
        return lake.publish("bronze", table, merge_fresh(base, fresh, key, seq, stamp, part), stamp, **fields)
    touched = [r[0] for r in fresh.select(last.bucket(F.col(key))).distinct().collect()]  # of the table's buckets
    merged = merge_fresh(lake.read("bronze", table, touched), fresh, key, seq, stamp, part)
    return lake.rewrite_buckets("bronze", table, merged, touched, stamp, **fields)


def load_with_deltas(
    lake: Lake, table: str, base: DataFrame, deltas: Sequence[DataFrame], key: str, stamp: str
) -> Commit:
    """Full load, then all deltas."""
    commit = full_load(lake, table, base, stamp, key)
    return incremental_load(lake, table, deltas, key, stamp) if deltas else commit
