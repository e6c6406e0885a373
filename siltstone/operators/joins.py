"""Left joins that keep every left row once per match, on one shared key.

No broadcast hints: Catalyst broadcasts a side whose size is under
autoBroadcastJoinThreshold, AQE one that turned out so. Beyond that the join
sorts and merges, and AQE splits the hot partitions of the left side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.columns import cast_leniently


def align_key(df: DataFrame, key: str) -> DataFrame:
    """Give `key` the type BIGINT; values that do not fit become null."""
    return cast_leniently(df, {key: "bigint"})


def suffixed(right: DataFrame, key: str, taken: list[str], suffix: str) -> DataFrame:
    """Rename the columns of `right` whose names are taken; the key stays."""
    clashes = {c: c + suffix for c in right.columns if c != key and c in taken}
    return right.withColumnsRenamed(clashes) if clashes else right


def with_own_shuffle(right: DataFrame, key: str) -> DataFrame:
    """Hide from the planner that `right` is already spread by `key`.

    AQE splits a hot key only where both sides of a join come straight from a
    shuffle. An aggregate or join on the same key would be used as it lies, and
    the other side's hot key would stay on one task. One more shuffle of the
    reduced side is the price; it is not paid when the side is broadcast.
    Null keys match nothing and are left out at the scan.
    """
    return right.filter(F.col(key).isNotNull()).withColumn(key, F.greatest(key, key))


def left_join(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    renamed = suffixed(right, key, left.columns, suffix)
    return left.join(with_own_shuffle(renamed, key), key, "left")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a non-null key repeats: a join on it would multiply rows."""
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    sample = repeated.limit(1).collect()
    if sample:
        raise ValueError(f"{key} is not unique: {sample[0][key]!r} occurs {sample[0]['count']} times")
