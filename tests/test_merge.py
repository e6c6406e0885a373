"""Incremental loading."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, final_plan_of, plan_of, rows
from siltstone.operators.merge import (
    conform,
    fold,
    high_watermark,
    newer_than,
    upsert,
)

SCHEMA = "id int, note string, ts timestamp_ntz"


def frame(spark, *records):
    return spark.createDataFrame([(i, n, at(t)) for i, n, t in records], SCHEMA)


def mark(text):
    return F.lit(text).cast("timestamp_ntz")


def test_conform_adds_drops_reorders_and_casts(spark):
    base = frame(spark)
    delta = spark.createDataFrame([("x", "7", "2024")], "extra string, id string, note string")
    got = conform(delta, base)
    assert got.schema == base.schema
    assert rows(got) == [(7, "2024", None)]


def test_upsert(spark):
    base = frame(spark, (1, "base", None), (1, "base again", None), (2, "base", None), (None, "base", None))
    delta = frame(spark, (2, "delta", None), (2, "delta again", None), (3, "new", None), (None, "delta", None))
    assert rows(upsert(base, delta, "id").select("id", "note")) == [
        (None, "base"),
        (None, "delta"),
        (1, "base"),
        (1, "base again"),
        (2, "delta"),
        (2, "delta again"),
        (3, "new"),
    ]


def test_upsert_with_empty_and_narrow_deltas(spark):
    base = frame(spark, (1, "base", "2024-01-01"))
    assert rows(upsert(base, frame(spark), "id")) == rows(base)
    narrow = spark.createDataFrame([(1, "extra")], "id int, other string")
    assert rows(upsert(base, narrow, "id")) == [(1, None, None)]


def test_upsert_twice_is_the_same_as_once(spark):
    base = frame(spark, (1, "base", None), (2, "base", None))
    delta = frame(spark, (2, "delta", None), (3, "delta", None))
    once = upsert(base, delta, "id")
    assert rows(upsert(once, delta, "id")) == rows(once)


def test_watermark_is_strict_and_drops_undated_rows(spark):
    df = frame(spark, (1, "at", "2024-01-02"), (2, "past", "2024-01-03"), (3, "undated", None))
    assert rows(newer_than(df, "ts", mark("2024-01-02")).select("id")) == [(2,)]
    assert newer_than(df, "ts", mark(None)).count() == 3
    assert rows(high_watermark(df, "ts")) == [(at("2024-01-03"),)]
    with pytest.raises(ValueError, match="no column"):
        high_watermark(df, "missing")


def one_by_one(base, deltas):
    """The same fold in plain Python: filter by the mark, replace, append."""
    table, top = list(base), max((t for *_, t in base if t), default=None)
    for delta in deltas:
        new = [r for r in delta if top is None or (r[2] is not None and r[2] > top)]
        if new:
            keys = {r[0] for r in new if r[0] is not None}
            table = [r for r in table if r[0] is None or r[0] not in keys] + new
            top = max((t for *_, t in table if t), default=None)
    return table


@pytest.mark.parametrize("seed", range(6))
def test_fold_equals_applying_deltas_one_by_one(spark, seed):
    pick = random.Random(seed)

    def some(n, low, high):
        stamps = [f"2024-01-{d:02d}" for d in range(low, high)] + [None]
        return [
            (pick.choice([None, *range(6)]), f"{low}-{i}", pick.choice(stamps)) for i in range(n)
        ]

    base = [(k, n, None) for k, n, _ in some(5, 1, 2)] if seed == 0 else some(8, 1, 8)
    deltas = [some(pick.randint(0, 7), low, low + 8) for low in (5, 9, 3, 14)]
    given = frame(spark, *base)
    top = high_watermark(given, "ts").scalar()
    got = fold(given, [frame(spark, *d) for d in deltas], "id", "ts", top)
    assert rows(got) == rows(frame(spark, *one_by_one(base, deltas)))


@pytest.mark.parametrize("pieces", [1, 2])
def test_fold_splits_a_hot_key(spark, settings, pieces):
    """A third of the base shares a key; AQE splits that partition."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    stamp = F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))
    wide = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        stamp.alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    base = wide.filter("ts < timestamp_ntz'2024-01-01 12:00:00'")
    delta = wide.filter("k % 7 = 1 and k > 0")
    early = "ts < timestamp_ntz'2024-01-01 13:00:00'"
    deltas = [delta] if pieces == 1 else [delta.filter(early), delta.filter(f"not {early}")]
    got = fold(base, deltas, "k", "ts", mark("2024-01-01 11:00:00"))
    plan = final_plan_of(got)
    assert "skew=true" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    fresh = delta.filter("ts > timestamp_ntz'2024-01-01 11:00:00'")
    replaced = base.join(fresh.select("k").distinct(), "k", "left_anti")
    assert got.count() == replaced.count() + fresh.count()
    assert got.filter("k = -1").count() == base.filter("k = -1").count()


def test_known_watermark_reaches_the_scan(spark, tmp_path):
    base = frame(spark, (1, "a", "2024-01-01"))
    for name in ("one", "two"):
        base.write.parquet(f"{tmp_path}/{name}")
    deltas = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("one", "two")]
    for given in (deltas, deltas[:1]):
        plan = plan_of(fold(base, given, "id", "ts", mark("2024-01-02")))
        scans = plan.count("FileScan parquet")
        assert plan.count("GreaterThan(ts,2024-01-02T00:00)") == scans > 0
