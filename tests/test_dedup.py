"""One row per key."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from siltstone.constants import INGEST_SEQ
from siltstone.operators.dedup import keep_first, keep_latest, rows_beyond_first


@pytest.fixture
def stamped(spark):
    return spark.createDataFrame(
        [
            (1, "2024-01-01", "old", 0),
            (1, "2024-01-02", "new", 1),
            (2, "2024-01-01", "tie first", 2),
            (2, "2024-01-01", "tie second", 3),
            (3, None, "undated", 4),
            (3, "2020-01-01", "dated", 5),
            (None, "2024-01-01", "null key a", 6),
            (None, "2024-01-03", "null key b", 7),
        ],
        f"id int, ts string, note string, {INGEST_SEQ} int",
    )


def test_latest_prefers_dated_then_newest_then_first_read(stamped):
    got = keep_latest(stamped, ["id"], "ts").select("id", "note")
    assert rows(got) == [(None, "null key b"), (1, "new"), (2, "tie first"), (3, "dated")]


def test_first_follows_the_ingest_sequence(stamped):
    assert rows(keep_first(stamped, ["id"]).select("id", "note")) == [
        (None, "null key a"),
        (1, "old"),
        (2, "tie first"),
        (3, "undated"),
    ]


def test_composite_key_groups_nulls(spark):
    df = spark.createDataFrame(
        [(1, 5.0, None, "b"), (1, 5.0, None, "a"), (1, None, None, "c"), (1, None, None, "c")],
        "id int, amount double, day string, note string",
    )
    got = keep_first(df, ["id", "amount", "day"]).select("amount", "note")
    assert rows(got) == [(None, "c"), (5.0, "a")]


def test_result_does_not_depend_on_partitioning(stamped):
    plain = stamped.drop(INGEST_SEQ)
    got = [rows(keep_first(plain.repartition(n), ["id"])) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2]


def test_removed_rows_count_null_as_a_key(stamped):
    assert rows(rows_beyond_first(stamped, ["id"], "removed")) == [(4,)]
    assert rows(rows_beyond_first(stamped.limit(0), ["id"], "removed")) == [(0,)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    """Each task sends one row per key however many it holds."""
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    first = keep_first(df, ["k"], [F.col("v")])
    assert plan_of(first).count("WindowGroupLimit") == 2
    assert first.count() == df.select("k").distinct().count()
    assert first.filter("k = 0").first()["v"] == 0
