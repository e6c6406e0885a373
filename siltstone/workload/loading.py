"""Incremental loading, set operations, deduplication and key reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from siltstone.operators import aggregates, dedup, merge
from siltstone.plans import bronze
from siltstone.plans.bronze import full_load
from siltstone.session import shared_folder
from siltstone.sources.files import read_csv
from siltstone.sources.lake import Lake
from siltstone.streaming.deltas import stream_csv_deltas
from siltstone.workload import dialect as D
from siltstone.workload.registry import query, table

BASE_END = datetime(2024, 1, 15)
FOLD_START = datetime(2024, 1, 8)
# Slices that reach back before the previous one ended, so each holds late rows
# that the watermark must turn away. With the base they cover every event.
SLICES = [
    (datetime(2024, 1, 5), datetime(2024, 1, 13)),
    (datetime(2024, 1, 10), datetime(2024, 1, 19)),
    (datetime(2024, 1, 16), datetime(2024, 1, 25)),
    (datetime(2024, 1, 22), datetime(2024, 2, 1)),
]
LINE = ["l_orderkey", "l_linenumber"]

# A user's hour of the day is the merge key: later slices hold most slots again,
# but not all, so rows of every age are left at the end.
_EVENTS = "select *, cast(user_id * 24 + hour(ts) as bigint) as slot from events"
_BASE = f"select * from ({_EVENTS}) where ts < timestamp '{BASE_END}'"


def _events(spark, sf_dir):
    slot = F.col("user_id") * 24 + F.hour("ts")
    return table(spark, sf_dir, "events").withColumn("slot", slot)


def _between(events, start, end):
    ts = F.col("ts")
    return events.filter(
        (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
    )


def _before(events, end):
    return events.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))


def _split(spark, sf_dir):
    """Events before the cut, all events, and the watermark the former leave."""
    events = _events(spark, sf_dir)
    base = _before(events, BASE_END)
    return base, events, merge.high_watermark(base, "ts").scalar()


@query(D.with_tables("select max(ts) as high_watermark from b", b=_BASE))
def watermark_max(spark, sf_dir):
    return merge.high_watermark(_before(table(spark, sf_dir, "events"), BASE_END), "ts")


@query(
    D.with_tables("select * from e where ts > (select max(ts) from b)", e=_EVENTS, b=_BASE)
)
def watermark_filter(spark, sf_dir):
    _, events, mark = _split(spark, sf_dir)
    return merge.newer_than(events, "ts", mark)


@query("select event_id, ts, user_id, event_type, value, cast(null as varchar) as props from events")
def schema_conform(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    delta = events.select(
        "value", "user_id", F.upper("event_type").alias("shout"), "ts", "event_id", "event_type"
    )
    return merge.conform(delta, events)


_UPSERTED = """select * from b where slot not in (select slot from d)
    union all select * from d"""


@query(
    D.with_tables(
        _UPSERTED,
        b=_BASE,
        d=f"select * from ({_EVENTS}) where ts > (select max(ts) from b)",
    )
)
def keyed_upsert(spark, sf_dir):
    base, events, mark = _split(spark, sf_dir)
    return merge.upsert(base, merge.newer_than(events, "ts", mark), "slot")


@query(
    D.with_tables(
        _UPSERTED,
        b=_BASE,
        d=f"""select * replace (cast(null as varchar) as props) from ({_EVENTS})
            where ts > (select max(ts) from b)""",
    )
)
def incremental_load(spark, sf_dir):
    events = _events(spark, sf_dir)
    lake = Lake(spark, shared_folder(spark, "incremental_load"))
    full_load(lake, "events", _before(events, BASE_END), "ts", "slot")
    bronze.incremental_load(lake, "events", [events.drop("props")], "slot", "ts")
    return lake.read("bronze", "events")


def _fold_sql() -> str:
    """One delta after the other, each against the result of the last."""
    tables = {"e": _EVENTS, "m0": f"select * from e where ts < timestamp '{FOLD_START}'"}
    for i, (start, end) in enumerate(SLICES, 1):
        tables[f"d{i}"] = (
            f"select * from e where ts >= timestamp '{start}' and ts < timestamp '{end}'"
            f" and ts > (select max(ts) from m{i - 1})"
        )
        tables[f"m{i}"] = (
            f"select * from m{i - 1} where slot not in (select slot from d{i})"
            f" union all select * from d{i}"
        )
    return D.with_tables(f"select * from m{len(SLICES)}", **tables)


def _slices(events):
    return [_between(events, start, end) for start, end in SLICES]


@query(_fold_sql())
def incremental_fold(spark, sf_dir):
    events = _events(spark, sf_dir)
    lake = Lake(spark, shared_folder(spark, "incremental_fold"))
    full_load(lake, "events", _before(events, FOLD_START), "ts", "slot")
    bronze.incremental_load(lake, "events", _slices(events), "slot", "ts")
    return lake.read("bronze", "events")


@query(_fold_sql())
def stream_upsert(spark, sf_dir):
    events = _events(spark, sf_dir)
    root = shared_folder(spark, "stream_upsert")
    lake = Lake(spark, f"{root}/lake")
    full_load(lake, "events", _before(events, FOLD_START), "ts", "slot")
    landed = merge.number_deltas(events, _slices(events)).withColumnRenamed(
        merge.DELTA_SEQ, "delta"
    )
    landed = landed.withColumn("ts", F.col("ts").cast("string"))
    landed.write.partitionBy("delta").options(header=True, escape='"').csv(f"{root}/landing")
    stream = stream_csv_deltas(
        spark, f"{root}/landing", lake, "events", "slot", "ts", "delta", f"{root}/checkpoint", types={}
    )
    stream.awaitTermination()
    return lake.read("bronze", "events")


@query(
    f"""select * from events where ts < timestamp '{BASE_END}'
    union all select * from events where ts >= timestamp '{FOLD_START}'"""
)
def union_all(spark, sf_dir):
    """Two overlapping folders of files under one glob, the second with its columns in another order."""
    events = table(spark, sf_dir, "events")
    later = events.filter(F.col("ts") >= F.lit(FOLD_START).cast("timestamp_ntz"))
    root = shared_folder(spark, "union_all")
    parts = {"first": _before(events, BASE_END), "second": later.select(*reversed(events.columns))}
    for name, part in parts.items():
        text = part.withColumn("ts", F.col("ts").cast("string"))
        text.write.options(header=True, escape='"').csv(f"{root}/{name}")
    return merge.conform(read_csv(spark, f"{root}/*/*.csv", types={}), events)


@query(
    """select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
    where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')"""
)
def anti_join(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    keys = urgent.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf_dir, "customer").join(keys, "c_custkey", "left_anti")


@query(D.first_per("events", "user_id", "ts desc nulls last, event_id"))
def dedup_latest(spark, sf_dir):
    return dedup.keep_latest(table(spark, sf_dir, "events"), ["user_id"], "ts")


@query("select count(*) - count(distinct user_id) as removed from events")
def dedup_removed(spark, sf_dir):
    return dedup.rows_beyond_first(table(spark, sf_dir, "events"), ["user_id"], "removed")


@query(
    D.first_per(
        "lineitem",
        "l_orderkey, l_linenumber",
        """l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate""",
    )
)
def dedup_first(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "lineitem"), LINE)


@query(
    D.first_per(
        """(select l_orderkey, l_quantity, l_partkey, l_suppkey,
            case when l_linenumber % 3 = 0 then null else l_shipdate end as day from lineitem)""",
        "l_orderkey, l_quantity, day",
        "l_partkey, l_suppkey",
    )
)
def dedup_composite(spark, sf_dir):
    day = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_shipdate"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_partkey", "l_suppkey", day.alias("day")
    )
    return dedup.keep_first(lines, ["l_orderkey", "l_quantity", "day"])


@query(
    """select count(*) as distinct_keys
    from (select distinct l_orderkey, l_linenumber from lineitem)"""
)
def distinct_keys(spark, sf_dir):
    return aggregates.distinct_count(table(spark, sf_dir, "lineitem"), LINE, "distinct_keys")


@query(
    """select l_orderkey, l_linenumber, count(*) as cnt from lineitem
    group by all having count(*) > 1"""
)
def duplicate_key_report(spark, sf_dir):
    return aggregates.repeated_keys(table(spark, sf_dir, "lineitem"), LINE)


@query(
    """select l_orderkey, l_linenumber, count(*) as cnt from lineitem
    group by all having count(*) > 1 order by cnt desc, l_orderkey, l_linenumber limit 10"""
)
def topk_duplicates(spark, sf_dir):
    return aggregates.most_repeated(table(spark, sf_dir, "lineitem"), LINE)
