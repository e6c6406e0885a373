"""File readers and the table store."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from siltstone.constants import INGEST_SEQ
from siltstone.operators.columns import with_ingest_seq, with_short_seq
from siltstone.operators.dedup import keep_first
from siltstone.operators.dedup import keep_first
from siltstone.plans.bronze import full_load, incremental_load
from siltstone.sources.files import (
    read_csv,
    read_products,
    read_sheet,
    read_sheets,
    validate_json_arrays,
)
from siltstone.sources.lake import Lake

SCHEMA = "customer_id bigint, name string, last_updated timestamp_ntz"


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_csv_is_read_by_header_name(spark, tmp_path):
    path = put(
        tmp_path,
        "c.csv",
        'last_updated,customer_id,name,extra\n2024-01-05T10:00:00Z,1,"Ann, ""A""",x\n'
        "2024-01-05 11:00:00,bad,,y\n",
    )
    got = read_csv(spark, path)
    assert got.columns == ["last_updated", "customer_id", "name", "extra", INGEST_SEQ]
    assert rows(got.drop(INGEST_SEQ)) == [
        (at("2024-01-05T10:00:00"), "1", 'Ann, "A"', "x"),
        (at("2024-01-05T11:00:00"), "bad", None, "y"),
    ]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing.csv"):
        read_csv(spark, str(tmp_path / "nothing.csv"))


def test_files_of_one_glob_are_stacked(spark, tmp_path):
    for i in (1, 2):
        put(tmp_path, f"customers_{i}.csv", f"customer_id,name\n{i},n{i}\n")
    got = read_csv(spark, str(tmp_path / "customers_*.csv"))
    assert rows(got.select("customer_id", "name")) == [("1", "n1"), ("2", "n2")]


def test_reading_order_survives_splitting(spark, tmp_path, settings):
    """First means first in the file, though the file is cut into many splits."""
    lines = "".join(f"{i % 100},{i:06d}\n" for i in range(20_000))
    path = put(tmp_path, "big.csv", "customer_id,name\n" + lines)
    settings(
        spark__sql__files__maxPartitionBytes="20KB", spark__sql__files__openCostInBytes="1KB"
    )
    scan = read_csv(spark, path)
    assert scan.rdd.getNumPartitions() > 5
    got = keep_first(scan, ["customer_id"]).select("customer_id", "name")
    assert rows(got) == [(str(i), f"{i:06d}") for i in sorted(range(100), key=str)]


def test_sheet_cells_are_stripped_strings(spark, tmp_path):
    put(tmp_path, "orders.csv", " Order ID ,Order Date,channel\n 7 ,2024-01-05,\n8,, web \n")
    got = read_sheet(spark, str(tmp_path / "orders.csv")).drop(INGEST_SEQ)
    assert got.columns == ["order_id", "order_date", "channel"]
    assert rows(got) == [("7", "2024-01-05", None), ("8", None, "web")]


def test_absent_and_empty_sheets_are_skipped(spark, tmp_path):
    put(tmp_path, "orders.csv", "order_id\n1\n")
    put(tmp_path, "accounts.csv", "customer_id\n")
    found = read_sheets(spark, str(tmp_path), ["orders", "accounts", "sales_history"])
    assert list(found) == ["orders"]


RECORDS = [
    {"product_id": "P1", "name": "Phone", "category": "phones", "specs": {"ram_gb": 8}},
    {"product_id": "P2", "name": "Tab", "category": "tabs"},
]


@pytest.mark.parametrize("lines", [False, True])
def test_products_as_array_or_lines(spark, tmp_path, lines):
    if lines:
        path = put(tmp_path, "p.jsonl", "".join(json.dumps(r) + "\n" for r in RECORDS) + "\n")
    else:
        path = put(tmp_path, "p.json", "\n" + json.dumps(RECORDS, indent=2))
    got = read_products(spark, path, lines)
    assert got.columns == ["product_id", "name", "category", "raw_json"]
    assert sorted(r.product_id for r in got.collect()) == ["P1", "P2"]
    texts = {r.product_id: json.loads(r.raw_json) for r in got.collect()}
    assert texts == {r["product_id"]: r for r in RECORDS}


HEAD = '{"product_id":"P","name":"n","category":"c"}'


@pytest.mark.parametrize(
    "text, status",
    [
        ('{"a": 1}', "not_array"),
        ("[{", "malformed"),
        (f"[{HEAD}] garbage", "malformed"),
        (f"[{HEAD}][{HEAD}]", "malformed"),
        (f"[{HEAD}],[{HEAD}]", "malformed"),
        (f"[{HEAD},1]", "no records"),
        (f"[{HEAD},null]", "no records"),
        ('[{"name":"n","category":"c"}]', "no records"),
    ],
)
def test_json_that_is_no_array_of_records_is_an_error(spark, tmp_path, text, status):
    with pytest.raises(ValueError, match=status):
        validate_json_arrays(spark, put(tmp_path, "p.json", text))


@pytest.mark.parametrize("line", ['{"product_id":"P","na', f"{HEAD} junk", f"[{HEAD}]", "1", '{"name":"n"}'])
def test_lines_that_are_no_records_are_an_error(spark, tmp_path, line):
    with pytest.raises(ValueError, match="no record"):
        read_products(spark, put(tmp_path, "p.jsonl", f"{HEAD}\n\n{line}\n"), lines=True)


def frame(spark, *records):
    return spark.createDataFrame([(i, n, at(t)) for i, n, t in records], SCHEMA)


def test_table_can_be_rewritten_from_itself(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert not lake.exists("bronze", "t")
    with pytest.raises(FileNotFoundError):
        lake.read("bronze", "t")
    lake.publish("bronze", "t", spark.range(3))
    for version in (1, 2, 3):
        moved = lake.read("bronze", "t").select((F.col("id") + 1).alias("id"))
        commit = lake.publish("bronze", "t", moved)
        assert (commit.version, commit.row_count) == (version, 3)
        assert rows(lake.read("bronze", "t")) == [(version + i,) for i in range(3)]
    assert len(list((tmp_path / "bronze" / "t").iterdir())) == 2


def test_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.publish("bronze", "t", spark.range(3))
    lake.publish("bronze", "t", spark.range(4))
    broken = lake.read("bronze", "t").select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        lake.publish("bronze", "t", broken)
    assert lake.read("bronze", "t").count() == 4
    assert lake.publish("bronze", "t", spark.range(5)).version == 2
    assert lake.read("bronze", "t").count() == 5


def test_incremental_loads_move_the_watermark(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    base = frame(spark, (1, "base", "2024-01-01"), (2, "base", "2024-01-02"))
    assert full_load(lake, "c", base, "last_updated").watermark == "2024-01-02 00:00:00"

    late = frame(spark, (1, "late", "2024-01-02"), (9, "undated", None))
    unchanged = incremental_load(lake, "c", [late], "customer_id", "last_updated")
    assert (unchanged.version, unchanged.undated) == (0, 1)

    first = frame(spark, (2, "first", "2024-01-03"), (3, "first", "2024-01-05"))
    second = frame(spark, (3, "late", "2024-01-04"), (4, "second", "2024-01-06"))
    commit = incremental_load(lake, "c", [first, second], "customer_id", "last_updated")
    assert (commit.version, commit.watermark) == (1, "2024-01-06 00:00:00")
    assert rows(lake.read("bronze", "c").select("customer_id", "name")) == [
        (1, "base"),
        (2, "first"),
        (3, "first"),
        (4, "second"),
    ]

    narrow = frame(spark, (1, "x", "2024-01-07")).drop("name")
    incremental_load(lake, "c", [narrow], "customer_id", "last_updated")
    assert lake.read("bronze", "c").filter("customer_id = 1").first()["name"] is None


def test_load_without_timestamps_keeps_the_watermark_unset(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert full_load(lake, "c", frame(spark, (1, "a", None)), "last_updated").watermark is None
    delta = frame(spark, (1, "b", None), (2, "c", None))
    incremental_load(lake, "c", [delta], "customer_id", "last_updated")
    assert rows(lake.read("bronze", "c").select("name")) == [("b",), ("c",)]
    with pytest.raises(ValueError, match="no column"):
        full_load(lake, "d", spark.range(1), "last_updated")


def test_full_load_starts_the_watermark_anew(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    full_load(lake, "c", frame(spark, (1, "a", "2024-01-05")), "last_updated")
    assert full_load(lake, "c", frame(spark, (1, "a", None)), "last_updated").watermark is None


def data_files(lake, table):
    return {r[0] for r in lake.read("bronze", table).select(F.input_file_name()).distinct().collect()}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    base = frame(spark, *((i, "base", "2024-01-01") for i in range(60)), (None, "none", "2024-01-01"))
    full_load(lake, "c", base, "last_updated", "customer_id", buckets=8)
    before = data_files(lake, "c")
    assert len(before) == 8
    commit = incremental_load(
        lake, "c", [frame(spark, (5, "new", "2024-01-02"), (5, "old", "2023-01-01"))], "customer_id", "last_updated"
    )
    assert (commit.row_count, commit.watermark) == (61, "2024-01-02 00:00:00")
    after = data_files(lake, "c")
    assert len(before - after) == 1
    assert len(after) == 8
    found = {(r.customer_id, r.name) for r in lake.read("bronze", "c").collect()}
    assert found == {(i, "base") for i in range(60) if i != 5} | {(None, "none"), (5, "new")}
    # a bucket's first slot is used again, and a full load starts a new generation
    incremental_load(lake, "c", [frame(spark, (5, "newer", "2024-01-03"), (99, "x", "2024-01-03"))], "customer_id", "last_updated")
    assert lake.read("bronze", "c").filter("customer_id = 5").collect()[0].name == "newer"
    assert lake.read("bronze", "c").count() == 62
    full_load(lake, "c", base.limit(3), "last_updated", "customer_id", buckets=2)
    assert lake.read("bronze", "c").count() == 3
    full_load(lake, "c", base.filter("false"), "last_updated", "customer_id")
    assert lake.read("bronze", "c").count() == 0
    assert lake.read("bronze", "c").columns == base.columns


def test_raw_deltas_are_scanned_once(spark, tmp_path):
    """The staged rows give marks, touched buckets and the merge."""
    lake = Lake(spark, f"{tmp_path}/lake")
    full_load(lake, "c", frame(spark, (1, "a", "2024-01-01")), "last_updated", "customer_id")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    deltas = [frame(spark, (i, "d", f"2024-01-0{i}")) for i in (2, 3)]
    deltas = [d.mapInArrow(seen, d.schema) for d in deltas]
    incremental_load(lake, "c", deltas, "customer_id", "last_updated")
    assert read.value == 2
    assert lake.read("bronze", "c").count() == 3


def test_glob_with_unlike_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customer_id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,customer_id,age\ny,2,30\n")
    (tmp_path / "c.csv").write_text("customer_id,name\n3,z\n")
    (tmp_path / "d.csv").write_text("")
    found = read_csv(spark, f"{tmp_path}/*.csv")
    assert {(r.customer_id, r.name, r.age) for r in found.collect()} == {("1", "x", None), ("2", "y", 30), ("3", "z", None)}
    assert found.select("ingest_seq").distinct().count() == 3


def test_short_positions_keep_the_reading_order(spark, settings, tmp_path):
    """Several loads, splits and files, two of them of one name; a row without a position comes first."""
    settings(spark__sql__files__maxPartitionBytes="400", spark__sql__files__openCostInBytes="1")
    for n, name in enumerate(("b/x", "a/x", "a/w")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.csv").write_text("k,v\n" + "".join(f"{i % 7},{n}-{i:04d}\n" for i in range(200)))
    loads = [spark.read.csv(f"{tmp_path}/{files}", header=True) for files in ("*/*.csv", "a/w.csv")]
    loads = [with_ingest_seq(load, place) for place, load in ((1, loads[0]), (0, loads[1]))]
    unplaced = loads[0].select(F.lit("8").alias("k"), F.lit("none").alias("v"), F.lit(None).cast(loads[0].schema["ingest_seq"].dataType).alias("ingest_seq")).limit(1)
    loads[0].unionByName(loads[1]).unionByName(unplaced).write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    short = with_short_seq(stored.withColumn("long", F.col("ingest_seq")))
    assert short.columns == [*stored.columns, "long"]
    assert short.schema["ingest_seq"].dataType.simpleString() == "bigint"
    in_order = [r.ingest_seq for r in short.orderBy("long").collect()]
    assert in_order[0] is None and None not in in_order[1:] and len(in_order) == 801
    assert in_order[1:] == sorted(set(in_order[1:]))
    assert short.filter("ingest_seq is not null").select(F.shiftright("ingest_seq", 33)).distinct().count() > 6
    for keys in (["k"], ["v"]):
        assert rows(keep_first(with_short_seq(stored), keys).select("k", "v")) == rows(keep_first(stored, keys).select("k", "v"))


def test_other_positions_are_left_alone(spark):
    numbered = spark.createDataFrame([(1, 5)], "k int, ingest_seq int")
    assert with_short_seq(numbered) is numbered
    plain = numbered.drop("ingest_seq")
    assert with_short_seq(plain) is plain
