"""The streaming form gives what the batch form gives."""

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from siltstone.operators.merge import fold, fresh_rows, high_watermark
from siltstone.plans.bronze import full_load
from siltstone.sources.lake import Lake
from siltstone.streaming.deltas import stream_csv_deltas, stream_deltas

SCHEMA = "id bigint, note string, ts timestamp_ntz"


@pytest.fixture
def setup(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    base = frame(spark, (1, "base", "2024-01-01"), (2, "base", "2024-01-02"))
    full_load(lake, "t", base, "ts", "id", buckets=4)

    def land(number, delta):
        delta.withColumn("delta", F.lit(number)).repartition(3).write.mode("append").partitionBy(
            "delta"
        ).parquet(f"{tmp_path}/landing")

    def run(**options):
        reader = spark.readStream.schema(f"{SCHEMA}, delta int").options(**options)
        source = reader.parquet(f"{tmp_path}/landing")
        stream = stream_deltas(source, lake, "t", "id", "ts", "delta", f"{tmp_path}/checkpoint")
        stream.awaitTermination()
        assert stream.exception() is None

    return lake, base, land, run


def frame(spark, *records):
    return spark.createDataFrame([(i, n, at(t)) for i, n, t in records], SCHEMA)


def test_stream_equals_fold_and_reads_each_delta_once(spark, setup):
    lake, base, land, run = setup
    deltas = [
        frame(spark, (2, "one", "2024-01-03"), (3, "one", "2024-01-05"), (4, "one", "2024-01-04")),
        frame(spark, (3, "late", "2024-01-04"), (4, "two", "2024-01-06"), (5, None, "2024-01-07")),
        frame(spark, (1, "three", "2024-01-08"), (2, "late", "2024-01-07")),
    ]
    land(0, deltas[0])
    land(1, deltas[1])
    run()
    assert lake.last_commit("bronze", "t").version == 1
    land(2, deltas[2])
    run()
    last = lake.last_commit("bronze", "t")
    assert (last.version, last.watermark) == (2, "2024-01-08 00:00:00")
    expected = fold(base, deltas, "id", "ts", high_watermark(base, "ts").scalar())
    assert rows(lake.read("bronze", "t")) == rows(expected)
    run()
    assert lake.last_commit("bronze", "t") == last


def test_row_without_delta_number_is_an_error(spark):
    deltas = frame(spark, (1, "new", "2024-01-03")).withColumn("delta", F.lit(None).cast("int"))
    mark = F.lit("2024-01-02").cast("timestamp_ntz")
    with pytest.raises(Exception, match="without a delta number"):
        fresh_rows(deltas, "ts", mark, "delta").collect()


def test_delta_over_several_triggers_equals_fold(spark, setup):
    """One file for each trigger: parts of a delta meet the mark before it and do not replace each other."""
    lake, base, land, run = setup
    deltas = [
        frame(spark, (2, "a", "2024-01-09"), (2, "b", "2024-01-03"), (3, "c", "2024-01-05"), (6, "d", "2024-01-04")),
        frame(spark, (3, "late", "2024-01-08"), (4, "e", "2024-01-12"), (3, "f", "2024-01-10"), (3, "g", "2024-01-11")),
        frame(spark, (1, "h", "2024-01-13"), (2, "late", "2024-01-12")),
    ]
    for number, delta in enumerate(deltas):
        land(number, delta)
    run(maxFilesPerTrigger=1)
    assert lake.last_commit("bronze", "t").version > 3
    expected = fold(base, deltas, "id", "ts", high_watermark(base, "ts").scalar())
    assert rows(lake.read("bronze", "t")) == rows(expected)
    last = lake.last_commit("bronze", "t")
    assert (last.watermark, last.delta, last.floor) == ("2024-01-13 00:00:00", 2, "2024-01-12 00:00:00")
    assert last.row_count == expected.count()


def test_part_of_an_earlier_delta_is_an_error(spark, setup):
    lake, _, land, run = setup
    land(1, frame(spark, (2, "one", "2024-01-03")))
    run()
    land(0, frame(spark, (3, "zero", "2024-01-03")))
    with pytest.raises(Exception, match="came after rows of delta 1"):
        run()
    assert lake.last_commit("bronze", "t").version == 1


def test_stream_onto_a_table_never_loaded(spark, setup, tmp_path):
    _, _, land, _ = setup
    land(0, frame(spark, (1, "x", "2024-01-03")))
    source = spark.readStream.schema(f"{SCHEMA}, delta int").parquet(f"{tmp_path}/landing")
    stream = stream_deltas(source, Lake(spark, f"{tmp_path}/none"), "t", "id", "ts", "delta", f"{tmp_path}/other")
    with pytest.raises(Exception, match="load it in full first"):
        stream.awaitTermination()


def test_csv_stream_by_header(spark, tmp_path):
    """Files with unlike headers, one for each trigger."""
    lake = Lake(spark, f"{tmp_path}/lake")
    base = frame(spark, (1, "base", "2024-01-01"), (2, "base", "2024-01-02"))
    full_load(lake, "t", base, "ts", "id")
    landing = tmp_path / "landing"
    files = {
        (0, "a"): "id,note,ts\n2,one,2024-01-09\n",
        (0, "b"): "ts,more,id,note\n2024-01-03,x,3,\"two, with comma\"\n2024-01-01,x,1,stale\n",
        (1, "a"): "note,id,ts\nthree,3,2024-01-10\nlate,2,2024-01-08\n",
    }
    for (delta, name), text in files.items():
        folder = landing / f"delta={delta}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.csv").write_text(text)
        stream = stream_csv_deltas(
            spark, str(landing), lake, "t", "id", "ts", "delta", f"{tmp_path}/checkpoint", types={}, maxFilesPerTrigger=1
        )
        stream.awaitTermination()
    assert lake.last_commit("bronze", "t").version == 3
    assert rows(lake.read("bronze", "t")) == rows(
        frame(spark, (1, "base", "2024-01-01"), (2, "one", "2024-01-09"), (3, "three", "2024-01-10"))
    )
