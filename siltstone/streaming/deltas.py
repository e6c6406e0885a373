"""Delta files applied to a stored table as they arrive.

The stream's checkpoint remembers which files were read; the table's commit log
remembers the watermark and the last batch. A batch replayed after a failure is
recognised by its number and skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.plans.bronze import incremental_load
from siltstone.sources.files import CUSTOMER_TYPES, read_csv
from siltstone.sources.lake import Lake


_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_deltas(
    source: DataFrame, lake: Lake, table: str, key: str, stamp: str, seq: str, checkpoint: str
) -> StreamingQuery:
    """Start a run over everything that has landed and then stop.

    `source` is a file stream over `<seq>=<n>/` folders, one per delta. A delta may come
    over any number of triggers: the commit record keeps the mark before it, which all its
    rows meet. Rows of a delta that come after a later one was applied end the stream, as
    the later one was held against too low a mark.
    """
    return _started(source, lambda batch: batch, lake, table, key, stamp, seq, checkpoint)


def stream_csv_deltas(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    table: str,
    key: str,
    stamp: str,
    seq: str,
    checkpoint: str,
    types: Mapping[str, Callable[[Column], Column]] = CUSTOMER_TYPES,
    **options: str | int,
) -> StreamingQuery:
    """As `stream_deltas`, over CSV files with headers in `<landing>/<seq>=<n>/`.

    The stream itself carries file names only; each trigger's files are read by their
    own headers, so columns may stand in any order, and numbered in reading order within
    their delta. `options` go to the file stream, such as maxFilesPerTrigger.
    """
    reader = spark.readStream.format("binaryFile").schema(f"{_FILES}, {seq} INT")
    source = reader.options(pathGlobFilter="*.csv", **options).load(landing).select("path", seq)

    def rows(batch: DataFrame) -> DataFrame:
        deltas: dict[int, list[str]] = {}
        for path, number in batch.collect():  # names of one trigger's files
            deltas.setdefault(number, []).append(path)
        frames = [
            read_csv(spark, paths, types, ordinal=number).withColumn(seq, F.lit(number))
            for number, paths in sorted(deltas.items())
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    return _started(source, rows, lake, table, key, stamp, seq, checkpoint)


def _started(
    source: DataFrame,
    rows: Callable[[DataFrame], DataFrame],
    lake: Lake,
    table: str,
    key: str,
    stamp: str,
    seq: str,
    checkpoint: str,
) -> StreamingQuery:
    writer = f"{checkpoint}#{table}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        last = lake.last_commit("bronze", table)
        if last and last.writer == writer and last.batch_id is not None and last.batch_id >= batch_id:
            return
        incremental_load(lake, table, rows(batch), key, stamp, seq, writer, batch_id, in_parts=True)

    return (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
