"""Readers for raw CSV, JSON and sheet files.

CSV columns are taken by header name as strings and cast afterwards, so a file
with its columns in another order, or with columns missing or added, still loads
right. That also saves the extra pass of type inference.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.constants import INGEST_SEQ
from siltstone.functions.casts import to_id, to_long
from siltstone.functions.dates import csv_timestamp
from siltstone.functions.nested import is_record, json_array_status, json_records
from siltstone.functions.text import header_name, strip
from siltstone.operators.columns import apply_where_present, with_ingest_seq

logger = logging.getLogger(__name__)

CUSTOMER_TYPES: dict[str, Callable[[Column], Column]] = {
    "customer_id": to_id,
    "age": to_long,
    "last_updated": csv_timestamp,
}


def _scan(path: str, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source not found: {path}") from error
        raise


def _csv(spark: SparkSession, path: str | list[str], multiline: bool) -> DataFrame:
    return _scan(
        str(path),
        lambda: spark.read.options(
            header=True, inferSchema=False, enforceSchema=False, escape='"', multiLine=multiline
        ).csv(path),
    )


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    first = spark.read.text(path).head(1)
    return tuple(next(csv.reader([first[0][0]]), ())) if first else ()


def _by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Files with the same header together; one small job for each file, some side by side."""
    with ThreadPoolExecutor(8) as pool:
        headers = list(pool.map(inheritable_thread_target(lambda path: _header(spark, path)), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers, strict=True):
        if header:
            groups.setdefault(header, []).append(path)
    return list(groups.values()) or [list(paths)]


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, Callable[[Column], Column]] = CUSTOMER_TYPES,
    ordinal: int = 0,
    multiline: bool = False,
) -> DataFrame:
    """CSV files (a file, folder, glob or list) with headers; rows numbered in reading order.

    Files with the same header are read together; others are put beside them by column
    name, and columns that a file lacks are null. Empty files are passed over.
    Set `multiline` only for files with line breaks inside quotes: such a file
    cannot be split between tasks.
    """
    shown = path if isinstance(path, str) else ", ".join(path)
    paths = [path] if isinstance(path, str) else list(path)
    files = sorted(_scan(shown, lambda: spark.read.text(paths)).inputFiles())
    groups = _by_header(spark, files) if len(files) > 1 else [paths]
    scans = [with_ingest_seq(_csv(spark, group, multiline), ordinal) for group in groups]
    scan = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)
    return apply_where_present(scan, dict(types))


def read_sheet(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One exported sheet: tidy column names, every cell a stripped string."""
    scan = _csv(spark, path, multiline)
    columns = [strip(F.col(f"`{c}`")).alias(header_name(c)) for c in scan.columns]
    return with_ingest_seq(scan, 0).select(*columns, INGEST_SEQ)


def read_sheets(
    spark: SparkSession, folder: str, sheets: Sequence[str], multiline: bool = False
) -> dict[str, DataFrame]:
    """Exported sheets `<folder>/<sheet>.csv` by name.

    A sheet that is not there is skipped with a warning, one without rows quietly.
    """
    tables = {}
    for sheet in sheets:
        try:
            table = read_sheet(spark, f"{folder}/{sheet}.csv", multiline)
        except FileNotFoundError:
            logger.warning("sheet %s not found in %s, skipping", sheet, folder)
            continue
        if not table.isEmpty():
            tables[sheet] = table
    return tables


def read_json_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: `path` and the whole `value`."""
    scan = _scan(path, lambda: spark.read.text(path, wholetext=True))
    return scan.select(F.col("_metadata.file_path").alias("path"), "value")


def _raise_first(bad: DataFrame) -> None:
    """Raise ValueError for one row of (path, status), if there is any."""
    found = bad.limit(1).collect()
    if found:
        raise ValueError(f"{found[0]['path']} is {found[0]['status']}: expected JSON records")


def validate_json_arrays(spark: SparkSession, path: str) -> None:
    """Raise ValueError if a file is not one well-formed JSON array of product records."""
    texts = read_json_texts(spark, path)
    status = json_array_status(F.col("value"))
    odd = F.exists(json_records(F.col("value")), lambda record: ~is_record(record))
    checked = texts.select("path", F.when(odd, "an array with elements that are no records").otherwise(status).alias("status"))
    _raise_first(checked.filter("status <> 'ok'"))


def validate_json_lines(spark: SparkSession, path: str) -> None:
    """Raise ValueError if a line that is not blank is not one product record."""
    lines = _scan(path, lambda: spark.read.text(path)).select(F.col("_metadata.file_path").alias("path"), "value")
    bad = lines.filter(F.trim("value") != "").filter(~is_record(F.col("value")))
    _raise_first(bad.select("path", F.lit("malformed or holds a line that is no record").alias("status")))


def snapshot_records(texts: DataFrame, column: str = "raw_json") -> DataFrame:
    """Bronze form of product records held as one JSON text per row."""
    head = F.from_json(column, "product_id STRING, name STRING, category STRING")
    return texts.select(head.alias("_head"), column).select("_head.*", column)


def records_of_arrays(texts: DataFrame, column: str = "value") -> DataFrame:
    """One `raw_json` row per element of JSON arrays held as text."""
    return texts.select(F.explode(json_records(F.col(column))).alias("raw_json"))


def read_products(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Product records as (product_id, name, category, raw_json).

    A JSON array cannot be split, so each file is one task. With `lines` the file
    holds one record per line, and Spark splits it like any text, which is the form
    for a large catalogue. Anything but whole records raises ValueError.
    """
    if lines:
        validate_json_lines(spark, path)
        texts = _scan(path, lambda: spark.read.text(path)).filter(F.trim("value") != "")
        return snapshot_records(texts.withColumnRenamed("value", "raw_json"))
    validate_json_arrays(spark, path)
    return snapshot_records(records_of_arrays(read_json_texts(spark, path)))
