"""Tables, scratch space and joins shared by the operators here."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, with its SQL where SQL can express it."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def per_process(key: str, make: Callable):
    """What `make` gives, kept for all tasks of this Python worker."""
    held = sys.modules.setdefault("_siltstone_held", types.ModuleType("_siltstone_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """New folder name under spark.checkpoint.dir, or, on one machine, under the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark drops the shuffle files of an execution as soon as it ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def quoted(name: str) -> str:
    """A column's name as Spark's functions take it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(columns: list[str]) -> Column:
    """The columns as one struct."""
    return F.struct(*[F.col(quoted(c)) for c in columns])


def with_rest(df: DataFrame, more: str) -> StructType:
    """The schema of the struct `rest` of `df` and of further columns."""
    return StructType([StructField("rest", df.schema["rest"].dataType), *StructType.fromDDL(more).fields])


def written(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """`df` as a table in the shared folder, in a folder for each value of `by`.

    Lineage ends there, and any executor can read it.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    with _shuffles_removed(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_shuffle(df: DataFrame, *keys: str) -> DataFrame:
    """Hide that `df` already lies by `keys`, so that a join shuffles it anew.

    AQE splits the hot partitions of a join only where both sides come straight
    from a shuffle; an aggregate on the join's key would otherwise be used as it lies.
    """
    return df.withColumns({k: F.when(F.col(k).isNotNull(), F.col(k)) for k in keys})
