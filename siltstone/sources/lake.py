"""Layered parquet tables with safe replacement.

A table folder holds two slots, each with a record of its last commit:

    <root>/<layer>/<table>/_slot0/           parquet
    <root>/<layer>/<table>/_slot0/_commit/   version, watermark, stream batch
    <root>/<layer>/<table>/_slot1/ ...

A load overwrites the older slot, and with it that slot's record, and writes the
new record last. Readers follow the record with the highest version. A job that
dies halfway leaves the current slot untouched, a table can be rewritten from
its own contents, data and watermark move together, and disk use stays at two
copies. One writer per table at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_RECORD = (
    "version BIGINT, slot INT, row_count BIGINT, watermark STRING, writer STRING, batch_id BIGINT,"
    " delta BIGINT, floor STRING, undated BIGINT, key STRING, generation INT, slots STRING, columns STRING"
)
_SLOTS = 2
BUCKETS = 32
_BUCKET, _SLOT = "_bucket", "_slot"


class Commit(NamedTuple):
    version: int
    slot: int
    row_count: int
    watermark: str | None
    writer: str | None = None
    batch_id: int | None = None
    delta: int | None = None  # the last delta applied in parts, and the mark before it
    floor: str | None = None
    undated: int | None = None  # delta rows of the load without a timestamp
    key: str | None = None  # of a table in buckets: its key, generation, a slot for each bucket, its schema
    generation: int | None = None
    slots: str | None = None
    columns: str | None = None

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(len(self.slots))).cast("int")


def _slot_of(slots: str, bucket: Column) -> Column:
    return F.substring(F.lit(slots), bucket + 1, F.lit(1)).cast("int")


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def last_commit(self, layer: str, table: str) -> Commit | None:
        records = f"{self._folder(layer, table)}/_slot*/_commit"
        try:
            # A record may go while it is read, when the older slot is overwritten.
            log = self.spark.read.schema(_RECORD).option("ignoreMissingFiles", True).json(records)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        newest = log.orderBy(F.desc("version")).limit(1).collect()
        return Commit(*newest[0]) if newest else None

    def exists(self, layer: str, table: str) -> bool:
        return self.last_commit(layer, table) is not None

    def path(self, layer: str, table: str) -> str:
        """Parquet folder of the table's current contents (of all its slots, for a table in buckets)."""
        commit = self.last_commit(layer, table)
        if commit is None:
            raise FileNotFoundError(f"no table {layer}/{table} under {self.root}")
        place = f"_slot{commit.slot}" if commit.slots is None else f"_gen{commit.generation}"
        return f"{self._folder(layer, table)}/{place}"

    def read(self, layer: str, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table's rows, or those of some buckets; other buckets and old slots are pruned."""
        path = self.path(layer, table)
        commit = self.last_commit(layer, table)
        if commit.slots is None:
            return self.spark.read.parquet(path)
        schema = StructType.fromJson(json.loads(commit.columns))
        stored = StructType([*schema.fields, StructField(_BUCKET, IntegerType()), StructField(_SLOT, IntegerType())])
        rows = self.spark.read.schema(stored).parquet(path)
        rows = rows.filter(F.col(_SLOT) == _slot_of(commit.slots, F.col(_BUCKET)))
        if buckets is not None:
            rows = rows.filter(F.col(_BUCKET).isin(list(buckets)))
        return rows.drop(_BUCKET, _SLOT)

    def _record(self, layer: str, table: str, commit: Commit) -> Commit:
        record = self.spark.createDataFrame([commit], _RECORD).coalesce(1)
        record.write.mode("overwrite").json(f"{self._folder(layer, table)}/_slot{commit.slot}/_commit")
        return commit

    def publish_buckets(
        self, layer: str, table: str, df: DataFrame, key: str, stamp: str, buckets: int = BUCKETS
    ) -> Commit:
        """Replace the table by one in `buckets` buckets of its key; the watermark starts anew.

        A bucket that a hot key makes large is written by several tasks.
        """
        last = self.last_commit(layer, table)
        commit = Commit(
            version=last.version + 1 if last else 0,
            slot=(last.slot + 1) % _SLOTS if last else 0,
            row_count=0,
            watermark=None,
            key=key,
            generation=1 - last.generation if last and last.generation is not None else 0,
            slots="0" * buckets,
            columns=df.schema.json(),
        )
        seen = self._write_buckets(layer, table, df, commit, stamp, F.lit(None).cast("timestamp_ntz"), "static")
        return self._record(layer, table, commit._replace(**seen))

    def rewrite_buckets(
        self, layer: str, table: str, df: DataFrame, touched: Sequence[int], stamp: str, **fields
    ) -> Commit:
        """Replace the rows of the touched buckets by `df`; `fields` go into the record."""
        last = self.last_commit(layer, table)
        slots = "".join(str(1 - int(s)) if i in set(touched) else s for i, s in enumerate(last.slots))
        before = self.read(layer, table, touched).count()  # from the footers
        commit = last._replace(version=last.version + 1, slot=(last.slot + 1) % _SLOTS, slots=slots, **fields)
        mark = F.lit(last.watermark).cast("timestamp_ntz")
        seen = self._write_buckets(layer, table, df, commit, stamp, mark, "dynamic")
        seen["row_count"] += last.row_count - before
        return self._record(layer, table, commit._replace(**seen))

    def _write_buckets(
        self, layer: str, table: str, df: DataFrame, commit: Commit, stamp: str, mark: Column, mode: str
    ) -> dict:
        seen = Observation(f"buckets_{layer}_{table}")
        top = F.greatest(F.max(stamp), mark).cast("string")
        rows = df.observe(seen, F.count(F.lit(1)).alias("row_count"), top.alias("watermark"))
        rows = rows.withColumn(_BUCKET, commit.bucket(F.col(commit.key)))
        rows = rows.withColumn(_SLOT, _slot_of(commit.slots, F.col(_BUCKET))).hint("rebalance", F.col(_BUCKET))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(_BUCKET, _SLOT)
        writer.parquet(f"{self._folder(layer, table)}/_gen{commit.generation}")
        return dict(seen.get)

    def publish(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        stamp: str | None = None,
        writer: str | None = None,
        batch_id: int | None = None,
        carry_watermark: bool = True,
        delta: int | None = None,
        floor: str | None = None,
        undated: int | None = None,
        counts: Mapping[str, Column] | None = None,
        gate: Callable[[dict[str, int], DataFrame], None] | None = None,
    ) -> Commit:
        """Replace the table's contents; counts and watermark are taken as it is written.

        Contents without any timestamp leave the watermark where it was, unless
        it is not to be carried over. `gate` gets the values of `counts`, taken in the same
        write, and the new contents; if it raises, the table stays as it was.
        """
        last = self.last_commit(layer, table)
        slot = (last.slot + 1) % _SLOTS if last else 0
        seen = Observation(f"publish_{layer}_{table}")
        top = F.max(stamp).cast("string") if stamp else F.lit(None).cast("string")
        target = f"{self._folder(layer, table)}/_slot{slot}"
        asked = [column.alias(name) for name, column in (counts or {}).items()]
        counted = df.observe(seen, F.count(F.lit(1)).alias("row_count"), top.alias("watermark"), *asked)
        counted.write.mode("overwrite").parquet(target)
        metrics = seen.get
        if gate:
            gate({name: metrics[name] for name in counts or {}}, self.spark.read.schema(df.schema).parquet(target))
        commit = Commit(
            version=last.version + 1 if last else 0,
            slot=slot,
            row_count=metrics["row_count"],
            watermark=metrics["watermark"] or (last.watermark if last and carry_watermark else None),
            writer=writer,
            batch_id=batch_id,
            delta=delta,
            floor=floor,
            undated=undated,
        )
        return self._record(layer, table, commit)
