"""Shards by extendible hashing. DataFrame functions only.

A row's key is the first 60 bits of the MD5 of its id and text. The directory is
indexed by key prefixes; a bucket whose rows hold more than `limit` bytes of text is
split on its next bit, others stay as they are, so a shard is the shortest prefix
that fits. Bytes are summed once for cells of a few bits more than an even split
would need, and added up for all shorter prefixes; only cells still too large are
read again with more bits.

A bucket that cannot be split, one row over the limit or rows that repeat id and
text, stays one shard with `fits` false. Null ids and texts count as empty ones; an
empty text has 0 bytes. No rows give no shards. Columns of the input are carried
along unless named like one of the new columns.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, whole_row, written

KEY_BITS = 60
SPARE_BITS = 4
SHARD_BYTES = 8 << 20

NEW = ("n_bytes", "depth", "prefix", "shard_bytes", "fits")


def _cells(rows: DataFrame, bits: int) -> DataFrame:
    """Bytes of each key prefix of `bits` bits; `one` marks cells that no bit can split."""
    return rows.groupBy(F.shiftright("key", KEY_BITS - bits).alias("cell")).agg(
        F.sum("n_bytes").alias("bytes"), (F.min("key") == F.max("key")).alias("one")
    )


def _leaves(cells: DataFrame, bits: int, floor: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(cell, depth, prefix, shard_bytes) of the cells in shards that fit, and the cells left."""
    above = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(floor), F.lit(bits))).alias("depth"))
    above = above.withColumn("prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
    nodes = above.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"))
    fitting = above.join(own_shuffle(nodes.filter(F.col("shard_bytes") <= limit), "depth", "prefix"), ["depth", "prefix"])
    first = fitting.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("leaf")).select("cell", "leaf.*")
    whole = cells.filter((F.col("bytes") > limit) & F.col("one")).select(
        "cell", F.lit(bits).alias("depth"), F.col("cell").alias("prefix"), F.col("bytes").alias("shard_bytes")
    )
    return first.union(whole), cells.filter((F.col("bytes") > limit) & ~F.col("one")).select("cell")


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """The columns of `docs` with n_bytes, and the shard: depth (bits), prefix, shard_bytes, fits."""
    carried = [c for c in docs.columns if c not in NEW]
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    keyed = docs.select(
        whole_row(carried).alias("rest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
    )
    total = keyed.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(KEY_BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1.0, total / limit)))))
    rows, parts, floor = keyed, [], 0
    while True:
        placed, left = _leaves(written(_cells(rows, bits), "cells"), bits, floor, limit)
        placed, left = written(placed, "leaves"), written(left, "open")
        cell = F.shiftright("key", KEY_BITS - bits).alias("cell")
        at = rows.select("*", cell)
        parts.append(at.join(placed, "cell").select("rest", "n_bytes", "depth", "prefix", "shard_bytes"))
        if left.isEmpty():
            break
        rows = at.join(left, "cell", "left_semi").drop("cell")
        floor, bits = bits + 1, min(KEY_BITS, bits + 8)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.select("rest.*", *NEW[:-1], (F.col("shard_bytes") <= limit).alias("fits"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """One folder of Parquet for each shard, named by its depth and prefix."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = sharded(docs, limit).repartition(tasks, "depth", "prefix")
    placed.drop("n_bytes", "shard_bytes", "fits").write.partitionBy("depth", "prefix").parquet(path)
