"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE does the run-time work the plans rely on: it splits the hot partitions of
# skewed joins, merges small ones, and turns a sort-merge join into a broadcast
# join only once the measured side is under autoBroadcastJoinThreshold.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "siltstone", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library expects; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder name under the checkpoint folder that all executors can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = "/tmp/siltstone"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
