"""Session helpers: UTC time zone and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


# Settings for large clusters; every one can be overridden. Many small shuffle partitions that
# AQE merges to the advisory size fit both a report and a full-table job; skewed join partitions
# are split at run time. Broadcasts stay behind Spark's own size limit.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str, **settings: str) -> SparkSession:
    """Session with ``CLUSTER_SETTINGS``; keyword settings use ``__`` for dots and win."""
    builder = SparkSession.builder.appName(app)
    for key, value in (CLUSTER_SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without zone are UTC by contract; make string and day arithmetic follow."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Without that setting it is a relative path, which Spark resolves against the default file
    system (on a cluster the user's home folder there). The rule is the same on every master.
    """
    return (spark.conf.get("spark.checkpoint.dir", None) or "weirstone-work").rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared root; never reused between runs."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
