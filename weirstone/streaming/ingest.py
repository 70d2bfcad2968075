"""Encrypted events from 5-minute buckets into their table.

Every couple of minutes the rows that have arrived are appended with their bucket and event time;
no batch rewrites the day it falls on, and no row is dropped for coming late. ``current_events``
resolves the batches when reading and leaves out only the bucket that is still being filled. Rows
without a time have no bucket and no day; they go to a folder of rejects, with their batch.
``fold_batches`` merges closed batches into the table and retires them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.dates import instant
from weirstone.operators.upsert import same_key, upsert_partial
from weirstone.session import fresh_dir
from weirstone.sources.bucket_stream import drain
from weirstone.sources.buckets import bucket_events, bucket_name, closed_buckets
from weirstone.sources.tables import create_partitioned, overwrite_partitions, read_partitioned, staged
from weirstone.streaming.batches import folded_batch, record_folded, retire
from weirstone.streaming.runner import drain_to_batches

ENCRYPTED_SCHEMA = T.StructType(
    [
        T.StructField("event_key", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("bucket_name", T.StringType()),
        T.StructField("dw_created_at", T.TimestampType()),
        T.StructField("dw_processed_at", T.TimestampType()),
        T.StructField("partition_dt", T.DateType()),
    ]
)
KEYS = ["event_key", "partition_dt"]
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("event_key", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("bucket_name", T.StringType()),
        T.StructField("dw_created_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("partition_dt", T.DateType()),
    ]
)


def ingest_events(stream: DataFrame, batches: str, checkpoint: str, minutes: int = 5, loaded_at: Column | None = None) -> None:
    """Drain (event_key, message, ts): each micro-batch becomes one folder, partitioned by day.

    Stateless, so late rows and the last rows of a quiet source are kept like all others. The
    folder is replaced as a whole when a batch is replayed, so delivery is exactly once.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at

    def append(batch: DataFrame, batch_id: int) -> None:
        named = batch.select("event_key", "message", "ts", bucket_name(F.col("ts"), minutes).alias("bucket_name"))
        _append(bucket_events(named), batches, batch_id, stamp)

    drain_to_batches(stream, append, checkpoint)


def ingest_buckets(stream: DataFrame, batches: str, checkpoint: str, loaded_at: Column | None = None) -> None:
    """Drain the rows of ``stream_buckets``: buckets that are closed, in batches of the source's limit.

    If a micro-batch holds several batches of the source (column ``batch``), each becomes a folder
    under the source's number, replaced when it is replayed. A folder of batches keeps to one of both
    ways: the numbers of Spark and of the source differ.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("ts", F.lit(None).cast("timestamp"))
        if "batch" in batch.columns:
            _append_all(rows, batches, stamp)
        else:
            _append(rows, batches, batch_id, stamp)

    drain(stream, append, checkpoint)


def _append(rows: DataFrame, batches: str, batch_id: int, stamp: Column) -> None:
    """Both folders of a batch; the rows are read once."""
    stamped = rows.select("event_key", "message", "ts", "bucket_name", stamp.alias("dw_created_at"), "partition_dt").persist()
    try:
        dated = stamped.filter(F.col("partition_dt").isNotNull())
        dated.write.mode("overwrite").partitionBy("partition_dt").parquet(f"{batches}/batch_id={batch_id}")
        undated = stamped.filter(F.col("partition_dt").isNull()).drop("partition_dt")
        undated.write.mode("overwrite").parquet(f"{rejects_path(batches)}/batch_id={batch_id}")
    finally:
        stamped.unpersist()


def _append_all(rows: DataFrame, batches: str, stamp: Column) -> None:
    """Both folders of every ``batch`` in the rows, which are read once. A batch that is repeated has the
    same rows, so the partitions that it writes are those it has written before."""
    stamped = rows.select("event_key", "message", "ts", "bucket_name", stamp.alias("dw_created_at"), F.col("batch").alias("batch_id"), "partition_dt").persist()
    try:
        overwrite_partitions(stamped.filter(F.col("partition_dt").isNotNull()), batches, "batch_id", "partition_dt")
        undated = stamped.filter(F.col("partition_dt").isNull()).drop("partition_dt")
        overwrite_partitions(undated, rejects_path(batches), "batch_id")
    finally:
        stamped.unpersist()


def rejects_path(batches: str) -> str:
    return f"{batches.rstrip('/')}__rejected"


def rejected_events(spark: SparkSession, batches: str) -> DataFrame:
    """Rows without a time or with an unreadable bucket name, as they came, with their ``batch_id``."""
    schema = T.StructType([f for f in BATCH_SCHEMA if f.name != "partition_dt"])
    return read_partitioned(spark, rejects_path(batches), schema)


def resolved(rows: DataFrame) -> DataFrame:
    """One row per key and day: the last write by bucket, event time and batch; the first load time."""
    order = F.struct("bucket_name", "ts", "batch_id", "message")
    last = F.max_by(F.struct("message", "bucket_name"), order).alias("last")
    first = F.min_by("dw_created_at", "batch_id").alias("dw_created_at")
    return rows.groupBy(*KEYS).agg(last, first).select("event_key", "last.message", "last.bucket_name", "dw_created_at", "partition_dt")


def current_events(spark: SparkSession, batches: str, as_of: dt.datetime, days: Sequence[dt.date] | None = None, after: int | None = None) -> DataFrame:
    """Events of all buckets but the one that is open at ``as_of``; of ``days`` and of the batches
    after ``after`` only, if given."""
    rows = closed_buckets(read_partitioned(spark, batches, BATCH_SCHEMA), instant(as_of))
    if days is not None:
        rows = rows.filter(F.col("partition_dt").isin(list(days)))
    if after is not None:
        rows = rows.filter(F.col("batch_id") > after)
    return resolved(rows)


def merge_encrypted(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert by (event_key, partition_dt): a match changes message and bucket only, and only to
    the same or a later bucket."""
    newer = F.coalesce(F.col("t.bucket_name") > F.col("u.bucket_name"), F.lit(False))
    fresh = updates.alias("u").join(target.alias("t"), same_key("u", "t", KEYS) & newer, "left_anti")
    return upsert_partial(target, fresh, KEYS, ["message", "bucket_name"])


def fold_batches(spark: SparkSession, batches: str, table: str, as_of: dt.datetime) -> DataFrame:
    """Merge the batches that came after the last fold into the table, which is partitioned by day.

    Batches are folded in order, up to the first one that holds rows of the open bucket. The key
    contains the partition, so no other day can hold a match: only the days of those batches are
    rewritten. The number of the last folded batch is kept beside the table, and folded folders
    are removed once it is written. A fold that broke off is simply repeated.
    """
    create_partitioned(spark.createDataFrame([], ENCRYPTED_SCHEMA), table, "partition_dt")
    done = folded_batch(spark, table)
    pending = read_partitioned(spark, batches, BATCH_SCHEMA).filter(F.col("batch_id") > done)
    is_open = F.coalesce(F.col("bucket_name") == bucket_name(instant(as_of)), F.lit(False))
    first_open, last = pending.agg(F.min(F.when(is_open, F.col("batch_id"))), F.max("batch_id")).first()
    upto = last if first_open is None else first_open - 1
    if upto is not None and upto > done:
        ready = pending.filter(F.col("batch_id") <= upto)
        days = [r[0] for r in ready.select("partition_dt").distinct().collect()]  # one value per day
        concerned = F.col("partition_dt").isin([d for d in days if d is not None])
        if None in days:  # the partition of rows without a day is replaced like any other
            concerned = concerned | F.col("partition_dt").isNull()
        target = read_partitioned(spark, table, ENCRYPTED_SCHEMA).filter(concerned)
        updates = staged(resolved(ready), fresh_dir(spark, "fold"))  # three joins read them
        overwrite_partitions(merge_encrypted(target, updates), table, "partition_dt")
        record_folded(spark, table, upto)
        retire(spark, batches, upto)
    return read_partitioned(spark, table, ENCRYPTED_SCHEMA)
