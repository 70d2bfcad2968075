"""Decrypt new rows of the encrypted-event stream, and try again what failed when it is due."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.operators.decrypt import EVENT_SCHEMA, OK, Decryptor, decryption
from weirstone.operators.dedup import dedup_latest
from weirstone.operators.filters import unprocessed
from weirstone.streaming.batches import has_batches
from weirstone.streaming.retries import EXPIRED, Retries, attempts_path, given_schema, next_tick, pending, retry_failures
from weirstone.streaming.runner import drain_to_batches, write_batch


def decrypt_stream(
    stream: DataFrame, decryptor: Decryptor, as_of: dt.datetime, path: str, checkpoint: str, retries: Retries = Retries(), retire: bool = True
) -> None:
    """Drain the new rows: one pass and one write per batch, partitioned by status. Then try what is due.

    Rows that failed are kept as state with a timer each (see ``retries``), so a run reads the rows
    that have come since the last one and those that are due, and no batch twice. With ``retire`` the files of
    failed rows go once they are state.
    """
    spark = stream.sparkSession
    tick = next_tick(spark, path, as_of)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = decryption(unprocessed(batch), decryptor, as_of).withColumn("tried_at", F.lit(tick))
        write_batch(rows, path, batch_id, "status")

    drain_to_batches(stream, load, checkpoint)
    if has_batches(spark, path):
        retry_failures(spark, path, stream.schema, tick, lambda rows: decryption(rows, decryptor, as_of), retries, retire)


def failed_events(spark: SparkSession, path: str) -> DataFrame:
    """Rows as they were given that no attempt has decrypted: those that wait, and those that expired."""
    return pending(spark, path).drop("failures").unionByName(expired_events(spark, path)).distinct()


def expired_events(spark: SparkSession, path: str) -> DataFrame:
    """Rows as they were given whose last attempt has failed."""
    schema = T.StructType([T.StructField("given", given_schema(spark, path)), T.StructField("status", T.StringType())])
    if not has_batches(spark, attempts_path(path)):
        return spark.createDataFrame([], schema).select("given.*")
    return spark.read.schema(schema).parquet(attempts_path(path)).filter(F.col("status") == EXPIRED).select("given.*")


def decrypted_events(spark: SparkSession, path: str) -> DataFrame:
    """One row per event key; a key that was decrypted twice does no harm."""
    rows = _good(spark, path).withColumn("retried", F.lit(0))
    if has_batches(spark, attempts_path(path)):
        rows = rows.unionByName(_good(spark, attempts_path(path)).withColumn("retried", F.lit(1)))
    order = [F.col("retried").desc(), F.col("batch_id").desc(), F.col("message").desc()]
    return dedup_latest(rows, ["event_key"], order).select(*EVENT_SCHEMA.names)


def _good(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("batch_id", T.IntegerType()), T.StructField("status", T.StringType())])
    return spark.read.schema(schema).parquet(path).filter(F.col("status") == OK)
