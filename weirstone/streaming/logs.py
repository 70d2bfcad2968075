"""Raw log stream into typed tables.

Batches are appended, and the current rows are found when reading: no batch rewrites the log
table. ``fold_logs`` merges the batches that came after the last fold into a table, rewriting the
files that hold one of their keys, and removes them; ``compact_logs`` writes a snapshot as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.operators.dedup import dedup_latest
from weirstone.operators.extract import JsonColumn, extract_columns
from weirstone.operators.logload import arrival_order
from weirstone.operators.upsert import upsert
from weirstone.sources.file_rewrite import upsert_files
from weirstone.sources.logs import RAW_LOG_SCHEMA
from weirstone.streaming.batches import folded_batch, folders, record_folded, retire
from weirstone.streaming.runner import drain_to_batches, write_batch

TYPED, REJECTED = "typed", "rejected"


def extract_logs(stream: DataFrame, spec: Sequence[JsonColumn], key: str, table: str, checkpoint: str) -> None:
    """Drain raw rows; those without a key, or without JSON, are the rejected outcome.

    Every message is parsed once: a batch is one write, partitioned by outcome.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        outcome = F.when(F.col(key).isNull(), REJECTED).otherwise(TYPED)
        write_batch(extract_columns(batch, spec).withColumn("outcome", outcome), table, batch_id, "outcome")

    drain_to_batches(stream, load, checkpoint)


def batch_rows(spark: SparkSession, table: str, outcome: str, after: int = -1) -> DataFrame:
    rows = spark.read.parquet(table)
    return rows.filter((F.col("outcome") == outcome) & (F.col("batch_id") > after)).drop("outcome")


def rejected_rows(spark: SparkSession, table: str) -> DataFrame:
    """Raw rows that could not be typed."""
    return batch_rows(spark, table, REJECTED).select(*RAW_LOG_SCHEMA.names)


def current_logs(spark: SparkSession, table: str, key: str, after: int = -1) -> DataFrame:
    """One row per key: a later batch replaces an earlier one, a later arrival within a batch."""
    newest = dedup_latest(batch_rows(spark, table, TYPED, after), [key], [F.col("batch_id").desc(), *arrival_order()])
    return newest.drop("batch_id")


def fold_logs(spark: SparkSession, batches: str, table: str, key: str, staging: str) -> list[str]:
    """Merge what has come since the last fold into ``table``; returns the files that were rewritten.

    By arrival: of two rows with a key the one that arrived later stays, whichever batch brought it, so
    neither a late batch nor another load of the table is undone. Rejects of the folded batches are kept in
    a folder of their own (``folded_rejects``), then the batches go. A fold that broke off is repeated.
    """
    done = folded_batch(spark, batches)
    last = max((int(n.removeprefix("batch_id=")) for n in folders(spark, batches) if n.startswith("batch_id=")), default=-1)
    if last <= done:
        return []
    pending = spark.read.parquet(batches).filter(F.col("batch_id").between(done + 1, last))
    typed = pending.filter(F.col("outcome") == TYPED).drop("outcome")
    latest = dedup_latest(typed, [key], [*arrival_order(), F.col("batch_id").desc()]).drop("batch_id")
    latest.limit(0).write.mode("ignore").parquet(table)
    rejects = pending.filter(F.col("outcome") == REJECTED).select(*RAW_LOG_SCHEMA.names)
    rejects.write.mode("overwrite").parquet(f"{_rejects(table)}/upto={last}")
    files = upsert_files(latest, table, [key], staging, lambda held, new: dedup_latest(held.unionByName(new), [key], arrival_order()))
    record_folded(spark, batches, last)
    retire(spark, batches, last)
    return files


def _rejects(table: str) -> str:
    return f"{table.rstrip('/')}__rejected"


def folded_rejects(spark: SparkSession, table: str) -> DataFrame:
    """Raw rows of folded batches that could not be typed."""
    return spark.read.schema(RAW_LOG_SCHEMA).parquet(_rejects(table)).select(*RAW_LOG_SCHEMA.names)


def compact_logs(spark: SparkSession, snapshot: DataFrame, table: str, key: str, path: str) -> DataFrame:
    """New snapshot at ``path`` with the batches merged in that came after the last compaction.

    What another load has made newer in the snapshot stays, unless a batch has come since. Once the
    snapshot is published, ``batches.retire`` removes the folders up to ``folded_batch``.
    """
    done = folded_batch(spark, table)
    last = spark.read.parquet(table).agg(F.max("batch_id")).first()[0]
    fresh = current_logs(spark, table, key, done)
    upsert(snapshot, fresh, [key]).write.mode("errorifexists").parquet(path)
    record_folded(spark, table, done if last is None else max(done, last))
    return spark.read.schema(snapshot.schema).parquet(path)
