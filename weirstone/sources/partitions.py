"""Changes to catalogue tables partitioned by day that touch only the days concerned.

A snapshot of a very large table is too much to write for a small batch, and a retention run
need not read what it deletes. Both work on whole partitions here.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.operators.retention import RETENTION_DAYS, cutoff
from weirstone.operators.upsert import mark_processed, upsert, upsert_partial, with_matches, without_matches
from weirstone.sources.tables import staged
from weirstone.streaming.batches import folders


def create_day_table(df: DataFrame, table: str, day: str) -> None:
    """Create the table with the columns of ``df``, empty, if there is none yet."""
    if not df.sparkSession.catalog.tableExists(table):
        df.limit(0).write.format("parquet").partitionBy(day).saveAsTable(table)


def replace_days(df: DataFrame, table: str) -> None:
    """Overwrite the partitions that occur in ``df``, and no others.

    A table insert reads the overwrite mode from its session only, so it gets a session of its own with
    the settings of the caller's: two merges of one session do not disturb each other.
    """
    spark = df.sparkSession
    view = f"replace_{uuid.uuid4().hex}"
    df.select(*spark.table(table).columns).createGlobalTempView(view)
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        own.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)


def _days(df: DataFrame, day: str) -> set[dt.date]:
    """Distinct days: one value per day, however many rows."""
    return {row[0] for row in df.select(day).distinct().collect()}


def _drop_day(spark: SparkSession, table: str, day: str, value: dt.date) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day} = DATE'{value:%Y-%m-%d}')")


def merge_days(
    updates: DataFrame, table: str, keys: Sequence[str], day: str, staging: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
) -> None:
    """Upsert ``updates`` (unique on the keys) into ``table``, rewriting only the days concerned.

    ``merge`` may be another merge of (rows of those days, updates), such as a partial upsert that
    keeps the day of a matched row (see ``merge_days_partial``).

    Those are the days of the updates, and the days on which the table holds one of their keys;
    finding the latter reads key columns only. The updates are written to ``staging`` first (a
    new folder in shared storage), so they are computed once and survive lost executors. Spark
    stages a dynamic overwrite, so the rewritten days may be read in the same plan. A day whose
    rows have all moved to other days is dropped last. A merge that broke off can be repeated.
    """
    spark = updates.sparkSession
    rows = staged(updates, staging)
    target = spark.table(table)
    placed = target.select(*dict.fromkeys([*keys, day]))
    new, held = _days(rows, day), _days(with_matches(placed, rows, keys), day)
    if None in new:
        raise ValueError(f"rows without {day} cannot be placed in {table}")
    in_held = placed.filter(F.col(day).isin(list(held)) if held else F.lit(False))
    emptied = held - new - _days(without_matches(in_held, rows, keys), day)

    concerned = target.filter(F.col(day).isin(list(held | new)))
    replace_days((merge or (lambda t, u: upsert(t, u, keys)))(concerned, rows), table)
    for value in emptied:
        _drop_day(spark, table, day, value)


def merge_days_partial(updates: DataFrame, table: str, keys: Sequence[str], columns: Sequence[str], day: str, staging: str) -> None:
    """A match changes ``columns`` only; the keys contain the day, so no row moves."""
    if day not in keys:
        raise ValueError(f"{day} must be one of the keys")
    merge_days(updates, table, keys, day, staging, lambda t, u: upsert_partial(t, u, keys, columns))


def mark_processed_days(done: DataFrame, table: str, keys: Sequence[str], at: Column, day: str, mark: str = "dw_processed_at") -> None:
    """Stamp the unmarked rows with a key in ``done``; the keys contain the day. Other days stay."""
    if day not in keys:
        raise ValueError(f"{day} must be one of the keys")
    concerned = done.sparkSession.table(table).filter(F.col(day).isin(list(_days(done, day))))
    replace_days(mark_processed(concerned, done, keys, at, mark), table)


def day_folders(spark: SparkSession, path: str, day: str) -> list[str]:
    """The dates of a folder that is partitioned by day; rows without a date have none."""
    names = [name.removeprefix(f"{day}=") for name in folders(spark, path) if name.startswith(f"{day}=")]
    return sorted(name for name in names if name[:1].isdigit())


def drop_expired_days(spark: SparkSession, table: str, day: str, as_of: dt.date, days: int = RETENTION_DAYS) -> list[dt.date]:
    """Drop the partitions before the cutoff day: no data is read or written.

    The cutoff is a midnight, so for a table partitioned by the date of its timestamp this
    deletes exactly the rows that are strictly older. Rows without a date are kept.
    """
    limit = cutoff(as_of, days).date()
    names = [row.partition.split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    dated = [dt.date.fromisoformat(name) for name in names if name[:1].isdigit()]
    expired = sorted(value for value in dated if value < limit)
    for value in expired:
        _drop_day(spark, table, day, value)
    return expired
