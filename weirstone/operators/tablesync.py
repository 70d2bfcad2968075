"""Copies of audit tables that are refreshed by key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.dates import instant
from weirstone.operators.dedup import dedup_latest
from weirstone.operators.upsert import upsert, upsert_partial
from weirstone.sources.tables import staged

def wide_types(schema: T.StructType) -> dict[str, str]:
    """CHAR and VARCHAR columns become STRING in the copy."""
    return {f.name: "string" for f in schema if isinstance(f.dataType, (T.CharType, T.VarcharType))}


def missing_columns(source: DataFrame, target: DataFrame) -> list[str]:
    """Columns of the source that the copy does not have yet, in source order."""
    return [c for c in source.columns if c not in target.columns]


def missing_catalog_columns(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same over catalogue rows (table, column) for all tables at once."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def sync_table(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[Column],
    since: Column | None = None,
    timestamp: str | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Upsert the source, one row per key, into its copy.

    A missing copy is created; new source columns are added (NULL in old rows). With
    ``timestamp`` and ``since`` only newer source rows are read, and those without a time; a copy
    that is missing gets them all. With ``staging`` the deduplicated
    rows are written there and computed only once.
    """
    widen = wide_types(source.schema)
    rows = source.select([F.col(c).cast(widen[c]).alias(c) if c in widen else F.col(c) for c in source.columns])
    if timestamp and since is not None and target is not None:
        rows = rows.filter((F.col(timestamp) > since) | F.col(timestamp).isNull())
    latest = staged(dedup_latest(rows, keys, order), staging)
    if target is None:
        return latest
    if set(target.columns) <= set(rows.columns):
        return upsert(target, latest, keys, None if staging else rows)
    # The copy has columns the source lost: matched rows keep them.
    added = {c: F.lit(None).cast(rows.schema[c].dataType) for c in missing_columns(rows, target)}
    return upsert_partial(target.withColumns(added), latest, keys, rows.columns)


def last_sync(metadata: DataFrame, table: str) -> dt.datetime | None:
    """Last run of one table (a metadata row, not data); None before the first, which copies all."""
    found = metadata.filter(F.col("table_name") == table).agg(F.max("last_sync_time")).first()
    return found[0] if found else None


def record_sync(metadata: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """Metadata with the run time of ``table`` set."""
    row = metadata.sparkSession.range(1).select(
        F.lit(table).alias("table_name"), instant(as_of).alias("last_sync_time")
    )
    return upsert(metadata, row, ["table_name"])


def run_each(tables: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Run one job per table; a failing table does not stop the others.

    The loop is over table names, each job is a distributed write. All errors are raised at
    the end in one message.
    """
    results: dict[str, object] = {}
    errors: list[str] = []
    for name, job in tables.items():
        try:
            results[name] = job()
        except Exception as error:  # noqa: BLE001 - reported below with the table name
            errors.append(f"Error processing table {name}: {error}")
    if errors:
        raise RuntimeError("; ".join(errors))
    return results
