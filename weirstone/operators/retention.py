"""Retention: drop rows past their age, table by table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.dates import instant

# Default age limit, and the columns that can date a row, in order of preference.
RETENTION_DAYS = 366
TIMESTAMP_COLUMNS = ("dw_created_at", "updated_at", "created_at")


def cutoff(as_of: dt.date, days: int = RETENTION_DAYS) -> dt.datetime:
    day = as_of - dt.timedelta(days=days)
    return dt.datetime(day.year, day.month, day.day)


def is_expired(timestamp: str, as_of: dt.date, days: int = RETENTION_DAYS) -> Column:
    """Strictly older than the cutoff day; a NULL timestamp is kept."""
    return F.col(timestamp) < instant(cutoff(as_of, days))


def apply_retention(df: DataFrame, timestamp: str, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows to keep. On a table partitioned by date whole partitions are pruned."""
    return df.filter((F.col(timestamp) >= instant(cutoff(as_of, days))) | F.col(timestamp).isNull())


def count_expired(df: DataFrame, timestamp: str, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """One row: total, expired and undated rows. Reads a single column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_expired(timestamp, as_of, days)).alias("deleted_rows"),
        F.count_if(F.col(timestamp).isNull()).alias("undated_rows"),
    )


def timestamp_column(table: str, columns: Sequence[str], overrides: Mapping[str, str] | None = None) -> str | None:
    """The configured column of the table, else the first usual one it has."""
    if overrides and table in overrides:
        return overrides[table]
    return next((c for c in TIMESTAMP_COLUMNS if c in columns), None)


def selected_tables(existing: Sequence[str], included: Sequence[str] | str | None = "*", excluded: Sequence[str] = ()) -> list[str]:
    """Existing tables that are included and not excluded; no include list means all."""
    everything = not included or included == "*" or list(included) == ["*"]
    names = [included] if isinstance(included, str) and not everything else included
    return [t for t in existing if (everything or t in names) and t not in excluded]


class RetentionPlan(NamedTuple):
    kept: dict[str, DataFrame]
    counts: DataFrame | None
    skipped: list[str]
    errors: list[str]


def plan_retention(
    tables: Mapping[str, DataFrame],
    as_of: dt.date,
    days: int = RETENTION_DAYS,
    included: Sequence[str] | str | None = "*",
    excluded: Sequence[str] = (),
    overrides: Mapping[str, str] | None = None,
) -> RetentionPlan:
    """What to keep and what would be deleted, per table.

    A configured table that does not exist is an error; a table without a date is skipped.
    """
    names = [] if not included or isinstance(included, str) else [t for t in included if t != "*"]
    errors = [f"{t}: configured table does not exist" for t in names if t not in tables]
    kept: dict[str, DataFrame] = {}
    counts: DataFrame | None = None
    skipped: list[str] = []
    for table in selected_tables(list(tables), included, excluded):
        df = tables[table]
        column = timestamp_column(table, df.columns, overrides)
        if column is None:
            skipped.append(table)
            continue
        if column not in df.columns:
            errors.append(f"{table}: no column {column}")
            continue
        kept[table] = apply_retention(df, column, as_of, days)
        row = count_expired(df, column, as_of, days).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("timestamp_column"), "*"
        )
        counts = row if counts is None else counts.unionByName(row)
    return RetentionPlan(kept, counts, skipped, errors)
