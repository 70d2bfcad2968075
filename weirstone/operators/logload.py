"""Load raw log rows into a typed log table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.operators.dedup import dedup_latest, split_null_keys
from weirstone.operators.extract import JsonColumn, extract_columns
from weirstone.operators.upsert import upsert
from weirstone.sources.partitions import merge_days
from weirstone.sources.tables import staged


class LogLoad(NamedTuple):
    """New state of the typed table, and the raw rows that stay behind."""

    target: DataFrame
    remaining: DataFrame


def latest_logs(raw: DataFrame, spec: Sequence[JsonColumn], key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """Typed rows, one per key: the latest arrival, then the greatest message text."""
    keyed, _ = split_null_keys(extract_columns(raw, spec), [key])
    return dedup_latest(keyed, [key], order or arrival_order())


def arrival_order() -> list[Column]:
    return [F.col("cloudwatch_timestamp").desc_nulls_last(), F.col("message").desc_nulls_last()]


def load_logs(
    raw: DataFrame, target: DataFrame, spec: Sequence[JsonColumn], key: str, staging: str | None = None
) -> LogLoad:
    """Dedup, extract, upsert by ``key``.

    Every raw row with a key is merged (or superseded by a later one), so what remains is the
    rows without a usable key. They do not stop the load of the others. With ``staging`` (a new
    folder in shared storage) every message is parsed once: the typed rows and the rejects are
    written there together. Without it the plan parses for each of its parts.
    """
    if staging is None:
        changed = extract_columns(raw, _key_only(spec, key), keep=()).filter(F.col(key).isNotNull())
        return LogLoad(upsert(target, latest_logs(raw, spec, key), [key], changed), rejected_logs(raw, spec, key))
    keyed, rest = split_null_keys(staged(extract_columns(raw, spec), staging), [key])
    return LogLoad(upsert(target, dedup_latest(keyed, [key], arrival_order()), [key], keyed), rest.select(*raw.columns))


def load_logs_by_day(raw: DataFrame, table: str, spec: Sequence[JsonColumn], key: str, day: str, staging: str) -> DataFrame:
    """Load into a table partitioned by the day of arrival, rewriting only the days concerned.

    Messages are parsed once, into ``staging``. Rows without a time are put on 1970-01-01. Returns
    the raw rows that stay behind.
    """
    keyed, rest = split_null_keys(staged(extract_columns(raw, spec), f"{staging}/parsed"), [key])
    arrived = F.coalesce(F.to_date("cloudwatch_timestamp"), F.lit("1970-01-01").cast("date"))
    latest = dedup_latest(keyed, [key], arrival_order()).withColumn(day, arrived)
    merge_days(latest, table, [key], day, f"{staging}/latest")
    return rest.select(*raw.columns)


def rejected_logs(raw: DataFrame, spec: Sequence[JsonColumn], key: str) -> DataFrame:
    """Raw rows whose message has no key or is no JSON."""
    keyed = extract_columns(raw, _key_only(spec, key), keep=raw.columns)
    return split_null_keys(keyed, [key])[1].drop(key)


def _key_only(spec: Sequence[JsonColumn], key: str) -> list[JsonColumn]:
    return [c for c in spec if c.column == key]
