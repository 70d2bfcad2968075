"""Data-quality and security checks. Each returns findings or a one-row status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions.dates import instant

# Limits, watched logins and accounts that are never unexpected.
FRESHNESS_HOURS = 31
EXPORT_LINES = 10000
EXPORT_MINUTES = 5
EXPORT_NAMES = {"path": "s3_path", "query": "query_id"}
LOGIN_MINUTES = 15
LOGIN_EVENT = "authenticated"
WATCHED_USERS = ("pii_reader", "superuser")
SYSTEM_USERS = (
    "rdsdb",
    "rdsadmin",
    "superuser",
    "postgres",
    "security_audit",
    "quicksight_connector",
    "marts",
    "qa_marts",
    "rails_worker",
    "fraudops_marts",
    "fraudops_qa_marts",
    "pii_reader",
)
FUNCTION_USERS = ("db_consumption", "stale_data_check", "log_consumption")
COSTLY_ROLE_SUFFIX = "_PRO"
DUPLICATE_CHECK_SCHEMAS = ("logs", "idp")


def freshness(df: DataFrame, ts: str, as_of: dt.datetime, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """One row: latest time, age in hours, status. An empty table has the status ``error``."""
    limit = instant(as_of - dt.timedelta(hours=hours))
    latest = F.col("latest")
    age = (F.unix_micros(instant(as_of)) - F.unix_micros(latest.cast("timestamp"))) / F.lit(3.6e9)
    status = (
        F.when(latest.isNull(), "error").when(latest > limit, "within_range").otherwise("out_of_range")
    )
    return df.agg(F.max(ts).alias("latest")).select(
        "latest", F.round(age, 2).alias("freshness_hours"), status.alias("status")
    )


def freshness_of_days(table: DataFrame, days: Sequence[str], day: str, ts: str, as_of: dt.datetime, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """As ``freshness`` for a table partitioned by the date of ``ts``: its newest day alone is read.

    ``days`` are the days that it has, from its folders (``sources.partitions.day_folders``) or the
    catalogue. A day without any time leaves the answer to the day before.
    """
    for value in sorted(days, reverse=True):
        found = freshness(table.filter(F.col(day) == F.lit(value).cast("date")), ts, as_of, hours)
        if found.first().latest is not None:  # one row
            return found
    return freshness(table.filter(F.lit(False)), ts, as_of, hours)


def is_empty(df: DataFrame) -> bool:
    """Gate before a job: stops at the first row instead of counting all."""
    return df.isEmpty()


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, and their size. NULL keys are one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def duplicate_key(columns: Sequence[str]) -> str:
    """The identifying column of a log or dimension table."""
    return "id" if "id" in columns else "uuid"


def duplicate_check_tables(tables: Mapping[str, Sequence[str]], day: dt.date) -> list[tuple[str, str]]:
    """(schema, table) pairs to check on ``day``: no staging tables, logs on Saturdays only."""
    return [
        (schema, table)
        for schema, names in tables.items()
        for table in names
        if schema in DUPLICATE_CHECK_SCHEMAS
        and not table.startswith("unextracted_")
        and (schema != "logs" or day.weekday() == 5)
    ]


def large_exports(
    df: DataFrame,
    as_of: dt.datetime,
    lines: int = EXPORT_LINES,
    minutes: int = EXPORT_MINUTES,
    start: str = "start_time",
    end: str = "end_time",
    count: str = "line_count",
) -> DataFrame:
    """Exports over the threshold that started after the minute ``minutes`` before ``as_of``.

    Findings carry times to the minute, under the names of the alert.
    """
    since = (as_of - dt.timedelta(minutes=minutes)).replace(second=0, microsecond=0)
    return export_findings(df.filter((F.col(count) > lines) & (F.col(start) > instant(since))), start, end)


def export_findings(df: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    minute = "yyyy-MM-dd HH:mm"
    cut = df.withColumns({start: F.date_format(start, minute), end: F.date_format(end, minute)})
    return cut.withColumnsRenamed({start: "starttime", end: "endtime"} | EXPORT_NAMES)


def watched_logins(
    df: DataFrame,
    as_of: dt.datetime,
    users: Sequence[str] = WATCHED_USERS,
    minutes: int = LOGIN_MINUTES,
    event: str = LOGIN_EVENT,
) -> DataFrame:
    """Distinct watched users that logged in during the last minutes, the start included."""
    recent = F.col("record_time") >= instant(as_of - dt.timedelta(minutes=minutes))
    found = df.filter((F.col("event") == event) & F.col("user_name").isin(*users) & recent)
    return found.select(F.trim("user_name").alias("detected_user")).distinct()


def watched_login_windows(df: DataFrame, users: Sequence[object] | None, minutes: int = LOGIN_MINUTES, every: int = 5) -> DataFrame:
    """All runs of the check at once: logins per user and sliding window."""
    found = df.filter(F.col("user_name").isin(*users)) if users is not None else df
    window = F.window("record_time", f"{minutes} minutes", f"{every} minutes")
    return (
        found.groupBy(window.alias("w"), "user_name")
        .agg(F.count(F.lit(1)).alias("logins"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_name", "logins")
    )


def unexpected_users(
    actual: DataFrame, allowed: DataFrame, env: str, user: str = "user_name", prefix: str = "IAM:"
) -> DataFrame:
    """Users that are neither allowed, nor system users, nor this environment's function users.

    ``allowed`` holds bare names; in the database they carry ``prefix``. Case matters.
    """
    excluded = [*SYSTEM_USERS, *(f"IAMR:{env}_{name}" for name in FUNCTION_USERS)]
    known = allowed.select(F.concat(F.lit(prefix), F.col(user)).alias(user))
    return actual.filter(~F.col(user).isin(*excluded)).select(user).join(known, user, "left_anti")


def costly_roles(df: DataFrame, role: str = "role") -> DataFrame:
    return df.filter(F.col(role).endswith(COSTLY_ROLE_SUFFIX))


def unmapped_providers(reports: DataFrame, mapping: DataFrame, key: str = "service_provider_id") -> DataFrame:
    """Reports whose provider id is not in the issuer mapping; a NULL id is not reported here."""
    known = mapping.select(F.col("id").alias(key))
    return reports.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a NULL in the key, keys used more than once, verdict."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count_if(~has_null & (F.col("n") > 1)).alias("duplicate_keys"),
    )
    return totals.withColumn("is_valid", (F.col("null_rows") == 0) & (F.col("duplicate_keys") == 0))


def check_foreign_key(df: DataFrame, column: str, referenced: DataFrame, referenced_column: str) -> DataFrame:
    """Values without a referenced row and how often they occur. NULL refers to nothing.

    References are counted per value first, so the join sees each value once.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    known = referenced.select(F.col(referenced_column).alias(column))
    return values.join(known, column, "left_anti")
