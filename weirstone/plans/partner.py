"""Partner metrics of one period for every provider in force: one plan, one JSON document each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.dates import check_cadence, date_key_of
from weirstone.functions.text import is_bad_integer, strict_integer
from weirstone.operators.filters import in_force, issuer_filter
from weirstone.plans.partner_fields import METRIC_TABLES, PERIOD_COLUMNS

REQUIRED = ("issuer", "service_provider_name", "period_date_actual")


class Period(NamedTuple):
    calendar_id: int
    start: str


class MetricTable(NamedTuple):
    """A metric table with the names of its provider and period columns and its fields."""

    df: DataFrame
    provider: str
    period: str
    fields: Sequence[str]


def metric_tables(tables: Mapping[str, DataFrame], period: str = "period_date_id") -> list[MetricTable]:
    """The four metric tables by kind (usage, idv, auth, account)."""
    return [MetricTable(tables[k], provider, period, fields) for k, (_, provider, fields) in METRIC_TABLES.items()]


def metric_table_name(kind: str, cadence: str) -> str:
    return f"marts.{METRIC_TABLES[kind][0]}_{check_cadence(cadence)}"


def report_period(calendar: DataFrame, report_date: dt.date, cadence: str = "monthly") -> Period | None:
    """Start of the period that holds ``report_date``: one calendar row, or None without one.

    Looked up before the report so that the period is a literal there: it prunes the metric
    tables at the scan instead of being joined in.
    """
    id_column, date_column = PERIOD_COLUMNS[check_cadence(cadence)]
    row = (
        calendar.filter(F.col("calendar_id") == date_key_of(report_date))
        .select(F.col(id_column).alias("id"), F.date_format(date_column, "yyyy-MM-dd").alias("start"))
        .first()
    )
    return Period(row.id, row.start) if row and row.start is not None else None


def partner_rows(
    providers: DataFrame,
    tables: Sequence[MetricTable],
    period: Period,
    report_date: dt.date,
    included: Sequence[str] | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Providers in force with the metrics of the period, left-joined by provider id."""
    rows = issuer_filter(in_force(providers, report_date), included, excluded).select(
        "issuer",
        "service_provider_name",
        "agency_name",
        "service_provider_id",
        F.lit(report_date).alias("report_date"),
        F.lit(period.calendar_id).alias("period_date_id"),
        F.lit(period.start).alias("period_date_actual"),
    )
    for table in tables:
        metrics = table.df.filter(F.col(table.period) == period.calendar_id).select(
            F.col(table.provider).alias("service_provider_id"), *table.fields
        )
        rows = rows.join(metrics, "service_provider_id", "left")
    return rows


def checked_rows(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Every row with a ``status``: missing_field, duplicate_issuer, missing_id or ok.

    Only ok rows become reports; the first status that applies is given. Counts turn into strict
    integers; ``bad_values`` tells how many cells were not. Issuers that occur more than once are
    counted first and joined back, so no row is merged into another and no issuer gathers its rows
    in one place.
    """
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in REQUIRED))
    texts = [f for f in fields if isinstance(rows.schema[f].dataType, T.StringType)]
    bad = reduce(add, (is_bad_integer(F.col(f)).cast("int") for f in texts), F.lit(0))
    integers = {f: strict_integer(F.col(f)) if f in texts else F.col(f).cast("bigint") for f in fields}
    typed = rows.withColumns({"bad_values": bad} | integers)
    doubled = rows.filter(F.col("issuer").isNotNull()).groupBy("issuer").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    status = (
        F.when(missing, "missing_field")
        .when(F.col("__n").isNotNull(), "duplicate_issuer")
        .when(F.col("service_provider_id").isNull(), "missing_id")
        .otherwise("ok")
    )
    return typed.join(doubled, "issuer", "left").withColumn("status", status).drop("__n")


def partner_documents(checked: DataFrame, cadence: str, fields: Sequence[str]) -> DataFrame:
    """(service_provider_id, issuer, period_date_actual, document) for the ok rows."""
    document = F.struct(
        F.col("issuer"),
        F.struct("service_provider_name", "agency_name", "service_provider_id").alias("provider_information"),
        F.struct(
            F.col("period_date_actual").alias("period_start_date"),
            F.col("period_date_id").alias("period_calendar_id"),
            F.lit(check_cadence(cadence)).alias("report_cadence"),
        ).alias("report_information"),
        F.struct(*fields).alias("data"),
    )
    ok = checked.filter(F.col("status") == "ok")
    return ok.select(
        "service_provider_id",
        "issuer",
        "period_date_actual",
        F.to_json(document, {"ignoreNullFields": "false"}).alias("document"),
    )
