"""Date keys, period starts and labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

CADENCES = ("monthly", "weekly", "daily")


def instant(value: dt.datetime) -> Column:
    """Timestamp literal. A value without zone is UTC, whatever the zone of the driver's machine."""
    return F.lit(value if value.tzinfo else value.replace(tzinfo=dt.UTC))


def date_key(day: Column) -> Column:
    """Calendar key, for example 20260315."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def date_key_of(day: dt.date) -> int:
    """The same key for a known date, so that calendar filters are literals."""
    return int(day.strftime("%Y%m%d"))


def period_start(day: Column, cadence: str) -> Column:
    """Start of the month, Monday week or day."""
    unit = {"monthly": "month", "weekly": "week", "daily": "day"}[check_cadence(cadence)]
    return F.date_trunc(unit, day).cast("date")


def check_cadence(cadence: str) -> str:
    if cadence not in CADENCES:
        raise ValueError(f"Invalid report cadence {cadence!r}; must be one of {', '.join(CADENCES)}")
    return cadence


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM yyyy")


def month_tag(ts: Column) -> Column:
    return F.date_format(ts, "MMM-yyyy")


def quarter_label(day: Column) -> Column:
    """For example Q32025."""
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"), F.year(day).cast("string"))


def quarter_of(run_date: dt.date, days_back: int = 2) -> tuple[dt.datetime, dt.datetime]:
    """Half-open [start, end) of the quarter holding ``run_date - days_back``."""
    if not 0 <= days_back <= 90:
        raise ValueError(f"days_back must be between 0 and 90, got {days_back}")
    day = run_date - dt.timedelta(days=days_back)
    start = dt.datetime(day.year, 3 * ((day.month - 1) // 3) + 1, 1)
    end = dt.datetime(start.year + (start.month == 10), (start.month + 3) % 12 or 12, 1)
    return start, end


def month_of(day: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Half-open [start, end) of the month holding ``day``."""
    start = dt.datetime(day.year, day.month, 1)
    return start, dt.datetime(day.year + (day.month == 12), day.month % 12 + 1, 1)


def bucket_floor(ts: Column, minutes: int = 5) -> Column:
    """Timestamp cut to its bucket; NULL stays NULL."""
    width = F.lit(60 * minutes)
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, width))


def epoch_seconds(seconds: Column) -> Column:
    """Epoch seconds with a fraction to a timestamp, exact to the microsecond."""
    return F.timestamp_seconds(seconds.cast("decimal(20,6)"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
