"""Row filters shared by the reports. All are plain predicates that reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions.dates import instant


def between(df: DataFrame, ts: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Both ends inclusive."""
    return df.filter(F.col(ts).between(instant(start), instant(end)))


def in_period(df: DataFrame, ts: str, start: dt.datetime, next_start: dt.datetime) -> DataFrame:
    """Half-open [start, next_start): no fraction of the last second is lost."""
    return df.filter((F.col(ts) >= instant(start)) & (F.col(ts) < instant(next_start)))


def issuer_filter(
    df: DataFrame,
    included: Sequence[str] | None = None,
    excluded: Sequence[str] = (),
    issuer: str = "issuer",
) -> DataFrame:
    """Keep the included issuers, or drop the excluded ones; naming both is an error."""
    if included and excluded:
        raise ValueError("Cannot specify both included and excluded issuers")
    if included:
        return df.filter(F.col(issuer).isin(*included))
    if excluded:
        return df.filter(~F.col(issuer).isin(*excluded))
    return df


def in_force(df: DataFrame, day: dt.date, end: str = "iaa_end_date", launch: str = "launch_date") -> DataFrame:
    """Agreement ends strictly after ``day`` and the provider has launched by then; NULL excludes."""
    return df.filter((F.col(end) > F.lit(day)) & (F.lit(day) >= F.col(launch)))


def active(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("active"))


def verified(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("verified_at").isNotNull())


def fraud_rejection(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("fraud_rejection_at").isNotNull())


def fraud_review_pending(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("fraud_review_pending_at").isNotNull())


def usable_issuers(df: DataFrame, issuer: str = "issuer", key: str = "id") -> DataFrame:
    """Issuer present and not only spaces, id present."""
    return df.filter((F.trim(F.col(issuer)) != "") & F.col(key).isNotNull())


def unprocessed(df: DataFrame, mark: str = "dw_processed_at") -> DataFrame:
    return df.filter(F.col(mark).isNull())


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns, keep the others and the order."""
    return df.select([F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
