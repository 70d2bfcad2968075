"""Report files: CSV tables, JSON documents, and where they go."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header row.

    ``single_file`` is for tables with a fixed handful of rows (metric tables); any table that
    grows with the data keeps its partitions, one header per part.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str, key: str = "service_provider_id") -> None:
    """One folder per key value with the JSON documents of that key."""
    df.write.mode("overwrite").partitionBy(key).json(path)


def rows_as_json(df: DataFrame, name: str = "document") -> DataFrame:
    """Each row as one JSON object, NULL fields kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def report_path(
    name: str,
    extension: str,
    now: dt.date,
    env: str | None = None,
    directory: str | None = None,
    subname: str | None = None,
) -> tuple[str, str]:
    """(latest path, dated path) of a report file."""
    file = f"{name}/{subname}.{extension}" if subname else f"{name}.{extension}"
    prefix = "/".join(p for p in (env, directory, name) if p is not None)
    return f"{prefix}/latest.{file}", f"{prefix}/{now.year}/{now:%Y-%m-%d}.{file}"


def provider_files(
    df: DataFrame,
    filename: str,
    period_end: dt.date,
    as_of: dt.date,
    report: str,
    period: Column,
    env: str | None = None,
    cadence: str = "quarterly",
    lag_days: int = 0,
    key: str = "service_provider_id",
) -> DataFrame:
    """One row per provider and file to write: dated, latest, and latest external.

    ``period_end`` is the last day of the period. Only a period that has ended (plus lag) is
    external; before that the ``latest_external`` file stays untouched.
    """
    external = period_end < as_of - dt.timedelta(days=lag_days)
    kind = "external" if external else "internal"
    provider = F.col(key).cast("string")
    names: Iterable[Column] = [
        F.concat(F.lit("SP"), provider, F.lit(f"_{as_of:%Y%m%d}_{kind}_{filename}.csv")),
        F.concat(F.lit("latest_SP"), provider, F.lit(f"_{filename}.csv")),
    ]
    if external:
        names = [*names, F.concat(F.lit("latest_external_SP"), provider, F.lit(f"_{filename}.csv"))]
    base = "/".join(p for p in (env, "idp", report) if p is not None)
    folder = F.concat(F.lit(f"{base}/"), provider, F.lit(f"/{cadence}/"), period, F.lit("/"))
    return df.select(
        key, F.lit(external).alias("is_external"), folder.alias("folder"), F.explode(F.array(*names)).alias("file")
    ).select(key, "is_external", F.concat("folder", "file").alias("path"))


def issuer_mapping_path(env: str | None = None) -> str:
    """Where the mapping of issuers to provider ids goes."""
    return "/".join(p for p in (env, "portal", "issuers_service_provider_id.json") if p is not None)


def partner_document_path(provider: Column, cadence: str, period_date: Column, env: str | None = None) -> Column:
    """Where the JSON document of one provider and period goes."""
    base = "/".join(p for p in (env, "portal") if p is not None)
    return F.concat(F.lit(f"{base}/"), provider.cast("string"), F.lit(f"/{cadence}/"), period_date, F.lit(".json"))
