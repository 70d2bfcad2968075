"""Reports as the objects that partners and the portal fetch, under their names.

Each function gives lines (path, position, tie, line) for ``sources.named_files.write_objects``; reports of
all providers go out in one job. What cannot be delivered comes out as a status, not as an error of
the others' reports.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.plans import demographics
from weirstone.plans.fraud import METRICS
from weirstone.sources.sinks import issuer_mapping_path, partner_document_path, provider_files, report_path

# Names and header rows of the report files.
DEMOGRAPHICS_REPORT = "DemographicsMetricsReport"
FRAUD_REPORT = "fraud-metrics-report"
HEADERS = {
    "definitions": ["Metric", "Unit", "Definition"],
    "age_metrics": ["Age Range", "User Count"],
    "state_metrics": ["State", "User Count"],
}
FRAUD_HEADER = ["Metric", "Total", "Range Start", "Range End"]

LINE = ("path", "position", "tie", "line")


def csv_line(*cells: Column) -> Column:
    """Cells as one line of CSV: quoted where needed, quotes doubled, NULL empty."""
    row = F.struct(*[c.cast("string").alias(f"c{n}") for n, c in enumerate(cells)])
    return F.to_csv(row, {"escape": '"', "emptyValue": ""})


def header_line(names: Sequence[str]) -> Column:
    return csv_line(*map(F.lit, names))


def deliverable(issuers: DataFrame, mapping: DataFrame) -> DataFrame:
    """(issuer, service_provider_id, status) of every issuer to report on.

    ``status`` is ok, ``missing_id`` without a provider, or ``shared_id`` for all but the first issuer of a provider,
    whose files would replace each other.
    """
    listed = issuers.select("issuer").distinct().join(mapping.select("issuer", F.col("id").alias("service_provider_id")), "issuer", "left")
    first = F.min("issuer").over(Window.partitionBy("service_provider_id"))
    status = F.when(F.col("service_provider_id").isNull(), "missing_id").when(F.col("issuer") != first, "shared_id").otherwise("ok")
    return listed.withColumn("status", status)


def demographic_lines(
    tables: DataFrame, recipients: DataFrame, start: dt.datetime, next_start: dt.datetime, as_of: dt.date, env: str | None = None
) -> DataFrame:
    """Lines of the four files of each provider, under two names, or three once the quarter has ended.

    ``tables`` are the rows of ``demographic_tables``; both inputs are used several times and best
    staged. Each issuer gets all files; without users the counts have their header only.
    """
    ok = recipients.filter(F.col("status") == "ok").select("issuer", "service_provider_id")
    parts = [_counts(ok, tables, "age_metrics"), _counts(ok, tables, "state_metrics"), _definitions(ok), _overview(ok, start, next_start, as_of)]
    lines = reduce(DataFrame.unionByName, parts)
    end, label = (next_start - dt.timedelta(days=1)).date(), demographics.period_label(next_start)
    names = [
        provider_files(ok.select("service_provider_id"), name, end, as_of, DEMOGRAPHICS_REPORT, label, env).withColumn("file", F.lit(name))
        for name in ("definitions", "overview", "age_metrics", "state_metrics")
    ]
    paths = reduce(DataFrame.unionByName, names).select("service_provider_id", "file", "path")
    return lines.join(paths, ["service_provider_id", "file"]).select(*LINE)


def _headed(ok: DataFrame, name: str) -> DataFrame:
    return ok.select("service_provider_id", F.lit(name).alias("file"), F.lit(0).alias("position"), F.lit("").alias("tie"), header_line(HEADERS[name]).alias("line"))


def _counts(ok: DataFrame, tables: DataFrame, name: str) -> DataFrame:
    rows = tables.filter(F.col("table_name") == name).join(ok, "issuer")
    line = csv_line(F.col("label"), F.col("user_count"))
    counted = rows.select("service_provider_id", F.lit(name).alias("file"), (F.col("sort_key") + 1).alias("position"), F.col("label").alias("tie"), line.alias("line"))
    return _headed(ok, name).unionByName(counted)


def _definitions(ok: DataFrame) -> DataFrame:
    cells = F.array(*[csv_line(*map(F.lit, row)) for row in demographics.DEFINITIONS])
    rows = ok.select("service_provider_id", F.lit("definitions").alias("file"), F.posexplode(cells).alias("position", "line"))
    return _headed(ok, "definitions").unionByName(rows.withColumn("position", F.col("position") + 1).withColumn("tie", F.lit("")))


def _overview(ok: DataFrame, start: dt.datetime, next_start: dt.datetime, as_of: dt.date) -> DataFrame:
    rows = demographics.overview_table(ok, start, next_start, as_of).join(ok, "issuer")
    order = F.when(F.col("line") == "Report Timeframe", 0).when(F.col("line") == "Report Generated", 1).otherwise(2)
    return rows.select("service_provider_id", F.lit("overview").alias("file"), order.alias("position"), F.lit("").alias("tie"), csv_line(F.col("line"), F.col("value")).alias("line"))


def fraud_lines(rows: DataFrame, now: dt.date, env: str | None = None, directory: str = "idp") -> DataFrame:
    """Lines of the three files of the fraud report, each under its latest and its dated name."""
    order = {label: n for n, label in enumerate(METRICS, 1)}
    position = F.lit(0)
    for label, n in order.items():
        position = F.when(F.col("Metric") == label, n).otherwise(position)
    body = rows.select("report", position.alias("position"), csv_line(*map(F.col, FRAUD_HEADER)).alias("line"))
    heads = rows.select("report").distinct().select("report", F.lit(0).alias("position"), header_line(FRAUD_HEADER).alias("line"))
    paths = F.lit(None).cast("array<string>")
    for report in sorted({file for file, _ in METRICS.values()}):
        latest, dated = report_path(FRAUD_REPORT, "csv", now, env, directory, report)
        paths = F.when(F.col("report") == report, F.array(F.lit(latest), F.lit(dated))).otherwise(paths)
    return heads.unionByName(body).select(F.explode(paths).alias("path"), "position", F.lit("").alias("tie"), "line")


def partner_lines(documents: DataFrame, cadence: str, env: str | None = None) -> DataFrame:
    """One object per provider with its document of the period."""
    path = partner_document_path(F.col("service_provider_id"), cadence, F.col("period_date_actual").cast("string"), env)
    return documents.select(path.alias("path"), F.lit(0).alias("position"), F.lit("").alias("tie"), F.col("document").alias("line"))


def mapping_lines(mapping: DataFrame, env: str | None = None) -> DataFrame:
    """The mapping of issuers to provider ids as one JSON object, an issuer per line in order."""
    listed = mapping.select(F.lit(issuer_mapping_path(env)).alias("path"), F.col("issuer").alias("tie"), "id")
    # one object is written by one task anyway; it gets here in the same shuffle
    by_path = Window.partitionBy("path").orderBy("tie")
    text = F.to_json(F.create_map("tie", F.struct("id")))
    entry = F.concat(F.when(F.row_number().over(by_path) == 1, "").otherwise(","), F.substring(text, F.lit(2), F.length(text) - 2))
    entries = listed.select("path", F.lit(1).alias("position"), "tie", entry.alias("line"))
    ends = mapping.sparkSession.range(1).select(
        F.lit(issuer_mapping_path(env)).alias("path"), F.inline(F.array(*[F.struct(F.lit(p).alias("position"), F.lit("").alias("tie"), F.lit(b).alias("line")) for p, b in ((0, "{"), (2, "}"))]))
    )
    return entries.unionByName(ends.select(*LINE))
