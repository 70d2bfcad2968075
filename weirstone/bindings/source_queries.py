"""Sources and sinks on the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import Tables, query, sql_stamp, stamp
from weirstone.bindings.report_inputs import SQL_FRAUD_ROWS, fraud_inputs
from weirstone.functions.dates import instant, quarter_label
from weirstone.plans.fraud import COUNTS, METRICS, fraud_metrics
from weirstone.session import fresh_dir
from weirstone.sources.buckets import bucket_events, bucket_name, closed_buckets
from weirstone.sources.metrics_csv import read_metrics
from weirstone.sources.sinks import (
    partner_document_path,
    provider_files,
    report_path,
    rows_as_json,
    write_documents,
    write_report,
)

SQL_BUCKET = "'fraud-ops-events:' || strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%dT%H:%M:%SZ')"


@query("SELECT o_orderkey, o_totalprice FROM orders")
def table_scan(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice")


@query(f"""
    SELECT event_id, {SQL_BUCKET} AS bucket_name,
           strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d') AS partition_dt
    FROM events
    WHERE {SQL_BUCKET} <> 'fraud-ops-events:2024-01-15T12:00:00Z'
""")
def bucket_partitions(t: Tables) -> DataFrame:
    named = t.events.select("event_id", bucket_name(F.col("ts")).alias("bucket_name"))
    as_of = instant(dt.datetime(2024, 1, 15, 12, 3, 30))
    dated = bucket_events(closed_buckets(named, as_of))
    return dated.withColumn("partition_dt", F.col("partition_dt").cast("string"))


@query("""
    SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey ||
           ',"note":null}' AS document
    FROM supplier
""")
def json_rows(t: Tables) -> DataFrame:
    return rows_as_json(t.supplier.select("s_suppkey", "s_name", "s_nationkey", F.lit(None).cast("string").alias("note")))


@query("""
    SELECT s_suppkey AS service_provider_id, TRUE AS is_external,
           'idp/DemographicsMetricsReport/' || s_suppkey || '/quarterly/Q12024/' || f AS path
    FROM supplier, LATERAL (SELECT UNNEST([
        'SP' || s_suppkey || '_20240402_external_age_metrics.csv',
        'latest_SP' || s_suppkey || '_age_metrics.csv',
        'latest_external_SP' || s_suppkey || '_age_metrics.csv']) AS f)
""")
def report_files(t: Tables) -> DataFrame:
    end = dt.date(2024, 3, 31)
    providers = t.supplier.select(F.col("s_suppkey").alias("service_provider_id"))
    label = quarter_label(F.lit(end))
    return provider_files(providers, "age_metrics", end, dt.date(2024, 4, 2), "DemographicsMetricsReport", label)


@query("""
    SELECT s_suppkey AS service_provider_id,
           'portal/' || s_suppkey || '/monthly/2024-03-01.json' AS path,
           'idp/fraud-metrics-report/2024/2024-03-31.fraud-metrics-report/lg99_metrics.csv' AS dated,
           'idp/fraud-metrics-report/latest.fraud-metrics-report/lg99_metrics.csv' AS latest
    FROM supplier
""")
def document_paths(t: Tables) -> DataFrame:
    latest, dated = report_path(
        "fraud-metrics-report", "csv", dt.date(2024, 3, 31), directory="idp", subname="lg99_metrics"
    )
    path = partner_document_path(F.col("s_suppkey"), "monthly", F.lit("2024-03-01"))
    return t.supplier.select(
        F.col("s_suppkey").alias("service_provider_id"),
        path.alias("path"),
        F.lit(dated).alias("dated"),
        F.lit(latest).alias("latest"),
    )


@query("""
    SELECT s_nationkey AS service_provider_id, s_name AS name, s_suppkey AS number FROM supplier
""")
def json_documents(t: Tables) -> DataFrame:
    """Written by provider, read back with the provider from the folder name."""
    path = fresh_dir(t.spark, "documents")
    rows = t.supplier.select(
        F.col("s_nationkey").alias("service_provider_id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("number")
    )
    write_documents(rows, path)
    return t.spark.read.schema("name string, number bigint, service_provider_id int").json(path)


@query(f"""
    SELECT o_orderstatus, {sql_stamp("max(o_orderdate)")} AS latest_order, CAST(count(*) AS BIGINT) AS orders
    FROM orders GROUP BY o_orderstatus
""")
def report_csv(t: Tables) -> DataFrame:
    """Aggregated, written as CSV with a header, read back."""
    path = fresh_dir(t.spark, "report")
    table = t.orders.groupBy("o_orderstatus").agg(
        stamp(F.max("o_orderdate")).alias("latest_order"), F.count(F.lit(1)).alias("orders")
    )
    write_report(table.orderBy("o_orderstatus"), path)
    return t.spark.read.schema("o_orderstatus string, latest_order string, orders bigint").option("header", True).csv(path)


def sql_metric(label: str, column: str) -> str:
    kind = "BIGINT" if label in COUNTS else "DOUBLE"
    return f"""max(CASE WHEN "Metric" = '{label}' THEN TRY_CAST("Total" AS {kind}) END) AS {column}"""


@query(f"""
    WITH {SQL_FRAUD_ROWS}
    SELECT {", ".join(sql_metric(label, column) for label, (_, column) in METRICS.items())},
           '2024-01-01 00:00:00.000000' AS range_start, '2024-01-31 23:59:59.000000' AS range_end
    FROM r
""")
def metrics_readback(t: Tables) -> DataFrame:
    """The fraud tables written as three CSV files, then read back into one row."""
    path = fresh_dir(t.spark, "metrics")
    rows = fraud_metrics(*fraud_inputs(t), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    rows.write.partitionBy("report").option("header", True).csv(path)
    names = {label: column for label, (_, column) in METRICS.items()}
    row = read_metrics(t.spark, [f"{path}/report={r}" for r, _ in sorted(set(METRICS.values()))], names, COUNTS)
    return row.withColumns({c: stamp(c) for c in ("range_start", "range_end")})
