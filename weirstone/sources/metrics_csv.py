"""Read metric tables back from their CSV files into one typed row."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_CSV_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("Metric", "Total", "Range Start", "Range End")]
)

NOT_AVAILABLE = "n/a"


def read_metrics(spark: SparkSession, paths: list[str], names: Mapping[str, str], counts: Collection[str] = ()) -> DataFrame:
    """One row with a column per metric, plus ``range_start`` and ``range_end``.

    ``names`` maps the metric label to the output column. Labels in ``counts`` are whole numbers, all
    others doubles. ``n/a`` and other text become NULL; a label that no file holds fails the job.
    """
    rows = spark.read.schema(METRIC_CSV_SCHEMA).option("header", True).csv(paths)
    return metrics_row(rows, names, counts)


def metrics_row(rows: DataFrame, names: Mapping[str, str], counts: Collection[str] = ()) -> DataFrame:
    """As ``read_metrics`` for rows that are already loaded."""
    metric = F.col("Metric")
    found = {label: F.max(metric == label) for label in names}
    totals = [_checked(label, found[label], "bigint" if label in counts else "double").alias(column) for label, column in names.items()]
    return rows.filter(metric != "Metric").agg(
        *totals,
        F.min(F.col("Range Start").try_cast("timestamp")).alias("range_start"),
        F.max(F.col("Range End").try_cast("timestamp")).alias("range_end"),
    )


def _checked(label: str, found: Column, kind: str) -> Column:
    number = F.max(F.when(F.col("Metric") == label, F.col("Total").try_cast(kind)))
    missing = F.raise_error(F.lit(f"Metric '{label}' not found in CSV data")).cast(kind)
    return F.when(F.coalesce(found, F.lit(False)), number).otherwise(missing)
