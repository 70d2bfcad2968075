"""Raw log rows: ``message`` as JSON text plus the time the log service received it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW_LOG_SCHEMA = T.StructType(
    [
        T.StructField("message", T.StringType()),
        T.StructField("cloudwatch_timestamp", T.TimestampType()),
    ]
)


def read_raw_logs(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(RAW_LOG_SCHEMA).format(file_format).load(path)


def stream_raw_logs(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """File stream of raw rows; the checkpoint of the query replaces draining a staging table."""
    reader = spark.readStream.schema(RAW_LOG_SCHEMA).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
