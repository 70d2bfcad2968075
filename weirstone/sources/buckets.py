"""Encrypted events arrive in 5-minute buckets named ``<prefix>:<ISO time of the bucket>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.dates import bucket_floor
from weirstone.functions.text import part

# Fixed value: prefix of a bucket name.
BUCKET_PREFIX = "fraud-ops-events"


def bucket_name(ts: Column, minutes: int = 5) -> Column:
    """Name of the bucket that an event time falls into."""
    start = F.date_format(bucket_floor(ts, minutes), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat(F.lit(f"{BUCKET_PREFIX}:"), start)


def bucket_events(df: DataFrame, name: str = "bucket_name") -> DataFrame:
    """Add ``partition_dt``, the UTC date in the bucket name."""
    return df.withColumn("partition_dt", part(F.col(name), ":", 2).substr(1, 10).try_cast("date"))


def closed_buckets(df: DataFrame, as_of: Column, name: str = "bucket_name", minutes: int = 5) -> DataFrame:
    """Leave out the bucket that is still being filled at ``as_of`` (ISO names sort by time)."""
    return df.filter(F.col(name) != bucket_name(as_of, minutes))
