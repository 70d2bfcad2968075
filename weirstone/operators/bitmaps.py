"""Exact distinct users of any period from stored days.

Users get dense numbers once, in a dictionary that only grows. A day's users of an issuer and event
are bitmaps over these numbers: a row per 32,768 numbers that occur. Bitmaps of any days, issuers or
events are merged by OR and counted, so a period is counted without its events, and a day that
comes in parts is simply more rows.

NULL users are not counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.sources.tables import staged

SLICES = 4096  # of new users, numbered side by side


def number_users(users: DataFrame, dictionary: str, user: str, staging: str) -> DataFrame:
    """Give numbers to the users that the dictionary (a folder) does not have; returns it.

    New users are dealt by hash, numbered within their slice and shifted by the slices before, so
    that no task orders them all and numbers stay dense. ``staging`` is a new folder in shared storage.
    One run at a time.
    """
    spark = users.sparkSession
    kind = users.schema[user].dataType
    known = read_dictionary(spark, dictionary, kind)
    fresh = users.select(F.col(user).alias("user_id")).filter(F.col("user_id").isNotNull()).distinct()
    fresh = fresh.join(known.select("user_id"), "user_id", "left_anti")
    sliced = staged(fresh.withColumn("slice", F.pmod(F.xxhash64("user_id"), F.lit(SLICES)).cast("int")), f"{staging}/fresh")
    sizes = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("size"))  # one row per slice
    before = F.coalesce(F.sum("size").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = known.agg(F.max("number")).first()[0]
    start = 1 if last is None else last + 1  # bitmaps begin at one
    place = F.row_number().over(Window.partitionBy("slice").orderBy("user_id")) - 1
    numbered = sliced.withColumn("place", place).join(sizes.select("slice", before.alias("before")), "slice")
    rows = numbered.select("user_id", (F.col("before") + F.col("place") + start).alias("number"))
    rows.write.mode("append").parquet(dictionary)
    return read_dictionary(spark, dictionary, kind)


def read_dictionary(spark: SparkSession, dictionary: str, kind: T.DataType = T.LongType()) -> DataFrame:
    schema = T.StructType([T.StructField("user_id", kind), T.StructField("number", T.LongType())])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(dictionary)
    return spark.read.schema(schema).parquet(dictionary)


def user_bitmaps(events: DataFrame, dictionary: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """(keys, bucket, users): the bitmaps of the users of each group, one row per bucket of numbers."""
    seen = events.select(*keys, F.col(user).alias("user_id")).filter(F.col("user_id").isNotNull()).distinct()
    numbered = seen.join(dictionary, "user_id").select(*keys, "number")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return numbered.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def merged(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups: of any period, of all issuers, of a union of events."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(bitmaps: DataFrame, keys: Sequence[str], name: str = "unique_users") -> DataFrame:
    """(keys, unique users), exact."""
    return merged(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias(name))


def in_both(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str = "unique_users") -> DataFrame:
    """(keys, users in both): what two cohorts share, from |A| + |B| - |A or B| of each bucket."""
    sides = [merged(df, keys).withColumn("side", F.lit(side)) for side, df in enumerate((left, right))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys, "bucket").agg(F.sum(F.bitmap_count("users")).alias("each"), F.bitmap_or_agg("users").alias("any"))
    shared = F.sum(F.col("each") - F.bitmap_count("any")).alias(name)
    return both.groupBy(*keys).agg(shared).filter(F.col(name) > 0)
