"""Aggregates behind the report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.dates import micros
from weirstone.functions.text import is_blank


def distinct_users_by_name(df: DataFrame, name: str, user: str) -> DataFrame:
    """Distinct non-NULL users per event name, in one pass."""
    return df.groupBy(name).agg(F.countDistinct(user).alias("unique_users"))


def distinct_users_in(df: DataFrame, cohorts: Mapping[str, Sequence[str]], name: str, user: str) -> DataFrame:
    """One row with a distinct-user count per cohort, a cohort being a union of event names.

    Users are folded to one row of flags first (combined on the map side), then the flags are
    summed: one shuffle for any number of cohorts, where several ``countDistinct`` would
    multiply the rows.
    """
    wanted = sorted({n for names in cohorts.values() for n in names})
    per_user = (
        df.filter(F.col(name).isin(*wanted) & F.col(user).isNotNull())
        .groupBy(user)
        .agg(*[F.max(F.col(name).isin(*names)).alias(cohort) for cohort, names in cohorts.items()])
    )
    return per_user.agg(*[F.count_if(F.col(cohort)).alias(cohort) for cohort in cohorts])


def cohort_users(df: DataFrame, names: Sequence[str], name: str, user: str) -> DataFrame:
    """Distinct users with one of the events."""
    return df.filter(F.col(name).isin(*names)).select(user).distinct()


def mean_days(start: Column, end: Column) -> Column:
    """Mean of end - start in days, one decimal; NULL if there is no complete pair."""
    return F.round(F.avg(micros(end) - micros(start)) / F.lit(86400e6), 1)


def avg_days(df: DataFrame, start: str, end: str, name: str = "avg_days") -> DataFrame:
    """One row: mean duration and the number of pairs it rests on."""
    pair = F.col(start).isNotNull() & F.col(end).isNotNull()
    return df.agg(mean_days(F.col(start), F.col(end)).alias(name), F.count_if(pair).alias("pairs"))


def metric_text(value: Column) -> Column:
    """Report cell; a mean over nothing is ``n/a``."""
    return F.coalesce(value.cast("string"), F.lit("n/a"))


def bin_label(value: Column, width: int) -> Column:
    low = F.floor(value / width) * width
    return F.concat(low.cast("string"), F.lit("-"), (low + (width - 1)).cast("string"))


def bin_counts(
    df: DataFrame, value: Column, width: int, low: int, high: int, by: Sequence[str] = ()
) -> DataFrame:
    """Histogram over ``low..high`` inclusive; other and NULL values are left out."""
    binned = df.select(*by, value.alias("__value")).filter(F.col("__value").between(low, high))
    start = (F.floor(F.col("__value") / width) * width).cast("int")
    return (
        binned.groupBy(*by, start.alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("user_count"))
        .withColumn("bin", bin_label(F.col("bin_start"), width))
    )


def bin_quality(df: DataFrame, value: Column, low: int, high: int, by: Sequence[str] = ()) -> DataFrame:
    """How many values a histogram leaves out: NULL, and out of range."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(value.isNull()).alias("null_values"),
        F.count_if(~value.between(low, high)).alias("invalid_values"),
    )


def category_counts(df: DataFrame, category: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per upper-cased category; blank ones are skipped."""
    return (
        df.filter(~is_blank(F.col(category)))
        .groupBy(*by, F.upper(category).alias(category))
        .agg(F.count(F.lit(1)).alias("user_count"))
    )


def top_by_priority(df: DataFrame, keys: Sequence[str], value: str, priority: str) -> DataFrame:
    """Value with the highest priority per key; a tie goes to the smaller value."""
    best = F.min(F.struct((-F.col(priority)).alias("p"), F.col(value).alias("v"))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, F.col("best.v").alias(value), (-F.col("best.p")).alias(priority))
