"""Converted users per agreement order, issuer and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirstone.functions.dates import month_key, month_name
from weirstone.functions.text import order_key
from weirstone.operators.dedup import dedup_latest


def covered_orders(
    orders: DataFrame, usages: DataFrame, integrations: DataFrame, gtcs: DataFrame, providers: DataFrame
) -> DataFrame:
    """Orders with the issuers they cover, one row per order, issuer and provider name."""
    return (
        orders.select(F.col("id").alias("order_id"), "order_number", "start_date", "end_date", "iaa_gtc_id")
        .join(usages.select(F.col("iaa_order_id").alias("order_id"), "integration_id"), "order_id")
        .join(integrations.select(F.col("id").alias("integration_id"), "issuer"), "integration_id")
        .join(gtcs.select(F.col("id").alias("iaa_gtc_id"), "gtc_number"), "iaa_gtc_id")
        .join(providers.select("issuer", "friendly_name"), "issuer")
        .select("order_id", "order_number", "gtc_number", "start_date", "end_date", "issuer", "friendly_name")
        .distinct()
    )


def first_upgrades(upgrades: DataFrame) -> DataFrame:
    """The earliest upgrade of each user."""
    known = upgrades.select("user_id", "issuer", "upgraded_at").filter(F.col("user_id").isNotNull())
    return dedup_latest(known, ["user_id"], [F.col("upgraded_at").asc_nulls_last(), F.col("issuer")])


# Order of what happens on one day: months and windows that begin, upgrades at 00:00, windows that
# end with that instant, all other upgrades.
BEGINS, AT_MIDNIGHT, ENDS, LATER = 0, 1, 2, 3
POINTS_PER_SWEEP = 1_000_000


def conversion_counts(upgrades: DataFrame, covered: DataFrame, points_per_sweep: int = POINTS_PER_SWEEP) -> DataFrame:
    """Distinct users by order, issuer and month of upgrade, within the order's dates.

    Every user has one upgrade after ``first_upgrades``, so distinct users are plain counts and
    add up: they are counted per issuer and day, and one ordered pass per issuer turns them into
    running sums. An agreement is two points on that line per month it spans, and a month's count is the
    difference of the sums at its points; no row stands for an order and a day. ``end_date``
    is midnight: on that day only an upgrade at 00:00 exactly still counts.

    Points beyond ``points_per_sweep`` of one issuer are dealt to several passes, each with all of the
    issuer's days.
    """
    day = F.to_date("upgraded_at")
    at_midnight = F.date_trunc("day", F.col("upgraded_at")) == F.col("upgraded_at")
    slot = F.when(at_midnight, AT_MIDNIGHT).otherwise(LATER)
    known = first_upgrades(upgrades).filter(F.col("upgraded_at").isNotNull() & F.col("issuer").isNotNull())
    daily = known.groupBy("issuer", day.alias("day"), slot.alias("slot")).agg(F.count(F.lit(1)).alias("users"))
    points = _points(covered, daily)
    passes = points.groupBy("issuer").agg(F.ceil(F.count(F.lit(1)) / points_per_sweep).cast("int").alias("passes"))
    turn = F.pmod(F.xxhash64("agreement"), F.col("passes")).cast("int")
    asked = points.join(passes, "issuer").withColumn("turn", turn).drop("passes")
    told = daily.join(passes, "issuer").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("passes") - 1))).drop("passes")
    line = Window.partitionBy("issuer", "turn").orderBy("day", "slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = asked.unionByName(told, allowMissingColumns=True).withColumn("so_far", F.sum(F.coalesce("users", F.lit(0))).over(line))
    counted = (
        swept.filter(F.col("agreement").isNotNull())
        .groupBy("agreement", "month")
        .agg(F.sum(F.col("sign") * F.col("so_far")).alias("user_count"))
        .filter("user_count > 0")
    )
    return counted.select("agreement.*", "month", "user_count")


def _points(covered: DataFrame, daily: DataFrame) -> DataFrame:
    """(agreement, issuer, month, sign, day, slot): begin and end of every month that an agreement spans.

    Agreements are cut to the days on which their issuer has upgrades, so one without an end makes no
    more months than there are.
    """
    spans = daily.groupBy("issuer").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    start, end, after = F.to_date("start_date"), F.to_date("end_date"), F.date_add("last_day", 1)
    bounded = (
        covered.select("issuer", F.struct(*covered.columns).alias("agreement"), start.alias("start"), end.alias("end"))
        .join(spans, "issuer")
        .select("issuer", "agreement", F.greatest("start", "first_day").alias("lo"), F.when(F.col("end") > F.col("last_day"), after).otherwise(F.col("end")).alias("hi"), "start", "end")
        .filter((F.col("lo") <= F.col("hi")) & F.col("start").isNotNull())
    )
    months = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("INTERVAL 1 MONTH"))
    by_month = bounded.select("issuer", "agreement", "lo", "hi", F.explode(months).alias("month"))
    following = F.add_months("month", 1)
    begin = F.struct(F.lit(-1).alias("sign"), F.greatest("lo", "month").alias("day"), F.lit(BEGINS).alias("slot"))
    ends_here = F.col("hi") < following
    stop = F.struct(F.lit(1).alias("sign"), F.least("hi", following).alias("day"), F.when(ends_here, ENDS).otherwise(BEGINS).alias("slot"))
    return by_month.select("issuer", "agreement", "month", F.inline(F.array(begin, stop)))


def conversion_report(upgrades: DataFrame, covered: DataFrame) -> DataFrame:
    """Report rows; sort by ``order_id`` and ``year_month`` at the sink."""
    return conversion_counts(upgrades, covered).select(
        "order_id",
        order_key(F.col("gtc_number"), F.col("order_number")).alias("iaa_order_number"),
        F.date_format("start_date", "yyyy-MM-dd").alias("iaa_start_date"),
        F.date_format("end_date", "yyyy-MM-dd").alias("iaa_end_date"),
        "issuer",
        "friendly_name",
        month_key(F.col("month")).alias("year_month"),
        month_name(F.col("month")).alias("year_month_readable"),
        "user_count",
    )
