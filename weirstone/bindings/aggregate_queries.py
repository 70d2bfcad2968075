"""Aggregations, joins, windows and set operations on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import Tables, query, sql_stamp, stamp
from weirstone.operators import bitmaps, metrics
from weirstone.operators.dedup import dedup_latest
from weirstone.operators.reconcile import in_both, only_in
from weirstone.session import fresh_dir


@query(f"""
    SELECT event_id, user_id, event_type, {sql_stamp("ts")} AS ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest_event(t: Tables) -> DataFrame:
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    latest = dedup_latest(t.events, ["user_id", "event_type"], order)
    return latest.select("event_id", "user_id", "event_type", stamp("ts").alias("ts"), "value")


@query(f"""
    SELECT o_custkey, o_orderkey, {sql_stamp("o_orderdate")} AS o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_order_per_customer(t: Tables) -> DataFrame:
    first = dedup_latest(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.select("o_custkey", "o_orderkey", stamp("o_orderdate").alias("o_orderdate"))


@query("SELECT event_type, count(DISTINCT user_id) AS unique_users FROM events GROUP BY event_type")
def users_per_event(t: Tables) -> DataFrame:
    return metrics.distinct_users_by_name(t.events, "event_type", "user_id")


def stored_days(t: Tables) -> DataFrame:
    """Bitmaps per day, issuer and event, loaded in two parts that share their days; issuers are the hundreds of the value."""
    work = fresh_dir(t.spark, "bitmaps")
    keys = ["day", "issuer", "event_type"]
    for part in range(2):
        events = t.events.filter(F.col("event_id") % 2 == part).select(
            F.to_date("ts").alias("day"), F.floor(F.col("value") / 100).alias("issuer"), "event_type", F.when(F.col("event_type") != "view", F.col("user_id")).otherwise(F.col("user_id") % 50).alias("user_id")
        )
        dictionary = bitmaps.number_users(events, f"{work}/dictionary", "user_id", f"{work}/staging{part}")
        bitmaps.user_bitmaps(events, dictionary, keys, "user_id").write.mode("append").parquet(f"{work}/days")
    return t.spark.read.parquet(f"{work}/days")


SQL_SEEN = "seen AS (SELECT *, CASE WHEN event_type <> 'view' THEN user_id ELSE user_id % 50 END AS u, CAST(floor(value / 100) AS BIGINT) AS issuer FROM events)"


@query(f"WITH {SQL_SEEN} SELECT event_type, count(DISTINCT u) AS unique_users FROM seen WHERE ts < TIMESTAMP '2024-01-20' GROUP BY event_type")
def users_per_event_from_bitmaps(t: Tables) -> DataFrame:
    """Distinct users of a period from its stored days; the events are not read again."""
    days = stored_days(t).filter(F.col("day") < F.lit("2024-01-20").cast("date"))
    return bitmaps.distinct_users(days, ["event_type"])


@query(f"""
    WITH {SQL_SEEN}, a AS (SELECT DISTINCT issuer, u FROM seen WHERE event_type = 'signup'), b AS (SELECT DISTINCT issuer, u FROM seen WHERE event_type IN ('purchase', 'view'))
    SELECT issuer, count(*) AS unique_users FROM a JOIN b USING (issuer, u) GROUP BY issuer
""")
def users_in_both_from_bitmaps(t: Tables) -> DataFrame:
    """Users of an issuer with a sign-up and with a purchase or view, whenever."""
    days = stored_days(t)
    return bitmaps.in_both(days.filter("event_type = 'signup'"), days.filter("event_type in ('purchase', 'view')"), ["issuer"])


@query("""
    SELECT count(DISTINCT CASE WHEN event_type IN ('error', 'view') THEN user_id END) AS error_or_view,
           count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchase
    FROM events
""")
def users_in_cohorts(t: Tables) -> DataFrame:
    return metrics.distinct_users_in(
        t.events, {"error_or_view": ("error", "view"), "purchase": ("purchase",)}, "event_type", "user_id"
    )


@query("""
    SELECT round(avg(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400e6, 1) AS avg_days, count(*) AS pairs
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')
""")
def avg_days_cohort(t: Tables) -> DataFrame:
    """Order to ship time for customers that are in an event cohort."""
    cohort = metrics.cohort_users(t.events, ["purchase"], "event_type", "user_id")
    orders = t.orders.join(cohort, F.col("o_custkey") == F.col("user_id"), "left_semi").select("o_orderkey", "o_orderdate")
    pairs = t.lineitem.select("l_orderkey", "l_shipdate").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return metrics.avg_days(pairs, "o_orderdate", "l_shipdate")


@query("""
    SELECT c_mktsegment, low AS bin_start, count(*) AS user_count, low || '-' || (low + 499) AS bin
    FROM (SELECT c_mktsegment, CAST(floor(c_acctbal / 500) * 500 AS INTEGER) AS low FROM customer WHERE c_acctbal BETWEEN 0 AND 9000)
    GROUP BY ALL
""")
def balance_bins(t: Tables) -> DataFrame:
    return metrics.bin_counts(t.customer, F.col("c_acctbal"), 500, 0, 9000, ["c_mktsegment"])


@query("""
    SELECT c_mktsegment, count(*) AS total_records, count(*) FILTER (c_acctbal > 9500) AS null_values,
           count(*) FILTER (c_acctbal <= 9500 AND c_acctbal NOT BETWEEN 0 AND 9000) AS invalid_values
    FROM customer GROUP BY 1
""")
def balance_bin_quality(t: Tables) -> DataFrame:
    value = F.when(F.col("c_acctbal") <= 9500, F.col("c_acctbal"))
    return metrics.bin_quality(t.customer, value, 0, 9000, ["c_mktsegment"])


@query("""
    SELECT upper(c_mktsegment) AS c_mktsegment, count(*) AS user_count FROM customer
    WHERE c_mktsegment <> 'BUILDING' GROUP BY 1
""")
def segment_counts(t: Tables) -> DataFrame:
    """Lower-cased segments; those of one segment are blank and skipped."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.lower("c_mktsegment"))
    return metrics.category_counts(t.customer.select(segment.alias("c_mktsegment")), "c_mktsegment")


@query("""
    WITH r AS (
        SELECT o_custkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END AS p FROM orders
    )
    SELECT o_custkey, arg_max(o_orderstatus, p) AS role, max(p) AS priority FROM r GROUP BY o_custkey
""")
def top_status(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    priority = F.when(status == "F", 3).when(status == "O", 2).otherwise(1)
    rows = t.orders.select("o_custkey", status.alias("role"), priority.alias("priority"))
    return metrics.top_by_priority(rows, ["o_custkey"], "role", "priority")


@query("""
    SELECT n_name, r_name, date_part('year', o_orderdate)::INTEGER AS order_year, count(DISTINCT o_custkey) AS customers
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3
""")
def customers_by_dimension(t: Tables) -> DataFrame:
    """Chained inner joins to dimensions; joined after the distinct keys are counted out."""
    yearly = t.orders.select("o_custkey", F.year("o_orderdate").alias("order_year")).distinct()
    return (
        yearly.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("n_name", "r_name", "order_year")
        .agg(F.countDistinct("o_custkey").alias("customers"))
    )


@query("""
    SELECT s_suppkey AS key, 'left' AS side FROM supplier WHERE s_suppkey NOT IN (SELECT user_id FROM events)
    UNION ALL
    SELECT DISTINCT user_id, 'right' FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)
    UNION ALL
    SELECT s_suppkey, 'both' FROM supplier WHERE s_suppkey IN (SELECT user_id FROM events)
""")
def key_sets(t: Tables) -> DataFrame:
    """Difference both ways, and intersection."""
    left = t.supplier.select(F.col("s_suppkey").alias("key"))
    right = t.events.select(F.col("user_id").alias("key"))
    parts = [
        only_in(left, right, ["key"]).withColumn("side", F.lit("left")),
        only_in(right, left, ["key"]).withColumn("side", F.lit("right")),
        in_both(left, right, ["key"]).withColumn("side", F.lit("both")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
    SELECT o_custkey AS user_id FROM orders WHERE o_orderstatus = 'P'
    UNION
    SELECT user_id FROM events WHERE event_type = 'error'
""")
def cohort_union(t: Tables) -> DataFrame:
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("user_id"))
    failing = t.events.filter("event_type = 'error'").select("user_id")
    return pending.unionByName(failing).distinct()
