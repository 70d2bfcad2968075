"""Checks on the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import Tables, query, sql_stamp, stamp
from weirstone.operators import quality
from weirstone.operators.pii import PII_LITERALS, count_findings, literal_patterns, scan_literals, scan_pii
from weirstone.session import fresh_dir
from weirstone.sources.partitions import day_folders

AS_OF = dt.datetime(2024, 1, 31, 12)


@query(f"""
    SELECT 'late' AS run, {sql_stamp("max(ts)")} AS latest,
           round((epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9, 2) AS freshness_hours,
           CASE WHEN max(ts) > TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 31 HOURS THEN 'within_range' ELSE 'out_of_range' END AS status
    FROM events
    UNION ALL
    SELECT 'early', {sql_stamp("max(ts)")}, round((epoch_us(TIMESTAMP '2024-01-31 01:00:00') - epoch_us(max(ts))) / 3.6e9, 2),
           CASE WHEN max(ts) > TIMESTAMP '2024-01-31 01:00:00' - INTERVAL 31 HOURS THEN 'within_range' ELSE 'out_of_range' END
    FROM events
    UNION ALL SELECT 'empty', NULL, NULL, 'error'
""")
def freshness_status(t: Tables) -> DataFrame:
    runs = {
        "late": (t.events, dt.datetime(2024, 2, 1, 12)),
        "early": (t.events, dt.datetime(2024, 1, 31, 1)),
        "empty": (t.events.filter("event_type = 'none'"), AS_OF),
    }
    parts = [quality.freshness(df, "ts", as_of).select(F.lit(run).alias("run"), "*") for run, (df, as_of) in runs.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("latest", stamp("latest"))


@query(f"""
    SELECT {sql_stamp("max(ts)")} AS latest, round((epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9, 2) AS freshness_hours,
           CASE WHEN max(ts) > TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 31 HOURS THEN 'within_range' ELSE 'out_of_range' END AS status
    FROM events
""")
def freshness_of_newest_day(t: Tables) -> DataFrame:
    """Of a table by day only the newest day is read."""
    path = fresh_dir(t.spark, "by-day")
    t.events.select("ts", F.to_date("ts").alias("day")).repartition("day").write.partitionBy("day").parquet(path)
    table = t.spark.read.parquet(path)
    found = quality.freshness_of_days(table, day_folders(t.spark, path, "day"), "day", "ts", dt.datetime(2024, 2, 1, 12))
    return found.withColumn("latest", stamp("latest"))


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_line_items(t: Tables) -> DataFrame:
    return quality.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


EMAIL = r"[A-Za-z0-9._-]@[A-Za-z0-9-]+\.[A-Za-z]"
PHONE = r"\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}"


@query(f"""
    SELECT doc_id, 'email' AS pattern FROM documents WHERE regexp_matches(text, '{EMAIL}', 'i')
    UNION ALL
    SELECT doc_id, 'phone' FROM documents WHERE regexp_matches(text, '{PHONE}', 'i')
    UNION ALL
    SELECT doc_id, 'license' FROM documents WHERE regexp_matches(text, 'mit license\\.', 'i')
""")
def pii_in_documents(t: Tables) -> DataFrame:
    patterns = {"email": EMAIL, "phone": PHONE} | literal_patterns({"license": "MIT License."})
    return scan_pii(t.documents, "text", patterns, ["doc_id"])


@query("""
    SELECT pattern, count(*) AS findings FROM (
        SELECT UNNEST([CASE WHEN lower(text) LIKE '%the%' THEN 'name1' END, CASE WHEN lower(text) LIKE '%en en%' THEN 'name2' END,
                       CASE WHEN lower(text) LIKE '%314-555-1212%' THEN 'phone_number' END]) AS pattern
        FROM conversations
    ) WHERE pattern IS NOT NULL GROUP BY 1
""")
def literals_in_conversations(t: Tables) -> DataFrame:
    literals = {"phone_number": PII_LITERALS["phone_number"], "name1": "The", "name2": "EN en"}
    return count_findings(scan_literals(t.conversations, "text", ["conv_id", "turn"], literals))


@query("""
    SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M') AS starttime,
           strftime(l_shipdate + INTERVAL 90 SECOND, '%Y-%m-%d %H:%M') AS endtime, l_quantity AS line_count
    FROM lineitem WHERE l_quantity > 45 AND l_shipdate > TIMESTAMP '2001-06-30 23:55:00'
""")
def large_exports(t: Tables) -> DataFrame:
    exports = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("start_time"),
        (F.col("l_shipdate") + F.expr("INTERVAL 90 SECOND")).alias("end_time"), F.col("l_quantity").alias("line_count"),
    )
    return quality.large_exports(exports, dt.datetime(2001, 7, 1, 0, 0, 30), lines=45)


def logins(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(F.lit(" user-"), "user_id").alias("user_name"), F.col("event_type").alias("event"), F.col("ts").alias("record_time")
    )


@query("""
    SELECT DISTINCT 'user-' || user_id AS detected_user FROM events
    WHERE event_type = 'signup' AND user_id IN (3, 5, 8, 13, 21, 34) AND ts >= TIMESTAMP '2024-01-30 12:00:00'
""")
def watched_logins(t: Tables) -> DataFrame:
    users = [f" user-{n}" for n in (3, 5, 8, 13, 21, 34)]
    return quality.watched_logins(logins(t), dt.datetime(2024, 1, 31), users, minutes=12 * 60, event="signup")


SQL_LOGIN_WINDOWS = f"""
    SELECT {sql_stamp("w")} AS window_start, {sql_stamp("w + INTERVAL 15 MINUTES")} AS window_end, user_name, count(*) AS logins
    FROM (
        SELECT ' user-' || user_id AS user_name, UNNEST(generate_series(
            time_bucket(INTERVAL '5 minutes', ts) - INTERVAL '10 minutes', time_bucket(INTERVAL '5 minutes', ts), INTERVAL '5 minutes')) AS w
        FROM events WHERE event_type = 'signup'
    ) {{where}} GROUP BY 1, 2, 3
"""


@query(SQL_LOGIN_WINDOWS.format(where=""))
def watched_login_windows(t: Tables) -> DataFrame:
    windows = quality.watched_login_windows(logins(t).filter("event = 'signup'"), None)
    return windows.withColumns({c: stamp(c) for c in ("window_start", "window_end")})


@query("""
    SELECT 'IAM:' || c_name AS user_name FROM customer WHERE c_nationkey NOT IN (1, 2, 3)
    EXCEPT SELECT 'IAM:' || c_name FROM customer WHERE c_acctbal < 0
""")
def unexpected_users(t: Tables) -> DataFrame:
    """Users of nations 1 to 3 are system accounts; those with a negative balance are allowed."""
    name = (
        F.when(F.col("c_nationkey") == 1, "rdsadmin")
        .when(F.col("c_nationkey") == 2, "IAMR:dev_db_consumption")
        .when(F.col("c_nationkey") == 3, "postgres")
        .otherwise(F.concat(F.lit("IAM:"), "c_name"))
    )
    allowed = t.customer.filter("c_acctbal < 0").select(F.col("c_name").alias("user_name"))
    return quality.unexpected_users(t.customer.select(name.alias("user_name")), allowed, env="dev")


@query("SELECT c_custkey, c_mktsegment || '_PRO' AS role FROM customer WHERE c_acctbal > 5000")
def costly_roles(t: Tables) -> DataFrame:
    suffix = F.when(F.col("c_acctbal") > 5000, "_PRO").otherwise("_pro")
    return quality.costly_roles(t.customer.select("c_custkey", F.concat("c_mktsegment", suffix).alias("role")))


@query("SELECT DISTINCT l_suppkey AS service_provider_id FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def unmapped_providers(t: Tables) -> DataFrame:
    reports = t.lineitem.select(F.col("l_suppkey").alias("service_provider_id")).distinct()
    mapping = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"))
    return quality.unmapped_providers(reports, mapping)


@query("""
    SELECT 'orders' AS table_name, count(*) AS total_rows, 0 AS null_rows, 0 AS duplicate_keys, TRUE AS is_valid FROM orders
    UNION ALL
    SELECT 'lineitem', count(*), count(*) FILTER (l_returnflag = 'N'),
           (SELECT count(*) FROM (SELECT 1 FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), FALSE
    FROM lineitem
""")
def primary_keys(t: Tables) -> DataFrame:
    line = t.lineitem.select(F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber")
    checks = [
        quality.check_primary_key(t.orders, ["o_orderkey"]).select(F.lit("orders").alias("table_name"), "*"),
        quality.check_primary_key(line, ["l_orderkey", "l_linenumber"]).select(F.lit("lineitem").alias("table_name"), "*"),
    ]
    return checks[0].unionByName(checks[1])


@query("""
    SELECT l_orderkey, count(*) AS row_count FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1
""")
def foreign_keys(t: Tables) -> DataFrame:
    """Line items whose order is not among the orders that are done or open."""
    return quality.check_foreign_key(t.lineitem, "l_orderkey", t.orders.filter("o_orderstatus <> 'P'"), "o_orderkey")


@query("""
    SELECT 'orders' AS gate, (SELECT count(*) = 0 FROM orders) AS closed
    UNION ALL SELECT 'events of a kind that does not occur', (SELECT count(*) = 0 FROM events WHERE event_type = 'none')
    UNION ALL SELECT 'negative balances', (SELECT count(*) = 0 FROM customer WHERE c_acctbal < 0)
""")
def job_gates(t: Tables) -> DataFrame:
    """Whether a job has nothing to do; each look stops at the first row."""
    gates = {"orders": t.orders, "events of a kind that does not occur": t.events.filter("event_type = 'none'"), "negative balances": t.customer.filter("c_acctbal < 0")}
    cells = [F.struct(F.lit(name).alias("gate"), F.lit(quality.is_empty(df)).alias("closed")) for name, df in gates.items()]
    return t.spark.range(1).select(F.inline(F.array(*cells)))
