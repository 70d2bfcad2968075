"""Upserts, log load, table sync, retention and conforming on the sample tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import Tables, query, sql_stamp, stamp
from weirstone.bindings.sample_logs import SQL_EVENT_COLUMNS, raw_events, sql_event_message, sql_other_columns
from weirstone.functions.dates import instant
from weirstone.operators.checksums import changed_rows, reconcile_by_checksum
from weirstone.operators.conform import ColumnSpec, conform, conform_issues, schema_diff, split_pii
from weirstone.operators.extract import EVENT_COLUMNS, extract_columns
from weirstone.operators.logload import load_logs, load_logs_by_day
from weirstone.operators.reconcile import policy_drift, reconcile
from weirstone.operators.retention import apply_retention, plan_retention
from weirstone.operators.tablesync import missing_catalog_columns, record_sync, sync_table
from weirstone.operators.upsert import mark_processed, upsert, upsert_partial
from weirstone.session import fresh_dir
from weirstone.sources.file_rewrite import expire_files, mark_files, read_files, upsert_files, upsert_files_partial
from weirstone.sources.partitions import create_day_table, drop_expired_days, mark_processed_days, merge_days, replace_days

NEW_KEYS = 10_000_000


def reissued_orders(t: Tables) -> DataFrame:
    """Finished orders with a new price, open orders again under a new key."""
    again = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") + NEW_KEYS).otherwise(F.col("o_orderkey"))
    return t.orders.filter("o_orderstatus <> 'P'").withColumns(
        {"o_orderkey": again, "o_totalprice": F.col("o_totalprice") * 2}
    )


SQL_REISSUED = f"""
    updates AS (
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN o_orderkey + {NEW_KEYS} ELSE o_orderkey END AS o_orderkey,
                          o_totalprice * 2 AS o_totalprice)
        FROM orders WHERE o_orderstatus <> 'P'
    )
"""


@query(f"""
    WITH {SQL_REISSUED}, result AS (
        SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
        UNION ALL SELECT * FROM updates
    )
    SELECT * REPLACE ({sql_stamp("o_orderdate")} AS o_orderdate) FROM result
""")
def upsert_orders(t: Tables) -> DataFrame:
    return upsert(t.orders, reissued_orders(t), ["o_orderkey"]).withColumn("o_orderdate", stamp("o_orderdate"))


@query(f"""
    WITH {SQL_REISSUED}
    SELECT COALESCE(t.o_orderkey, u.o_orderkey) AS o_orderkey, COALESCE(t.o_custkey, u.o_custkey) AS o_custkey,
           COALESCE(u.o_totalprice, t.o_totalprice) AS o_totalprice,
           CASE WHEN t.o_orderkey IS NULL THEN '2024-01-01 00:00:00.000000' END AS dw_created_at
    FROM orders t FULL JOIN updates u ON t.o_orderkey = u.o_orderkey
""")
def upsert_partial_orders(t: Tables) -> DataFrame:
    """A match changes the price only; an insert is stamped as well."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    target = t.orders.select(*columns, F.lit(None).cast("timestamp").alias("dw_created_at"))
    updates = reissued_orders(t).select(*columns)
    loaded = {"dw_created_at": instant(dt.datetime(2024, 1, 1))}
    merged = upsert_partial(target, updates, ["o_orderkey"], ["o_totalprice"], loaded)
    return merged.withColumn("dw_created_at", stamp("dw_created_at"))


SPEC = EVENT_COLUMNS

MADE = "id name time log_filename new_event path user_id pid browser_mobile success".split()
SQL_LATE = f"""
    SELECT {sql_event_message("'late'", "value * 2")} AS message, CAST(event_id AS VARCHAR) AS id, 'late' AS name, {sql_stamp("ts")} AS "time",
           'events.log' AS log_filename, TRUE AS new_event, '/late' AS path, CAST(user_id AS VARCHAR) AS user_id, n AS pid,
           value * 2 > 100 AS browser_mobile, TRUE AS success, {sql_stamp("ts + INTERVAL 1 MINUTE")} AS cloudwatch_timestamp,
           {sql_other_columns(SPEC, *MADE)}
    FROM e WHERE n NOT IN (0, 1)
"""
SQL_LOADED = f"""
    e AS (SELECT {SQL_EVENT_COLUMNS}),
    loaded AS ({SQL_LATE})
"""
# Rows of the table before the load: the id and the name alone.
SQL_LOADED_TABLE = f"""
    WITH {SQL_LOADED}
    SELECT * FROM loaded
    UNION ALL BY NAME
    SELECT '{{"id":"x' || event_id || '","name":"other"}}' AS message, 'x' || event_id AS id, 'other' AS name, {sql_stamp("ts")} AS cloudwatch_timestamp FROM e
    UNION ALL BY NAME
    SELECT '{{"id":"' || event_id || '","name":"old"}}' AS message, CAST(event_id AS VARCHAR) AS id, 'old' AS name, {sql_stamp("ts")} AS cloudwatch_timestamp
    FROM e WHERE event_type = 'error' AND n IN (0, 1)
"""


def existing_logs(t: Tables) -> DataFrame:
    """The log table before the load: errors loaded earlier, and rows of another host."""
    old = t.events.filter("event_type = 'error'").select(
        F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.lit("old").alias("name"))).alias("message"),
        F.col("ts").alias("cloudwatch_timestamp"),
    )
    other = t.events.select(
        F.to_json(F.struct(F.concat(F.lit("x"), "event_id").alias("id"), F.lit("other").alias("name"))).alias("message"),
        F.col("ts").alias("cloudwatch_timestamp"),
    )
    return extract_columns(old.unionByName(other), SPEC)


@query(SQL_LOADED_TABLE)
def load_event_logs(t: Tables) -> DataFrame:
    loaded = load_logs(raw_events(t), existing_logs(t), SPEC, "id").target
    return loaded.withColumns({c: stamp(c) for c in ("time", "cloudwatch_timestamp")})


def day_table(t: Tables, rows: DataFrame, day: str) -> str:
    """A new catalogue table partitioned by ``day`` that holds ``rows``."""
    name = f"weirstone_{uuid.uuid4().hex}"
    create_day_table(rows, name, day)
    replace_days(rows, name)
    return name


@query(SQL_LOADED_TABLE)
def load_event_logs_by_day(t: Tables) -> DataFrame:
    """The same load into a table partitioned by day; a message is parsed once."""
    old = existing_logs(t).withColumn("day", F.to_date("cloudwatch_timestamp"))
    table = day_table(t, old, "day")
    load_logs_by_day(raw_events(t), table, SPEC, "id", "day", fresh_dir(t.spark, "load"))
    loaded = t.spark.table(table).drop("day")
    return loaded.withColumns({c: stamp(c) for c in ("time", "cloudwatch_timestamp")})


def orders_by_year(t: Tables, rows: DataFrame) -> DataFrame:
    return rows.withColumn("year", F.trunc("o_orderdate", "year"))


@query(f"""
    WITH {SQL_REISSUED}, result AS (
        SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
        UNION ALL SELECT * FROM updates
    )
    SELECT * REPLACE ({sql_stamp("o_orderdate")} AS o_orderdate) FROM result
""")
def merge_days_orders(t: Tables) -> DataFrame:
    """The upsert of ``upsert_orders``, rewriting only the years that it concerns."""
    table = day_table(t, orders_by_year(t, t.orders), "year")
    merge_days(orders_by_year(t, reissued_orders(t)), table, ["o_orderkey"], "year", fresh_dir(t.spark, "merge"))
    return t.spark.table(table).drop("year").withColumn("o_orderdate", stamp("o_orderdate"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND year(o_orderdate) > 1995 THEN '2024-02-01 00:00:00.000000'
                            WHEN o_orderstatus = 'P' THEN '2020-01-01 00:00:00.000000' END AS dw_processed_at
    FROM orders
""")
def marked_days(t: Tables) -> DataFrame:
    """Open orders after 1995 are marked; pending ones have their mark already and keep it."""
    old = F.when(F.col("o_orderstatus") == "P", instant(dt.datetime(2020, 1, 1)))
    rows = orders_by_year(t, t.orders).select("o_orderkey", "o_orderstatus", old.cast("timestamp").alias("dw_processed_at"), "year")
    table = day_table(t, rows, "year")
    done = rows.filter("o_orderstatus IN ('O', 'P') AND year > DATE'1995-12-31'").select("o_orderkey", "year")
    mark_processed_days(done, table, ["o_orderkey", "year"], instant(dt.datetime(2024, 2, 1)), "year")
    return t.spark.table(table).select("o_orderkey", stamp("dw_processed_at").alias("dw_processed_at"))


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 1996")
def expired_days_dropped(t: Tables) -> DataFrame:
    """Whole partitions before 1995-12-31 go; none is read for it."""
    table = day_table(t, orders_by_year(t, t.orders), "year")
    drop_expired_days(t.spark, table, "year", dt.date(1998, 1, 1), days=732)
    return t.spark.table(table).select("o_orderkey")


@query(f"""
    WITH e AS (SELECT {SQL_EVENT_COLUMNS})
    SELECT {sql_stamp("ts")} AS cloudwatch_timestamp FROM e WHERE n IN (0, 1)
    UNION ALL SELECT {sql_stamp("ts + INTERVAL 1 MINUTE")} FROM e WHERE n IN (0, 1)
""")
def rejected_event_logs(t: Tables) -> DataFrame:
    """Raw rows that stay behind: without a key, or no JSON."""
    rest = load_logs(raw_events(t), existing_logs(t), SPEC, "id").remaining
    return rest.select(stamp("cloudwatch_timestamp").alias("cloudwatch_timestamp"))


@query(f"""
    WITH latest AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_stamp("l_shipdate")} AS l_shipdate, l_extendedprice, l_returnflag
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_returnflag) = 1
    )
    SELECT * FROM latest
    UNION ALL
    SELECT o_orderkey + {NEW_KEYS}, 1, NULL, NULL, {sql_stamp("o_orderdate")}, NULL, NULL FROM orders
""")
def sync_line_items(t: Tables) -> DataFrame:
    """The source repeats its keys. The copy lacks four columns, holds every key of the source with
    an older date, and one row per order under a key that the source does not have."""
    keys = ["l_orderkey", "l_linenumber"]
    other = t.orders.select(
        (F.col("o_orderkey") + NEW_KEYS).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("o_orderdate").alias("l_shipdate")
    )
    older = t.lineitem.groupBy(*keys).agg((F.min("l_shipdate") - F.expr("INTERVAL 1 DAY")).alias("l_shipdate"))
    copy = other.unionByName(older)
    source = t.lineitem.select(*keys, "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag")
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")] + [F.col("l_returnflag")]
    return sync_table(source, copy, keys, order).withColumn("l_shipdate", stamp("l_shipdate"))


@query("""
    SELECT CAST(strftime(o_orderdate, '%Y%m') AS VARCHAR) AS table_name,
           CASE WHEN strftime(o_orderdate, '%Y%m') = '199605' THEN '2024-01-01 00:00:00.000000'
                ELSE strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') END AS last_sync_time
    FROM orders GROUP BY strftime(o_orderdate, '%Y%m')
""")
def sync_metadata(t: Tables) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyyMM")
    metadata = t.orders.groupBy(month.alias("table_name")).agg(F.max("o_orderdate").cast("timestamp").alias("last_sync_time"))
    after = record_sync(metadata, "199605", dt.datetime(2024, 1, 1))
    return after.withColumn("last_sync_time", stamp("last_sync_time"))


@query("""
    SELECT DISTINCT l_returnflag AS table_name, CAST(l_linenumber AS INTEGER) AS column_name FROM lineitem
    WHERE (l_returnflag, l_linenumber) NOT IN (SELECT DISTINCT l_returnflag, l_linenumber FROM lineitem WHERE l_returnflag = 'A' OR l_linenumber < 3)
""")
def missing_columns_in_copy(t: Tables) -> DataFrame:
    catalog = t.lineitem.select(F.col("l_returnflag").alias("table_name"), F.col("l_linenumber").alias("column_name")).distinct()
    target = catalog.filter("table_name = 'A' OR column_name < 3")
    return missing_catalog_columns(catalog, target, ["table_name", "column_name"])


@query("""
    SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')
                            THEN '2024-02-01 00:00:00.000000' END AS dw_processed_at
    FROM orders
""")
def mark_processed_orders(t: Tables) -> DataFrame:
    target = t.orders.select("o_orderkey", "o_custkey", F.lit(None).cast("timestamp").alias("dw_processed_at"))
    done = t.events.filter("event_type = 'error'").select(F.col("user_id").alias("o_custkey"))
    marked = mark_processed(target, done, ["o_custkey"], instant(dt.datetime(2024, 2, 1)))
    return marked.select("o_orderkey", stamp("dw_processed_at").alias("dw_processed_at"))


SQL_EXPIRED = "o_orderdate < TIMESTAMP '2000-07-31' AND o_orderstatus <> 'P'"


@query(f"SELECT o_orderkey FROM orders WHERE NOT ({SQL_EXPIRED})")
def retention_kept(t: Tables) -> DataFrame:
    """Pending orders have no date and are kept."""
    dated = t.orders.withColumn("created_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return apply_retention(dated, "created_at", dt.date(2001, 8, 1)).select("o_orderkey")


@query(f"""
    SELECT 'orders' AS table_name, 'created_at' AS timestamp_column, count(*) AS total_rows,
           count(*) FILTER ({SQL_EXPIRED}) AS deleted_rows, count(*) FILTER (o_orderstatus = 'P') AS undated_rows
    FROM orders
    UNION ALL
    SELECT 'lineitem', 'l_shipdate', count(*), count(*) FILTER (l_shipdate < TIMESTAMP '2000-07-31'), 0 FROM lineitem
""")
def retention_counts(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("created_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    tables = {"orders": dated, "lineitem": t.lineitem, "events": t.events, "part": t.part}
    plan = plan_retention(
        tables, dt.date(2001, 8, 1), included=["orders", "lineitem", "part", "gone"], excluded=["events"],
        overrides={"lineitem": "l_shipdate"},
    )
    return plan.counts


@query("""
    WITH e AS (SELECT s_suppkey, s_name AS name, s_acctbal AS balance FROM supplier WHERE s_nationkey <= 18),
    a AS (SELECT s_suppkey, s_name AS name, CASE WHEN s_acctbal > 5000 THEN s_acctbal + 1 ELSE s_acctbal END AS balance
          FROM supplier WHERE s_nationkey >= 5)
    SELECT COALESCE(e.s_suppkey, a.s_suppkey) AS s_suppkey,
           CASE WHEN a.s_suppkey IS NULL THEN 'missing' WHEN e.s_suppkey IS NULL THEN 'extra' ELSE 'mismatched' END AS drift,
           e.name AS expected_name, e.balance AS expected_balance, a.name AS actual_name, a.balance AS actual_balance
    FROM e FULL JOIN a ON e.s_suppkey = a.s_suppkey
    WHERE a.s_suppkey IS NULL OR e.s_suppkey IS NULL OR e.balance <> a.balance
""")
def reconcile_suppliers(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", "s_nationkey", F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    changed = F.when(F.col("balance") > 5000, F.col("balance") + 1).otherwise(F.col("balance"))
    actual = rows.filter("s_nationkey >= 5").withColumn("balance", changed)
    return reconcile(rows.filter("s_nationkey <= 18"), actual, ["s_suppkey"], ["name", "balance"])


@query("""
    SELECT 'idp.customer.' || c_mktsegment AS column_id, upper(c_name) AS grantee_key,
           CASE WHEN c_nationkey < 5 THEN 'extra' WHEN c_nationkey > 20 THEN 'missing' ELSE 'mismatched' END AS drift,
           CASE WHEN c_nationkey >= 5 THEN 'mask_a' END AS expected_policy_name,
           CASE WHEN c_nationkey >= 5 THEN 100 END AS expected_priority,
           CASE WHEN c_nationkey <= 20 THEN 'mask_a' END AS actual_policy_name,
           CASE WHEN c_nationkey <= 20 THEN CASE WHEN c_acctbal > 0 THEN 100 ELSE 10 END END AS actual_priority
    FROM customer WHERE NOT (c_nationkey BETWEEN 5 AND 20 AND c_acctbal > 0)
""")
def policy_drift_customers(t: Tables) -> DataFrame:
    """Actual grantees are lower-cased, which is no drift."""
    attached = t.customer.select(
        F.lit("idp").alias("schema_name"), F.lit("customer").alias("table_name"), F.col("c_mktsegment").alias("column_name"),
        F.col("c_name").alias("grantee"), F.lit("mask_a").alias("policy_name"), F.lit(100).alias("priority"),
        "c_nationkey", "c_acctbal",
    )
    actual = attached.filter("c_nationkey <= 20").withColumns(
        {"grantee": F.lower("grantee"), "priority": F.when(F.col("c_acctbal") > 0, 100).otherwise(10)}
    )
    return policy_drift(attached.filter("c_nationkey >= 5"), actual)


PART_SPECS = [
    ColumnSpec("p_partkey", "integer", not_null=True),
    ColumnSpec("p_name", "string", limit=9),
    ColumnSpec("p_brand", "integer"),
    ColumnSpec("p_size", "string", not_null=True),
    ColumnSpec("warehouse_only_field", "string"),
]


@query("""
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, CAST(NULL AS INTEGER) AS p_brand,
           CAST(p_size AS VARCHAR) AS p_size, CAST(NULL AS VARCHAR) AS warehouse_only_field,
           '2024-01-01 00:00:00.000000' AS dw_created_at, '2024-01-01 00:00:00.000000' AS dw_updated_at
    FROM part
""")
def conform_parts(t: Tables) -> DataFrame:
    rows = conform(t.part, PART_SPECS, dt.datetime(2024, 1, 1))
    return rows.withColumns({c: stamp(c) for c in ("dw_created_at", "dw_updated_at")})


@query("""
    SELECT 'p_partkey' AS column_name, 0 AS bad_casts, 0 AS null_violations, 0 AS too_long
    UNION ALL SELECT 'p_name', 0, 0, count(*) FILTER (length(p_name) > 9) FROM part
    UNION ALL SELECT 'p_brand', count(*), 0, 0 FROM part
    UNION ALL SELECT 'p_size', 0, 0, 0
    UNION ALL SELECT 'warehouse_only_field', 0, 0, 0
""")
def conform_part_issues(t: Tables) -> DataFrame:
    return conform_issues(t.part, PART_SPECS)


@query("""
    SELECT 'c' AS part, c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS segment FROM customer
    UNION ALL SELECT 'pii', c_custkey, NULL, c_mktsegment FROM customer
""")
def split_pii_customers(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    main, pii = split_pii(
        rows, "id", [ColumnSpec("id", "bigint"), ColumnSpec("name", "string")],
        [ColumnSpec("id", "bigint"), ColumnSpec("segment", "string")], dt.datetime(2024, 1, 1),
    )
    both = main.withColumn("part", F.lit("c")).unionByName(pii.withColumn("part", F.lit("pii")), allowMissingColumns=True)
    return both.select("part", "id", "name", "segment")


def orders_by_date(t: Tables, *columns: Column | str) -> tuple[str, str]:
    """The orders as a folder of some ten files, each with a range of dates, and a folder to stage in."""
    work = fresh_dir(t.spark, "by-file")
    t.orders.select(*(columns or "*")).repartitionByRange(10, "o_orderdate").write.parquet(f"{work}/orders")
    return f"{work}/orders", f"{work}/staging"


SQL_LATEST = "o_orderdate >= (SELECT max(o_orderdate) - INTERVAL '90 days' FROM orders)"


def latest_orders(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max("o_orderdate")).first()[0]
    return t.orders.filter(F.col("o_orderdate") >= F.lit(last - dt.timedelta(days=90)))


@query(f"""
    SELECT * REPLACE ({sql_stamp("o_orderdate")} AS o_orderdate, CASE WHEN {SQL_LATEST} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
    FROM orders
    UNION ALL SELECT * REPLACE ({sql_stamp("o_orderdate")} AS o_orderdate, o_orderkey + {NEW_KEYS} AS o_orderkey, o_totalprice * 2 AS o_totalprice) FROM orders WHERE {SQL_LATEST}
""")
def upsert_files_orders(t: Tables) -> DataFrame:
    """Orders of the last ninety days change, and come again as new ones; older files stay."""
    path, staging = orders_by_date(t)
    doubled = latest_orders(t).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    again = doubled.withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEYS)
    upsert_files(doubled.unionByName(again), path, ["o_orderkey"], staging)
    return read_files(t.spark, path).withColumn("o_orderdate", stamp("o_orderdate"))


@query(f"""
    SELECT o_orderkey, CASE WHEN {SQL_LATEST} AND o_orderdate >= TIMESTAMP '1999-01-01' THEN '2024-02-01 00:00:00.000000' END AS dw_processed_at
    FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
""")
def mark_and_expire_files_orders(t: Tables) -> DataFrame:
    """Marks on the latest orders, then retention from 1999 on, each file by file."""
    path, staging = orders_by_date(t, "o_orderkey", "o_orderdate", F.lit(None).cast("timestamp").alias("dw_processed_at"))
    mark_files(latest_orders(t).select("o_orderkey"), path, ["o_orderkey"], instant(dt.datetime(2024, 2, 1)), staging)
    expire_files(t.spark, path, "o_orderdate", dt.date(1999, 1, 1), days=0)
    return read_files(t.spark, path).select("o_orderkey", stamp("dw_processed_at").alias("dw_processed_at"))


SQL_CHANGES = f"""
    changed AS (
        SELECT o_orderkey + CASE WHEN o_orderkey % 1000 = 7 THEN {NEW_KEYS} ELSE 0 END AS o_orderkey, o_custkey,
               CASE WHEN o_orderkey % 1000 = 3 THEN -1 ELSE o_totalprice END AS o_totalprice, o_orderstatus
        FROM orders WHERE o_orderkey % 1000 <> 5
    )
"""


def changed_orders(t: Tables) -> DataFrame:
    """Of a thousand keys one has another price, one has moved and one is gone."""
    number = F.col("o_orderkey") % 1000
    return t.orders.filter(number != 5).select(
        (F.col("o_orderkey") + F.when(number == 7, NEW_KEYS).otherwise(0)).alias("o_orderkey"), "o_custkey",
        F.when(number == 3, -1).otherwise(F.col("o_totalprice")).cast("double").alias("o_totalprice"), "o_orderstatus",
    )


@query(f"""
    WITH {SQL_CHANGES}
    SELECT COALESCE(o.o_orderkey, c.o_orderkey) AS o_orderkey,
           CASE WHEN c.o_orderkey IS NULL THEN 'missing' WHEN o.o_orderkey IS NULL THEN 'extra' ELSE 'mismatched' END AS drift,
           o.o_totalprice AS expected_o_totalprice, o.o_orderstatus AS expected_o_orderstatus,
           c.o_totalprice AS actual_o_totalprice, c.o_orderstatus AS actual_o_orderstatus
    FROM orders o FULL JOIN changed c ON o.o_orderkey = c.o_orderkey
    WHERE o.o_orderkey IS NULL OR c.o_orderkey IS NULL OR o.o_totalprice <> c.o_totalprice
""")
def reconcile_orders_by_checksum(t: Tables) -> DataFrame:
    """Ranges of 4096 and of 64 keys are compared before any row is."""
    return reconcile_by_checksum(t.orders, changed_orders(t), "o_orderkey", ["o_totalprice", "o_orderstatus"], (4096, 64))


@query(f"""
    WITH {SQL_CHANGES}
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM changed
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 1000 IN (5, 7)
""")
def sync_orders_by_checksum(t: Tables) -> DataFrame:
    """A copy takes over what its source has that differs, rewriting the files concerned; what the source lost stays."""
    path, staging = orders_by_date(t, "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    copy = read_files(t.spark, path)
    changed = changed_rows(changed_orders(t), copy, "o_orderkey", (4096, 64))
    columns = ["o_custkey", "o_totalprice", "o_orderstatus"]
    upsert_files_partial(changed, path, ["o_orderkey"], columns, staging)
    return read_files(t.spark, path).select("o_orderkey", *columns)


@query("""
    SELECT column_name, 'change' AS action FROM (DESCRIBE part) WHERE column_name IN ('p_partkey', 'p_brand', 'p_size')
    UNION ALL SELECT column_name, 'drop' FROM (DESCRIBE part) WHERE column_name NOT IN ('p_partkey', 'p_name', 'p_brand', 'p_size')
    UNION ALL VALUES ('warehouse_only_field', 'add'), ('dw_created_at', 'add'), ('dw_updated_at', 'add')
""")
def schema_diff_parts(t: Tables) -> DataFrame:
    """What a table's columns need to fit the configured ones."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(a).alias("action")) for c, a in schema_diff(t.part.schema, PART_SPECS)]
    return t.spark.range(1).select(F.inline(F.array(*cells)))
