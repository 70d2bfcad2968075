"""Report inputs derived from the sample tables, and the same relations in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import SQL_K, Tables, k
from weirstone.functions.dates import date_key
from weirstone.plans.demographics import PROOFING_EVENT, REDIRECT_EVENT
from weirstone.plans.fraud import CALL_VISITED, REINSTATED, SETUP_ERROR_VISITED, SUSPENDED
from weirstone.plans.partner_fields import ACCOUNT_FIELDS, AUTH_FIELDS, OUTCOME_DETAILS, OUTCOME_TOTALS, USAGE_FIELDS

FRAUD_NAMES = {"view": CALL_VISITED, "error": SETUP_ERROR_VISITED, "click": SUSPENDED, "signup": REINSTATED}


def fraud_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, users, profiles): users are customers with orders, each order is a profile."""
    name = F.col("event_type")
    for kind, label in FRAUD_NAMES.items():
        name = F.when(F.col("event_type") == kind, label).otherwise(name)
    events = t.events.select(
        name.alias("name"), F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("cloudwatch_timestamp")
    )
    suspended = F.max("o_orderdate")
    users = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.min("o_orderdate").alias("created_at"),
        suspended.alias("suspended_at"),
        (suspended + F.make_dt_interval(F.count(F.lit(1)).cast("int"))).alias("reinstated_at"),
    )
    profiles = t.orders.select(
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderstatus") != "P").alias("active"),
        F.col("o_orderdate").alias("activated_at"),
    )
    return events, users.withColumn("uuid", F.col("id").cast("string")), profiles


SQL_FRAUD_ROWS = """
    users AS (
        SELECT o_custkey AS id, min(o_orderdate) AS created_at, max(o_orderdate) AS suspended_at,
               max(o_orderdate) + count(*)::INTEGER * INTERVAL 1 DAY AS reinstated_at
        FROM orders GROUP BY o_custkey
    ),
    moved AS (
        SELECT user_id, bool_or(event_type = 'click') AS suspended, bool_or(event_type = 'signup') AS reinstated
        FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY user_id
    ),
    seen AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'),
    people AS (SELECT * FROM users JOIN moved ON CAST(moved.user_id AS VARCHAR) = CAST(users.id AS VARCHAR)),
    r AS (
        SELECT 'lg99_metrics' AS report, 'Unique users seeing LG-99' AS "Metric",
               CAST(count(DISTINCT CASE WHEN event_type IN ('view', 'error') THEN user_id END) AS VARCHAR) AS "Total" FROM seen
        UNION ALL SELECT 'suspended_metrics', 'Unique users suspended',
               CAST(count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) AS VARCHAR) FROM seen
        UNION ALL SELECT 'reinstated_metrics', 'Unique users reinstated',
               CAST(count(DISTINCT CASE WHEN event_type = 'signup' THEN user_id END) AS VARCHAR) FROM seen
        UNION ALL SELECT 'suspended_metrics', 'Average Days Creation to Suspension',
               COALESCE(CAST(round(avg(epoch_us(suspended_at) - epoch_us(created_at)) / 86400e6, 1) AS VARCHAR), 'n/a') FROM people WHERE suspended
        UNION ALL SELECT 'reinstated_metrics', 'Average Days to Reinstatement',
               COALESCE(CAST(round(avg(epoch_us(reinstated_at) - epoch_us(suspended_at)) / 86400e6, 1) AS VARCHAR), 'n/a') FROM people WHERE reinstated
        UNION ALL SELECT 'suspended_metrics', 'Average Days Proofed to Suspension',
               COALESCE(CAST(round(avg(epoch_us(suspended_at) - epoch_us(o_orderdate)) / 86400e6, 1) AS VARCHAR), 'n/a')
               FROM people JOIN orders ON o_custkey = id WHERE suspended AND o_orderstatus <> 'P'
    )
"""


def demographic_events(t: Tables) -> DataFrame:
    """Sign-ups become redirects, purchases proofing results; the issuer is the value's hundred."""
    number, kind = k(), F.col("event_type")
    state = F.when(number < 25, "md").when(number < 50, "Va").when(number < 75, " ")
    person = F.struct(
        F.when(number != 0, 1880 + 2 * number).alias("birth_year"), state.alias("state_id_jurisdiction")
    )
    details = F.struct(
        F.when(number > 30, 2).otherwise(1).alias("ial"),
        (F.col("value") > 5).alias("success"),
        F.struct(person.alias("biographical_info")).alias("proofing_results"),
    )
    request = F.struct((F.col("value") > 10).alias("facial_match"))
    message = F.to_json(F.struct(F.struct(details.alias("event_properties"), request.alias("sp_request")).alias("properties")))
    name = F.when(kind == "signup", REDIRECT_EVENT).when(kind == "purchase", PROOFING_EVENT).otherwise(kind)
    return t.events.select(
        "user_id",
        name.alias("name"),
        F.concat(F.lit("sp-"), F.floor(F.col("value") / 100).cast("string")).alias("service_provider"),
        message.alias("message"),
        F.col("ts").alias("cloudwatch_timestamp"),
    )


SQL_DEMOGRAPHIC_USERS = f"""
    base AS (
        SELECT 'sp-' || CAST(floor(value / 100) AS BIGINT) AS issuer, user_id, event_type, value, {SQL_K} AS n
        FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-04-01'
    ),
    redirects AS (
        SELECT DISTINCT issuer, user_id FROM base WHERE event_type = 'signup' AND n > 30 AND value > 10
    ),
    details AS (
        SELECT DISTINCT issuer, user_id,
               CASE WHEN n <> 0 THEN 1880 + 2 * n END AS birth_year,
               CASE WHEN n < 25 THEN 'MD' WHEN n < 50 THEN 'VA' WHEN n < 75 THEN ' ' END AS state
        FROM base WHERE event_type = 'purchase' AND value > 5
    ),
    people AS (SELECT * FROM details SEMI JOIN redirects USING (issuer, user_id))
"""


def calendar(t: Tables) -> DataFrame:
    """One row per ship day, with its month and week."""
    day = F.col("date_actual")
    days = t.lineitem.select(F.to_date("l_shipdate").alias("date_actual")).distinct()
    month, week = F.trunc(day, "month"), F.trunc(day, "week")
    return days.select(
        date_key(day).alias("calendar_id"),
        day,
        date_key(month).alias("month_start_calendar_id"),
        month.alias("month_start_date_actual"),
        date_key(week).alias("week_start_calendar_id"),
        week.alias("week_start_date_actual"),
    )


def providers(t: Tables) -> DataFrame:
    """Suppliers as service providers; the nation sets launch and end of the agreement."""
    start = F.lit("1995-01-01").cast("date")
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("service_provider_id"),
        F.col("s_name").alias("issuer"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("App "), "s_name")).alias("service_provider_name"),
        F.col("n_name").alias("agency_name"),
        F.date_add(start, F.col("s_nationkey") * 60).alias("launch_date"),
        F.date_add(start, 500 + F.col("s_nationkey") * 60).alias("iaa_end_date"),
    )


SQL_PROVIDERS = """
    SELECT s_suppkey AS service_provider_id, s_name AS issuer,
           CASE WHEN s_acctbal > 0 THEN 'App ' || s_name END AS service_provider_name, n_name AS agency_name,
           DATE '1995-01-01' + s_nationkey * 60 AS launch_date,
           DATE '1995-01-01' + 500 + s_nationkey * 60 AS iaa_end_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

# Which line items count for the n-th field of a metric table: those with a quantity above n.
METRIC_SOURCES = {
    "usage": (USAGE_FIELDS, "l_quantity > 1", "service_provider_id"),
    "idv": (OUTCOME_TOTALS + OUTCOME_DETAILS, "l_returnflag = 'R'", "start_service_provider_id"),
    "auth": (AUTH_FIELDS, "l_returnflag = 'A'", "service_provider_id"),
    "account": (ACCOUNT_FIELDS, "l_linestatus = 'O'", "service_provider_id"),
}
ALL_FIELDS = [f for fields, _, _ in METRIC_SOURCES.values() for f in fields]


def partner_tables(t: Tables) -> dict[str, DataFrame]:
    """The four metric tables per supplier and month. Active users come as text, partly bad."""
    month = F.trunc(F.to_date("l_shipdate"), "month")
    tables = {}
    for kind, (fields, condition, provider) in METRIC_SOURCES.items():
        counts = (
            t.lineitem.filter(condition)
            .groupBy(
                F.col("l_suppkey").alias(provider),
                date_key(month).alias("period_date_id"),
            )
            .agg(*[F.count_if(F.col("l_quantity") > n).alias(f) for n, f in enumerate(fields)])
        )
        if kind == "usage":
            n = F.col("count_active_users")
            text = F.when(n < 5, " ").when(n > 9, "many").otherwise(n.cast("string"))
            counts = counts.withColumn("count_active_users", text)
        tables[kind] = counts
    return tables


def sql_partner_tables() -> str:
    parts = []
    for kind, (fields, condition, provider) in METRIC_SOURCES.items():
        columns = [f"count(CASE WHEN l_quantity > {n} THEN 1 END) AS {f}" for n, f in enumerate(fields)]
        parts.append(f"""
            {kind} AS (
                SELECT l_suppkey AS {provider},
                       CAST(strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS INTEGER) AS period_date_id,
                       {", ".join(columns)}
                FROM lineitem WHERE {condition} GROUP BY 1, 2
            )""")
    return ", ".join(parts)


def sql_typed_field(field: str) -> str:
    """Value of a field after the strict conversion."""
    if field == "count_active_users":
        return "CASE WHEN count_active_users BETWEEN 5 AND 9 THEN count_active_users END"
    return field
