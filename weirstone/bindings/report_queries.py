"""Reports on the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import SQL_K, Tables, k, query
from weirstone.bindings.report_inputs import (
    ALL_FIELDS,
    SQL_DEMOGRAPHIC_USERS,
    SQL_FRAUD_ROWS,
    SQL_PROVIDERS,
    calendar,
    demographic_events,
    fraud_inputs,
    partner_tables,
    providers,
    sql_partner_tables,
    sql_typed_field,
)
from weirstone.operators.filters import in_period
from weirstone.operators.metrics import bin_counts
from weirstone.plans import conversions, delivery, demographics, fraud, issuers, partner, partner_idv
from weirstone.plans.partner_fields import OUTCOME_DETAILS
from weirstone.session import fresh_dir
from weirstone.sources.documents import store_documents
from weirstone.sources.named_files import read_objects, write_objects
from weirstone.sources.tables import staged

QUARTER = (dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1))
AS_OF = dt.date(2024, 4, 2)
SQL_AGE = "(2024 - birth_year)"


@query(f"""
    WITH cohort AS (
        SELECT DISTINCT user_id FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' AND event_type = 'signup' AND {SQL_K} > 50
    ),
    values_seen AS (
        SELECT DISTINCT user_id, {SQL_K} AS n FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' AND event_type = 'purchase'
    )
    SELECT CAST(n // 10 * 10 AS INTEGER) AS bin_start, count(*) AS user_count, (n // 10 * 10) || '-' || (n // 10 * 10 + 9) AS bin
    FROM values_seen SEMI JOIN cohort USING (user_id) GROUP BY n // 10
""")
def demographics_bins(t: Tables) -> DataFrame:
    """Two filtered distinct cohorts, a semi join, a histogram."""
    events = in_period(t.events, "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25))
    cohort = events.filter((F.col("event_type") == "signup") & (k() > 50)).select("user_id").distinct()
    seen = events.filter("event_type = 'purchase'").select("user_id", k().alias("n")).distinct()
    return bin_counts(seen.join(cohort, "user_id", "left_semi"), F.col("n"), 10, 0, 140)


SQL_DEMOGRAPHIC_TABLES = f"""
    WITH {SQL_DEMOGRAPHIC_USERS}
    SELECT issuer, 'age_metrics' AS table_name, CAST({SQL_AGE} // 10 * 10 AS INTEGER) AS sort_key,
           ({SQL_AGE} // 10 * 10) || '-' || ({SQL_AGE} // 10 * 10 + 9) AS label, count(*) AS user_count
    FROM people WHERE {SQL_AGE} BETWEEN 0 AND 140 GROUP BY issuer, {SQL_AGE} // 10
    UNION ALL
    SELECT issuer, 'state_metrics', 0, state, count(*) FROM people WHERE trim(state) <> '' GROUP BY issuer, state
"""


@query(SQL_DEMOGRAPHIC_TABLES)
def demographics_report(t: Tables) -> DataFrame:
    users = demographics.verified_users(demographic_events(t), *QUARTER)
    return demographics.demographic_tables(users, AS_OF)


@query(SQL_DEMOGRAPHIC_TABLES)
def demographics_from_stored_documents(t: Tables) -> DataFrame:
    """The same tables from messages that were stored as documents; no text is read, or kept."""
    stored = store_documents(demographic_events(t), fresh_dir(t.spark, "documents"), keep_text=False)
    users = demographics.verified_users(stored, *QUARTER)
    return demographics.demographic_tables(users, AS_OF)


@query(f"""
    WITH {SQL_DEMOGRAPHIC_USERS}
    SELECT issuer, count(*) AS total_records, count(*) FILTER (birth_year IS NULL) AS null_values,
           count(*) FILTER ({SQL_AGE} NOT BETWEEN 0 AND 140) AS invalid_values
    FROM people GROUP BY issuer
""")
def demographics_quality(t: Tables) -> DataFrame:
    users = demographics.verified_users(demographic_events(t), *QUARTER)
    return demographics.age_quality(users, AS_OF)


@query(f"""
    WITH {SQL_DEMOGRAPHIC_USERS},
    issuers AS (SELECT DISTINCT 'sp-' || CAST(floor(value / 100) AS BIGINT) AS issuer FROM events UNION SELECT 'sp-none')
    SELECT issuer, state, user_count FROM issuers LEFT JOIN (
        SELECT issuer, state, count(*) AS user_count FROM people WHERE trim(state) <> '' GROUP BY issuer, state
    ) USING (issuer)
""")
def demographics_states_all_issuers(t: Tables) -> DataFrame:
    """An issuer without users still has its (empty) table."""
    events = demographic_events(t)
    listed = events.select(F.col("service_provider").alias("issuer")).distinct()
    listed = listed.unionByName(t.spark.range(1).select(F.lit("sp-none").alias("issuer")))
    users = demographics.verified_users(events, *QUARTER)
    return demographics.table_per_issuer(listed, demographics.state_table(users))


@query("""
    WITH issuers AS (SELECT DISTINCT 'sp-' || CAST(floor(value / 100) AS BIGINT) AS issuer FROM events)
    SELECT issuer, metric, unit, 'The number of users for this issuer who verified within the reporting period, grouped by ' || grouped || '.' AS definition
    FROM issuers, (VALUES ('Age range/Verification Demographics', 'Count', 'age in 10 year range'),
                          ('Geographic area/Verification Demographics', 'Count', 'state')) AS d(metric, unit, grouped)
""")
def demographics_definitions(t: Tables) -> DataFrame:
    return demographics.definitions_table(demographic_events(t).select(F.col("service_provider").alias("issuer")))


@query("""
    WITH issuers AS (SELECT DISTINCT 'sp-' || CAST(floor(value / 100) AS BIGINT) AS issuer FROM events)
    SELECT issuer, 'Report Timeframe' AS line, '2024-01-01 00:00:00 UTC to 2024-03-31 23:59:59 UTC' AS value FROM issuers
    UNION ALL SELECT issuer, 'Report Generated', '2024-04-02' FROM issuers
    UNION ALL SELECT issuer, 'Issuer', issuer FROM issuers
""")
def demographics_overview(t: Tables) -> DataFrame:
    listed = demographic_events(t).select(F.col("service_provider").alias("issuer"))
    return demographics.overview_table(listed, *QUARTER, AS_OF)


@query(f"""
    WITH {SQL_FRAUD_ROWS}
    SELECT *, '2024-01-01 00:00:00 UTC' AS "Range Start", '2024-01-31 23:59:59 UTC' AS "Range End" FROM r
""")
def fraud_report(t: Tables) -> DataFrame:
    return fraud.fraud_metrics(*fraud_inputs(t), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))


@query("""
    WITH upgrades AS (
        SELECT l_orderkey AS user_id, s_name AS issuer, l_shipdate + (l_linenumber - 1) * INTERVAL 1 HOUR AS upgraded_at
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    ),
    firsts AS (SELECT * FROM upgrades QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY upgraded_at, issuer) = 1),
    agreements AS (
        SELECT n_nationkey AS id, n_nationkey AS order_number, n_regionkey AS iaa_gtc_id,
               DATE '1995-01-01' + n_nationkey * 30 AS start_date, DATE '1995-12-31' + n_nationkey * 30 AS end_date FROM nation
    )
    SELECT a.id AS order_id, 'gtc' || r_regionkey || '-' || lpad(CAST(a.order_number AS VARCHAR), 4, '0') AS iaa_order_number,
           strftime(start_date, '%Y-%m-%d') AS iaa_start_date, strftime(end_date, '%Y-%m-%d') AS iaa_end_date,
           u.issuer, lower(s_name) AS friendly_name, strftime(date_trunc('month', upgraded_at), '%Y%m') AS year_month,
           strftime(date_trunc('month', upgraded_at), '%B %Y') AS year_month_readable, count(DISTINCT user_id) AS user_count
    FROM agreements a JOIN supplier ON s_nationkey = a.id JOIN region ON r_regionkey = a.iaa_gtc_id
    JOIN firsts u ON u.issuer = s_name AND u.upgraded_at BETWEEN a.start_date AND a.end_date
    GROUP BY ALL
""")
def conversion_report(t: Tables) -> DataFrame:
    """Nations are agreement orders, regions general terms, suppliers integrations and providers;
    a line item is an upgrade of the user its order stands for."""
    start = F.lit("1995-01-01").cast("date")
    agreements = t.nation.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_nationkey").alias("order_number"),
        F.date_add(start, F.col("n_nationkey") * 30).alias("start_date"),
        F.date_add(start, 364 + F.col("n_nationkey") * 30).alias("end_date"),
        F.col("n_regionkey").alias("iaa_gtc_id"),
    )
    gtcs = t.region.select(F.col("r_regionkey").alias("id"), F.concat(F.lit("gtc"), "r_regionkey").alias("gtc_number"))
    usages = t.supplier.select(F.col("s_nationkey").alias("iaa_order_id"), F.col("s_suppkey").alias("integration_id"))
    integrations = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("issuer"))
    names = t.supplier.select(F.col("s_name").alias("issuer"), F.lower("s_name").alias("friendly_name"))
    hour = F.make_dt_interval(F.lit(0), F.col("l_linenumber") - 1)
    upgrades = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("user_id"), F.col("s_name").alias("issuer"), (F.col("l_shipdate") + hour).alias("upgraded_at")
    )
    covered = conversions.covered_orders(agreements, usages, integrations, gtcs, names)
    return conversions.conversion_report(upgrades, covered)


REPORT_DATE = dt.date(1996, 6, 30)
SQL_ROWS = f"""
    WITH {sql_partner_tables()},
    in_force AS (
        SELECT * FROM ({SQL_PROVIDERS}) WHERE iaa_end_date > DATE '1996-06-30' AND DATE '1996-06-30' >= launch_date
    ),
    joined AS (
        SELECT p.issuer, p.service_provider_name, p.agency_name, p.service_provider_id,
               {", ".join(sql_typed_field(f) + " AS " + f for f in ALL_FIELDS)},
               CASE WHEN count_active_users > 9 THEN 1 ELSE 0 END AS bad_values
        FROM in_force p
        LEFT JOIN usage ON usage.service_provider_id = p.service_provider_id AND usage.period_date_id = 19960601
        LEFT JOIN idv ON idv.start_service_provider_id = p.service_provider_id AND idv.period_date_id = 19960601
        LEFT JOIN auth ON auth.service_provider_id = p.service_provider_id AND auth.period_date_id = 19960601
        LEFT JOIN account ON account.service_provider_id = p.service_provider_id AND account.period_date_id = 19960601
    )
"""


def checked(t: Tables) -> DataFrame:
    period = partner.report_period(calendar(t), REPORT_DATE, "monthly")
    rows = partner.partner_rows(providers(t), partner.metric_tables(partner_tables(t)), period, REPORT_DATE)
    return partner.checked_rows(rows, ALL_FIELDS)


@query(f"""
    {SQL_ROWS}
    SELECT *, '1996-06-01' AS period_date_actual, 19960601 AS period_date_id, '1996-06-30' AS report_date,
           CASE WHEN service_provider_name IS NULL THEN 'missing_field' ELSE 'ok' END AS status
    FROM joined
""")
def partner_metrics(t: Tables) -> DataFrame:
    return checked(t).withColumn("report_date", F.col("report_date").cast("string"))


@query(f"""
    {SQL_ROWS}
    SELECT service_provider_id, issuer, '1996-06-01' AS period_date_actual, CAST(to_json({{
        'issuer': issuer,
        'provider_information': {{
            'service_provider_name': service_provider_name, 'agency_name': agency_name, 'service_provider_id': service_provider_id
        }},
        'report_information': {{
            'period_start_date': '1996-06-01', 'period_calendar_id': 19960601, 'report_cadence': 'monthly'
        }},
        'data': {{{", ".join(f"'{f}': {f}" for f in ALL_FIELDS)}}}
    }}) AS VARCHAR) AS document
    FROM joined WHERE service_provider_name IS NOT NULL
""")
def partner_documents(t: Tables) -> DataFrame:
    return partner.partner_documents(checked(t), "monthly", ALL_FIELDS)


@query(f"""
    WITH {sql_partner_tables()}
    SELECT s_name AS issuer, 'App ' || s_name AS service_provider_name, n_name AS agency_name, start_service_provider_id,
           '1996-06-01' AS month_start_date_actual, period_date_id AS month_start_calendar_id, {", ".join(OUTCOME_DETAILS)}
    FROM idv JOIN supplier ON s_suppkey = start_service_provider_id JOIN nation ON s_nationkey = n_nationkey
    WHERE period_date_id = 19960601
""")
def partner_idv_outcomes(t: Tables) -> DataFrame:
    outcomes = partner_tables(t)["idv"].withColumnRenamed("period_date_id", "month_start_calendar_id")
    month = F.to_date(F.col("month_start_calendar_id").cast("string"), "yyyyMMdd").cast("string")
    named = providers(t).withColumn("service_provider_name", F.concat(F.lit("App "), "issuer"))
    return partner_idv.partner_idv_rows(outcomes.withColumn("month_start_date_actual", month), named, None, 19960601)


@query(f"""
    WITH {sql_partner_tables()}
    SELECT s_name AS issuer, 'App ' || s_name AS service_provider_name, n_name AS agency_name, start_service_provider_id,
           '1996-06-01' AS month_start_date_actual, period_date_id AS month_start_calendar_id, {", ".join(OUTCOME_DETAILS)}
    FROM idv JOIN supplier ON s_suppkey = start_service_provider_id JOIN nation ON s_nationkey = n_nationkey
    WHERE period_date_id = 19960601 AND start_service_provider_id = 2
""")
def partner_idv_of_one_provider(t: Tables) -> DataFrame:
    outcomes = partner_tables(t)["idv"].withColumnRenamed("period_date_id", "month_start_calendar_id")
    month = F.to_date(F.col("month_start_calendar_id").cast("string"), "yyyyMMdd").cast("string")
    named = providers(t).withColumn("service_provider_name", F.concat(F.lit("App "), "issuer"))
    return partner_idv.partner_idv_rows(outcomes.withColumn("month_start_date_actual", month), named, 2, 19960601)


@query("""
    WITH given AS (
        SELECT CASE WHEN o_orderstatus <> 'P' THEN 'sp-' || o_orderkey // 2 END AS issuer,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS service_provider_id, o_orderkey
        FROM orders
    )
    SELECT o_orderkey, issuer, service_provider_id, CASE WHEN issuer IS NULL THEN 'missing_field'
                WHEN count(*) OVER (PARTITION BY issuer) > 1 THEN 'duplicate_issuer'
                WHEN service_provider_id IS NULL THEN 'missing_id' ELSE 'ok' END AS status
    FROM given
""")
def partner_row_status(t: Tables) -> DataFrame:
    """Every row keeps its own status: issuers that are missing or occur twice, and missing ids."""
    key = F.col("o_orderkey")
    rows = t.orders.select(
        key,
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("sp-"), F.floor(key / 2))).alias("issuer"),
        F.lit("name").alias("service_provider_name"), F.lit("agency").alias("agency_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", key).alias("service_provider_id"),
        F.lit("1996-06-01").alias("period_date_actual"), F.lit(19960601).alias("period_date_id"),
    )
    return partner.checked_rows(rows, []).select("o_orderkey", "issuer", "service_provider_id", "status")


SQL_RAW_ISSUERS = """
    raw AS (
        SELECT s_name AS issuer, CAST(s_suppkey AS VARCHAR) AS id FROM supplier
        UNION ALL SELECT s_name, CASE WHEN s_acctbal > 0 THEN CAST(s_suppkey + 1000000 AS VARCHAR) ELSE 'bad' END FROM supplier
        UNION ALL SELECT CASE WHEN s_nationkey < 12 THEN '  ' END, CAST(s_suppkey AS VARCHAR) FROM supplier
        UNION ALL SELECT s_name, NULL FROM supplier
        UNION ALL SELECT 'alias ' || s_name, CAST(s_suppkey AS VARCHAR) FROM supplier
    )
"""


def raw_issuers(t: Tables) -> DataFrame:
    """Each supplier once with its key, then with a second or a bad id, blank, without id, aliased."""
    name, key = F.col("s_name"), F.col("s_suppkey").cast("string")
    second = F.when(F.col("s_acctbal") > 0, (F.col("s_suppkey") + 1000000).cast("string")).otherwise("bad")
    blank = F.when(F.col("s_nationkey") < 12, "  ")
    rows = [(name, key), (name, second), (blank, key), (name, F.lit(None).cast("string")), (F.concat(F.lit("alias "), name), key)]
    return t.supplier.select(F.inline(F.array(*[F.struct(i.alias("issuer"), n.alias("id")) for i, n in rows])))


@query("""
    SELECT s_name AS issuer, s_suppkey AS id FROM supplier
    UNION ALL SELECT 'alias ' || s_name, s_suppkey FROM supplier
""")
def issuer_mapping(t: Tables) -> DataFrame:
    return issuers.issuer_to_id(raw_issuers(t))


@query("SELECT s_suppkey AS id, s_name AS issuer FROM supplier")
def issuer_mapping_inverse(t: Tables) -> DataFrame:
    return issuers.id_to_issuer(issuers.issuer_to_id(raw_issuers(t)))


@query("""
    SELECT 3 * count(*) AS usable_rows, count(*) FILTER (s_acctbal <= 0) AS invalid_ids, count(*) FILTER (s_acctbal > 0) AS duplicate_rows
    FROM supplier
""")
def issuer_mapping_issues(t: Tables) -> DataFrame:
    return issuers.mapping_issues(raw_issuers(t))


def delivered(t: Tables, pattern: str, *lines: DataFrame) -> DataFrame:
    """(path, line) of all lines of the objects, read back by their names."""
    root = fresh_dir(t.spark, "delivered")
    for part in lines:
        write_objects(part, root)
    whole = read_objects(t.spark, root, pattern)
    text = F.split(F.regexp_replace("line", "\\n$", ""), "\n")
    return whole.select("path", F.posexplode(text).alias("position", "line"))


def mapped_issuers(t: Tables) -> DataFrame:
    """Every other issuer of the events has a provider; sp-1 and sp-3 share one."""
    listed = demographic_events(t).select(F.col("service_provider").alias("issuer")).distinct()
    number = F.split("issuer", "-")[1].cast("bigint")
    ids = listed.filter((number % 2 == 1) | (number == 0)).select("issuer", F.when(number == 3, 1).otherwise(number).alias("id"))
    return delivery.deliverable(listed, ids)


SQL_RECIPIENTS = """
    numbered AS (SELECT DISTINCT CAST(floor(value / 100) AS BIGINT) AS number FROM events),
    recipients AS (
        SELECT 'sp-' || number AS issuer, CASE WHEN number = 3 THEN 1 ELSE number END AS id,
               CASE WHEN number % 2 <> 1 AND number <> 0 THEN 'missing_id'
                    WHEN number = 3 AND 1 IN (SELECT number FROM numbered) THEN 'shared_id' ELSE 'ok' END AS status
        FROM numbered
    )
"""


@query(f"""
    WITH {SQL_RECIPIENTS} SELECT issuer, CASE WHEN status <> 'missing_id' THEN id END AS service_provider_id, status FROM recipients
""")
def delivery_status(t: Tables) -> DataFrame:
    return mapped_issuers(t)


@query(f"""
    WITH {SQL_RECIPIENTS}, {SQL_DEMOGRAPHIC_USERS},
    counts AS (
        SELECT issuer, 'age_metrics' AS file, CAST({SQL_AGE} // 10 * 10 AS INTEGER) AS k,
               ({SQL_AGE} // 10 * 10) || '-' || ({SQL_AGE} // 10 * 10 + 9) AS label, count(*) AS n
        FROM people WHERE {SQL_AGE} BETWEEN 0 AND 140 GROUP BY issuer, {SQL_AGE} // 10
        UNION ALL SELECT issuer, 'state_metrics', 0, state, count(*) FROM people WHERE trim(state) <> '' GROUP BY issuer, state
    ),
    lines AS (
        SELECT issuer, file, row_number() OVER (PARTITION BY issuer, file ORDER BY k, label) AS position, label || ',' || n AS line FROM counts
        UNION ALL SELECT issuer, 'age_metrics', 0, 'Age Range,User Count' FROM recipients
        UNION ALL SELECT issuer, 'state_metrics', 0, 'State,User Count' FROM recipients
        UNION ALL SELECT issuer, 'overview', p, l || v FROM recipients, LATERAL (VALUES
            (0, 'Report Timeframe,', '2024-01-01 00:00:00 UTC to 2024-03-31 23:59:59 UTC'), (1, 'Report Generated,', '2024-04-02'), (2, 'Issuer,', issuer)) AS o(p, l, v)
        UNION ALL SELECT issuer, 'definitions', p, l FROM recipients, (VALUES (0, 'Metric,Unit,Definition'),
            (1, 'Age range/Verification Demographics,Count,"The number of users for this issuer who verified within the reporting period, grouped by age in 10 year range."'),
            (2, 'Geographic area/Verification Demographics,Count,"The number of users for this issuer who verified within the reporting period, grouped by state."')) AS d(p, l)
    )
    SELECT 'idp/DemographicsMetricsReport/' || id || '/quarterly/Q12024/' || a || id || b || file || '.csv' AS path, CAST(position AS INTEGER) AS position, line
    FROM lines JOIN recipients USING (issuer), (VALUES ('SP', '_20240402_external_'), ('latest_SP', '_'), ('latest_external_SP', '_')) AS names(a, b)
    WHERE status = 'ok'
""")
def demographics_delivered(t: Tables) -> DataFrame:
    """Four files of every provider under three names each, written by the executors and read back."""
    tables = staged(demographics_report(t), fresh_dir(t.spark, "tables"))
    recipients = staged(mapped_issuers(t), fresh_dir(t.spark, "recipients"))
    return delivered(t, "idp/*/*/quarterly/*/*.csv", delivery.demographic_lines(tables, recipients, *QUARTER, AS_OF))


@query(f"""
    WITH {SQL_FRAUD_ROWS},
    ordered AS (SELECT *, row_number() OVER (PARTITION BY report ORDER BY list_position({list(fraud.METRICS)}, "Metric")) AS position FROM r),
    lines AS (
        SELECT report, position, "Metric" || ',' || "Total" || ',2024-01-01 00:00:00 UTC,2024-01-31 23:59:59 UTC' AS line FROM ordered
        UNION ALL SELECT DISTINCT report, 0, 'Metric,Total,Range Start,Range End' FROM r
    )
    SELECT 'idp/fraud-metrics-report/' || kind || '.fraud-metrics-report/' || report || '.csv' AS path, CAST(position AS INTEGER) AS position, line
    FROM lines, (VALUES ('latest'), ('2024/2024-02-01')) AS k(kind)
""")
def fraud_delivered(t: Tables) -> DataFrame:
    """The three fraud files under their dated and latest names; a second run replaces the first one's."""
    rows = fraud_report(t)
    old = delivery.fraud_lines(rows.withColumn("Total", F.lit("old")), dt.date(2024, 2, 1))
    return delivered(t, "idp/fraud-metrics-report/{latest.*,2024/*}/*.csv", old, delivery.fraud_lines(rows, dt.date(2024, 2, 1)))


@query("""
    WITH mapping AS (SELECT s_name AS issuer, s_suppkey AS id FROM supplier UNION ALL SELECT 'alias ' || s_name, s_suppkey FROM supplier),
    rows AS (SELECT *, row_number() OVER (ORDER BY issuer) AS n FROM mapping)
    SELECT 'portal/issuers_service_provider_id.json' AS path, CAST(n AS INTEGER) AS position,
           CASE WHEN n > 1 THEN ',' ELSE '' END || '"' || issuer || '":{"id":' || id || '}' AS line FROM rows
    UNION ALL SELECT 'portal/issuers_service_provider_id.json', 0, '{'
    UNION ALL SELECT 'portal/issuers_service_provider_id.json', CAST((SELECT count(*) FROM mapping) + 1 AS INTEGER), '}'
""")
def issuer_mapping_delivered(t: Tables) -> DataFrame:
    return delivered(t, "portal/issuers_service_provider_id.json", delivery.mapping_lines(issuers.issuer_to_id(raw_issuers(t))))


@query(f"""
    {SQL_ROWS}
    SELECT 'portal/' || service_provider_id || '/monthly/1996-06-01.json' AS path, 0 AS position, issuer
    FROM joined WHERE service_provider_name IS NOT NULL
""")
def partner_documents_delivered(t: Tables) -> DataFrame:
    """One object per provider, whose issuer is read from its document."""
    rows = delivered(t, "portal/*/monthly/1996-06-01.json", delivery.partner_lines(partner_documents(t), "monthly"))
    return rows.select("path", "position", F.get_json_object("line", "$.issuer").alias("issuer"))
