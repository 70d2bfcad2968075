"""Projections, filters, casts and scalar functions on the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import SQL_K, Tables, k, query, sql_stamp, stamp
from weirstone.bindings.report_inputs import calendar, providers, SQL_PROVIDERS
from weirstone.bindings.sample_logs import SQL_EVENT_COLUMNS, raw_events, raw_requests, sql_event_message, sql_other_columns
from weirstone.functions import dates, jsonpath, text
from weirstone.operators import filters
from weirstone.operators.extract import EVENT_COLUMNS, REQUEST_COLUMNS, extract_columns


@query(f"""
    WITH e AS (SELECT {SQL_EVENT_COLUMNS}),
    copies AS (
        SELECT n, event_id, ts, user_id, value, event_type AS kind, ts AS arrived FROM e
        UNION ALL
        SELECT n, event_id, ts, user_id, value * 2, 'late', ts + INTERVAL 1 MINUTE FROM e
    )
    SELECT CASE WHEN n NOT IN (0, 1) THEN CAST(event_id AS VARCHAR) END AS id,
           CASE WHEN n <> 1 THEN kind END AS name,
           CASE WHEN n <> 1 THEN {sql_stamp("ts")} END AS "time",
           {sql_stamp("arrived")} AS cloudwatch_timestamp,
           CASE WHEN n <> 1 THEN 'events.log' END AS log_filename,
           CASE WHEN n <> 1 THEN TRUE END AS new_event,
           CASE WHEN n <> 1 THEN '/' || kind END AS path,
           CASE WHEN n <> 1 THEN CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN n <> 1 AND kind <> 'error' THEN n END AS pid,
           CASE WHEN n <> 1 THEN value > 100 END AS browser_mobile,
           CASE WHEN n <> 1 THEN kind <> 'error' END AS success,
           {sql_event_message("kind", "value")} AS message,
           {sql_other_columns(EVENT_COLUMNS, *"id name time log_filename new_event path user_id pid browser_mobile success".split())}
    FROM copies
""")
def extract_event_columns(t: Tables) -> DataFrame:
    rows = extract_columns(raw_events(t), EVENT_COLUMNS)
    return rows.withColumns({c: stamp(c) for c in ("time", "cloudwatch_timestamp")})


@query(f"""
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS uuid,
           CASE WHEN l_returnflag = 'R' THEN 'POST' ELSE 'GET' END AS method,
           200 + l_linenumber AS status, {sql_stamp("l_shipdate")} AS "timestamp",
           CAST(l_suppkey AS INTEGER) AS pid, l_extendedprice AS duration, '/api/health' AS path, {sql_stamp("l_shipdate")} AS cloudwatch_timestamp,
           {sql_other_columns(REQUEST_COLUMNS, *"uuid method path status timestamp pid duration".split())}
    FROM lineitem
""")
def extract_request_columns(t: Tables) -> DataFrame:
    rows = extract_columns(raw_requests(t), REQUEST_COLUMNS, keep=["cloudwatch_timestamp"])
    return rows.withColumns({c: stamp(c) for c in ("timestamp", "cloudwatch_timestamp")} | {"duration": F.col("duration").cast("double")})


@query(f"""
    SELECT event_id, {SQL_K} AS k_int, CAST({SQL_K} AS VARCHAR) AS k_text, CAST({SQL_K} AS DOUBLE) AS k_double,
           CAST(NULL AS INTEGER) AS missing, TRUE AS parses, FALSE AS cut_parses
    FROM events
""")
def json_values(t: Tables) -> DataFrame:
    document = jsonpath.parsed(F.col("props"))
    cut = F.substring("props", F.lit(1), F.length("props") - 1)
    return t.events.select(
        "event_id",
        jsonpath.value_at(document, "k", "int").alias("k_int"),
        jsonpath.json_extract_path_text(F.col("props"), "k").alias("k_text"),
        jsonpath.value_at(document, "k", "double").alias("k_double"),
        jsonpath.value_at(document, "no.such.path", "int").alias("missing"),
        jsonpath.can_json_parse(F.col("props")).alias("parses"),
        jsonpath.can_json_parse(cut).alias("cut_parses"),
    )


@query(f"""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE {SQL_K} END AS k, event_type AS first_name
    FROM events
""")
def first_payload(t: Tables) -> DataFrame:
    """First value below ``events`` whatever its key; for errors ``events`` is an empty object."""
    payload = F.struct("user_id", k().alias("k"))
    keyed = F.map_from_arrays(F.array(F.concat(F.lit("urn:type:"), "event_type")), F.array(payload))
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<user_id:bigint,k:int>>"))
    names = F.to_json(F.array("event_type"))
    document = F.to_json(
        F.struct(F.when(F.col("event_type") == "error", nothing).otherwise(keyed).alias("events"))
    )
    parsed = jsonpath.parsed(jsonpath.first_value_or_self(document))
    return t.events.select(
        "event_id",
        jsonpath.value_at(parsed, "user_id", "bigint").alias("user_id"),
        jsonpath.value_at(parsed, "k", "int").alias("k"),
        jsonpath.first_array_element(names).alias("first_name"),
    )


@query(f"""
    SELECT event_id, {sql_stamp("time_bucket(INTERVAL '5 minutes', ts)")} AS bucket,
           {sql_stamp("make_timestamp(epoch_us(ts))")} AS from_epoch,
           CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
           strftime(ts, '%Y%m') AS month_key, strftime(ts, '%B %Y') AS month_name, strftime(ts, '%b-%Y') AS month_tag,
           'Q' || quarter(ts) || year(ts) AS quarter_label
    FROM events
""")
def event_date_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    seconds = dates.micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)
    return t.events.select(
        "event_id",
        stamp(dates.bucket_floor(ts)).alias("bucket"),
        stamp(dates.epoch_seconds(seconds)).alias("from_epoch"),
        dates.date_key(ts).alias("date_key"),
        dates.month_key(ts).alias("month_key"),
        dates.month_name(ts).alias("month_name"),
        dates.month_tag(ts).alias("month_tag"),
        dates.quarter_label(ts).alias("quarter_label"),
    )


@query("""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS calendar_id,
           strftime(date_trunc('month', d), '%Y-%m-%d') AS monthly, strftime(date_trunc('week', d), '%Y-%m-%d') AS weekly,
           strftime(d, '%Y-%m-%d') AS daily,
           CAST(strftime(date_trunc('month', d), '%Y%m%d') AS INTEGER) AS month_id,
           CAST(strftime(date_trunc('week', d), '%Y%m%d') AS INTEGER) AS week_id
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
""")
def period_starts(t: Tables) -> DataFrame:
    day = F.col("date_actual")
    starts = [F.date_format(dates.period_start(day, c), "yyyy-MM-dd").alias(c) for c in dates.CADENCES]
    return calendar(t).select(
        "calendar_id", *starts, F.col("month_start_calendar_id").alias("month_id"), F.col("week_start_calendar_id").alias("week_id")
    )


@query("""
    SELECT p_partkey, p_brand || '-' || lpad(CAST(p_size AS VARCHAR), 4, '0') AS order_key,
           upper(split_part(p_name, ' ', 1)) AS first_word, split_part(p_name, ' ', 2) AS second_word,
           CASE WHEN p_type = 'ECONOMY' THEN TRUE ELSE FALSE END AS blank,
           CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL') THEN p_size END AS strict, p_type = 'SMALL' AS bad
    FROM part
""")
def text_functions(t: Tables) -> DataFrame:
    """Economy parts have a blank size, small parts one that is no integer."""
    size = F.when(F.col("p_type") == "ECONOMY", "  ").when(
        F.col("p_type") == "SMALL", F.concat(F.col("p_size").cast("string"), F.lit("x"))
    ).otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
    return t.part.select(
        "p_partkey",
        text.order_key(F.col("p_brand"), F.col("p_size")).alias("order_key"),
        F.upper(text.part(F.col("p_name"), " ", 1)).alias("first_word"),
        text.part(F.col("p_name"), " ", 2).alias("second_word"),
        text.is_blank(size).alias("blank"),
        text.strict_integer(size).cast("int").alias("strict"),
        text.is_bad_integer(size).alias("bad"),
    )


@query("""
    SELECT p_partkey, p_brand || '|' || p_type || '|a,"b' AS elements, 4 AS n, TRUE AS last_is_null,
           0 AS empty_size, TRUE AS text_is_null
    FROM part
""")
def array_repair(t: Tables) -> DataFrame:
    literal = F.concat(F.lit("{"), "p_brand", F.lit(","), "p_type", F.lit(r',"a,\"b",NULL}'))
    array = text.pg_array_to_array(literal)
    return t.part.select(
        "p_partkey",
        F.array_join(F.slice(array, 1, 3), "|").alias("elements"),
        F.size(array).alias("n"),
        F.get(array, F.lit(3)).isNull().alias("last_is_null"),
        F.size(text.pg_array_to_array(F.lit("{}"))).alias("empty_size"),
        text.pg_array_to_array(F.col("p_name")).isNull().alias("text_is_null"),
    )


@query("""
    SELECT event_id FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00' AND ts >= TIMESTAMP '2024-01-12'
      AND ts < TIMESTAMP '2024-01-20'
""")
def time_range(t: Tables) -> DataFrame:
    inclusive = filters.between(t.events, "ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20, 12))
    return filters.in_period(inclusive, "ts", dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 20)).select("event_id")


@query("""
    SELECT 'included' AS part, r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('ASIA', 'EUROPE')
    UNION ALL
    SELECT 'excluded', r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name NOT IN ('ASIA', 'EUROPE')
""")
def issuer_lists(t: Tables) -> DataFrame:
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name")
    names = ["ASIA", "EUROPE"]
    included = filters.issuer_filter(rows, included=names, issuer="r_name")
    excluded = filters.issuer_filter(rows, excluded=names, issuer="r_name")
    return included.select(F.lit("included").alias("part"), "*").unionByName(excluded.select(F.lit("excluded").alias("part"), "*"))


@query(f"""
    SELECT service_provider_id, issuer FROM ({SQL_PROVIDERS})
    WHERE iaa_end_date > DATE '1996-06-30' AND DATE '1996-06-30' >= launch_date
""")
def providers_in_force(t: Tables) -> DataFrame:
    return filters.in_force(providers(t), dt.date(1996, 6, 30)).select("service_provider_id", "issuer")


@query("""
    SELECT 'active' AS scope, count(*) AS profiles FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'verified', count(*) FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'pending', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT 'unprocessed', count(*) FROM orders WHERE o_orderstatus = 'P'
""")
def profile_scopes(t: Tables) -> DataFrame:
    when = F.col("o_orderdate")
    profiles = t.orders.select(
        (F.col("o_orderstatus") == "O").alias("active"),
        F.when(F.col("o_orderstatus") != "P", when).alias("verified_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", when).alias("fraud_rejection_at"),
        F.when(F.col("o_orderpriority") == "5-LOW", when).alias("fraud_review_pending_at"),
    )
    scopes = {
        "active": filters.active(profiles),
        "verified": filters.verified(profiles),
        "rejected": filters.fraud_rejection(profiles),
        "pending": filters.fraud_review_pending(profiles),
        "unprocessed": filters.unprocessed(profiles, "verified_at"),
    }
    counts = [df.agg(F.lit(name).alias("scope"), F.count(F.lit(1)).alias("profiles")) for name, df in scopes.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


@query(f"""
    SELECT event_id FROM events
    WHERE event_type IN ('signup', 'purchase') AND {SQL_K} = 7
""")
def json_predicates(t: Tables) -> DataFrame:
    named = t.events.filter(F.col("event_type").isin("signup", "purchase"))
    documents = jsonpath.with_document(named, F.col("props"), ["k", "no.such.path"])
    missing = jsonpath.field_equals("no.such.path", True)
    return documents.filter(jsonpath.field_equals("k", 7) & ~missing).select("event_id")


@query(f"""
    SELECT event_id, CASE WHEN event_id % 8 IN (0, 1, 2) THEN {SQL_K} END AS k FROM events
""")
def json_whole_documents(t: Tables) -> DataFrame:
    """The properties as they are, nested, with braces in a string, and followed by five kinds of other text."""
    number = (F.col("event_id") % 8).cast("int")
    nested = F.concat(F.lit('{"p":{"a":[{"x":1},{"y":"}"}]},'), F.substring("props", F.lit(2), F.length("props")))
    in_text = F.concat(F.lit('{"s":"{","t":"},{",'), F.substring("props", F.lit(2), F.length("props")))
    behind = F.array(*map(F.lit, ("", "", "", ',{"k":1}', "}", ',"junk"}', ',"x":{"k":2}', "]")))
    whole = F.when(number == 1, nested).when(number == 2, in_text).otherwise(F.col("props"))
    texts = t.events.select("event_id", F.concat(whole, F.get(behind, number)).alias("text"))
    return jsonpath.with_document(texts, F.col("text"), ["k"]).select("event_id", jsonpath.field("k", "int").alias("k"))


@query("""
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS DECIMAL(15,2))::DOUBLE AS l_extendedprice
    FROM lineitem
""")
def cast_list(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    cast = filters.cast_columns(rows, {"l_quantity": "string", "l_extendedprice": "decimal(15,2)"})
    return filters.cast_columns(cast, {"l_extendedprice": "double"})
