"""Raw log rows made from the sample events and line items, by Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.registry import SQL_K, Tables, k
from weirstone.operators.extract import JsonColumn


def iso(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def event_message(value: Column, kind: Column) -> Column:
    """Message of one event. Number 0 has no id; number 1 is cut off and so no JSON; an error's
    pid is no number."""
    number = k()
    properties = F.struct(
        F.lit(True).alias("new_event"),
        F.concat(F.lit("/"), kind).alias("path"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(kind == "error", "none").otherwise(number.cast("string")).alias("pid"),
        F.lit(None).cast("string").alias("service_provider"),
        (value > 100).alias("browser_mobile"),
        F.struct((kind != "error").alias("success")).alias("event_properties"),
    )
    document = F.to_json(
        F.struct(
            F.when(number != 0, F.col("event_id").cast("string")).alias("id"),
            kind.alias("name"),
            iso("ts").alias("time"),
            F.lit("events.log").alias("log_filename"),
            properties.alias("properties"),
        ),
        {"ignoreNullFields": "false"},
    )
    return F.when(number == 1, F.substring(document, F.lit(1), F.length(document) - 1)).otherwise(document)


def sql_event_message(kind: str, value: str) -> str:
    """The text of ``event_message`` in SQL, from event_id, n, ts and user_id."""
    document = f"""'{{"id":' || CASE WHEN n = 0 THEN 'null' ELSE '"' || event_id || '"' END || ',"name":"' || {kind} || '","time":"' ||
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","log_filename":"events.log","properties":{{"new_event":true,"path":"/' || {kind} ||
        '","user_id":"' || user_id || '","pid":"' || CASE WHEN {kind} = 'error' THEN 'none' ELSE CAST(n AS VARCHAR) END ||
        '","service_provider":null,"browser_mobile":' || ({value} > 100) || ',"event_properties":{{"success":' || ({kind} <> 'error') || '}}}}}}'"""
    return f"CASE WHEN n = 1 THEN left({document}, length({document}) - 1) ELSE {document} END"


def sql_other_columns(spec: Sequence[JsonColumn], *made: str) -> str:
    """The columns that no sample message holds, as NULL."""
    return ", ".join(f'NULL AS "{c.column}"' for c in spec if c.column not in made)


def raw_events(t: Tables) -> DataFrame:
    """Every event twice: as it is, and a minute later with a doubled value and kind ``late``."""
    events = t.events
    first = events.select(event_message(F.col("value"), F.col("event_type")).alias("message"), F.col("ts").alias("cloudwatch_timestamp"))
    later = events.select(
        event_message(F.col("value") * 2, F.lit("late")).alias("message"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("cloudwatch_timestamp"),
    )
    return first.unionByName(later)


SQL_EVENT_COLUMNS = f"""
    event_id, {SQL_K} AS n, event_type, ts, user_id, value
    FROM events
"""


def raw_requests(t: Tables) -> DataFrame:
    """One request per line item."""
    line = t.lineitem
    document = F.to_json(
        F.struct(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("uuid"),
            F.when(F.col("l_returnflag") == "R", "POST").otherwise("GET").alias("method"),
            F.lit("/api/health").alias("path"),
            (F.lit(200) + F.col("l_linenumber")).alias("status"),
            iso("l_shipdate").alias("timestamp"),
            F.col("l_suppkey").alias("pid"),
            F.col("l_extendedprice").cast("decimal(15,4)").alias("duration"),
            F.lit(None).cast("string").alias("trace_id"),
        ),
        {"ignoreNullFields": "false"},
    )
    return line.select(document.alias("message"), F.col("l_shipdate").alias("cloudwatch_timestamp"))
