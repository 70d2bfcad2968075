"""Streams over the sample tables as file sources, drained, and decryption."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.bindings.load_queries import SPEC, SQL_LATE, existing_logs
from weirstone.bindings.quality_queries import SQL_LOGIN_WINDOWS
from weirstone.bindings.registry import SQL_K, Tables, k, query, sql_stamp, stamp
from weirstone.bindings.sample_logs import SQL_EVENT_COLUMNS, raw_events
from weirstone.functions.dates import instant
from weirstone.operators.decrypt import Processed, aes_gcm, decryption, process_encrypted, register_decryptor
from weirstone.operators.quality import watched_login_windows
from weirstone.operators.upsert import upsert
from weirstone.session import fresh_dir
from weirstone.sources.bucket_stream import stream_buckets
from weirstone.sources.buckets import bucket_name
from weirstone.sources.file_rewrite import read_files, upsert_files
from weirstone.sources.logs import stream_raw_logs
from weirstone.streaming.decrypt import decrypt_stream, decrypted_events, expired_events, failed_events
from weirstone.streaming.exports import large_export_stream
from weirstone.streaming.ingest import current_events, fold_batches, ingest_buckets, ingest_events, rejected_events
from weirstone.streaming.logins import watched_login_stream
from weirstone.streaming.logs import compact_logs, current_logs, extract_logs, fold_logs, folded_rejects
from weirstone.streaming.retries import Retries, pending
from weirstone.streaming.runner import drain_to_files

def stream_table(t: Tables, name: str) -> DataFrame:
    """A sample table as a file stream; times become zoned, as watermarks need."""
    schema = getattr(t, name).schema
    stream = t.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.root)
    zoned = {f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"}
    return stream.withColumns(zoned) if zoned else stream


@query(f"""
    WITH closed AS (
        SELECT user_id || ':' || event_type AS event_key, time_bucket(INTERVAL '5 minutes', ts) AS bucket, ts, props AS message
        FROM events
        WHERE time_bucket(INTERVAL '5 minutes', ts) <> (SELECT time_bucket(INTERVAL '5 minutes', max(ts)) FROM events)
    )
    SELECT event_key, message, 'fraud-ops-events:' || strftime(bucket, '%Y-%m-%dT%H:%M:%SZ') AS bucket_name,
           strftime(bucket, '%Y-%m-%d') AS partition_dt, '2024-02-01 00:00:00.000000' AS dw_created_at
    FROM closed
    QUALIFY row_number() OVER (PARTITION BY event_key, CAST(bucket AS DATE) ORDER BY bucket DESC, ts DESC, message DESC) = 1
""")
def ingest_stream(t: Tables) -> DataFrame:
    """All that has arrived but the bucket that is open at the time of the last event."""
    return current_events(t.spark, ingested(t), last_event(t)).select(
        "event_key", "message", "bucket_name", F.col("partition_dt").cast("string").alias("partition_dt"),
        stamp("dw_created_at").alias("dw_created_at"),
    )


SQL_HOUR = "time_bucket(INTERVAL '60 minutes', ts)"


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, props AS message, 'fraud-ops-events:' || strftime({SQL_HOUR}, '%Y-%m-%dT%H:%M:%SZ') AS bucket_name,
           strftime({SQL_HOUR}, '%Y-%m-%d') AS partition_dt, '2024-02-01 00:00:00.000000' AS dw_created_at
    FROM events WHERE {SQL_HOUR} <> (SELECT max({SQL_HOUR}) FROM events)
""")
def bucket_stream_events(t: Tables) -> DataFrame:
    """Folders of hourly buckets, drained in batches of 4000 rows, up to 256 of them at a time; the hour
    of the last event is open."""
    work = fresh_dir(t.spark, "buckets")
    rows = t.events.select(F.col("event_id").cast("string").alias("event_key"), F.col("props").alias("message"), bucket_name(F.col("ts"), 60).alias("bucket_name"))
    rows.repartition("bucket_name").write.partitionBy("bucket_name").parquet(f"{work}/in")
    stream = stream_buckets(t.spark, f"{work}/in", limit=4000, as_of=last_event(t), minutes=60, batches=256)
    ingest_buckets(stream, f"{work}/batches", f"{work}/checkpoint", loaded_at=instant(dt.datetime(2024, 2, 1)))
    later = current_events(t.spark, f"{work}/batches", last_event(t) + dt.timedelta(days=1))
    return later.select("event_key", "message", "bucket_name", F.col("partition_dt").cast("string").alias("partition_dt"), stamp("dw_created_at").alias("dw_created_at"))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_key, 'table' AS place FROM events WHERE event_type <> 'error'
    UNION ALL SELECT CAST(event_id AS VARCHAR), 'rejected' FROM events WHERE event_type = 'error'
""")
def undated_events(t: Tables) -> DataFrame:
    """Errors come without a time. Two ingests and two folds, the second of which touches the days of the first."""
    work = fresh_dir(t.spark, "undated")
    stamped = t.events.select(
        F.col("event_id").cast("string").alias("event_key"), F.col("props").alias("message"), F.when(F.col("event_type") != "error", F.col("ts")).cast("timestamp").alias("ts"), (F.col("event_id") % 2).alias("half")
    )
    for half in range(2):
        stamped.filter(F.col("half") == half).drop("half").write.mode("append").parquet(f"{work}/in")
        stream = t.spark.readStream.schema("event_key string, message string, ts timestamp").parquet(f"{work}/in")
        ingest_events(stream, f"{work}/batches", f"{work}/checkpoint")
        table = fold_batches(t.spark, f"{work}/batches", f"{work}/table", last_event(t) + dt.timedelta(days=1))
    rejects = rejected_events(t.spark, f"{work}/batches")
    return table.select("event_key", F.lit("table").alias("place")).unionByName(rejects.select("event_key", F.lit("rejected").alias("place")))


def ingested(t: Tables) -> str:
    work = fresh_dir(t.spark, "ingest")
    stream = stream_table(t, "events").select(
        F.concat_ws(":", "user_id", "event_type").alias("event_key"), F.col("props").alias("message"), "ts"
    )
    ingest_events(stream, f"{work}/batches", f"{work}/checkpoint", loaded_at=instant(dt.datetime(2024, 2, 1)))
    return f"{work}/batches"


def last_event(t: Tables) -> dt.datetime:
    return t.events.agg(F.max("ts")).first()[0]


@query("""
    SELECT user_id || ':' || event_type AS event_key, props AS message, strftime(ts, '%Y-%m-%d') AS partition_dt
    FROM events
    QUALIFY row_number() OVER (PARTITION BY event_key, CAST(ts AS DATE) ORDER BY ts DESC, message DESC) = 1
""")
def fold_batches_events(t: Tables) -> DataFrame:
    """A day after the last event every bucket is closed and every batch is folded."""
    batches = ingested(t)
    table = fold_batches(t.spark, batches, fresh_dir(t.spark, "encrypted"), last_event(t) + dt.timedelta(days=1))
    return table.select("event_key", "message", F.col("partition_dt").cast("string").alias("partition_dt"))


@query(f"WITH e AS (SELECT {SQL_EVENT_COLUMNS}) {SQL_LATE}")
def log_stream(t: Tables) -> DataFrame:
    """Raw rows written as files, streamed, extracted; then the current rows."""
    work = fresh_dir(t.spark, "logs")
    raw_events(t).withColumn("cloudwatch_timestamp", F.col("cloudwatch_timestamp").cast("timestamp")).write.parquet(f"{work}/raw")
    extract_logs(stream_raw_logs(t.spark, f"{work}/raw"), SPEC, "id", f"{work}/table", f"{work}/checkpoint")
    current = current_logs(t.spark, f"{work}/table", "id")
    return current.withColumns({c: stamp(c) for c in ("time", "cloudwatch_timestamp")})


@query(f"""
    WITH e AS (SELECT {SQL_EVENT_COLUMNS})
    SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'error' THEN 'newer' ELSE 'late' END AS name
    FROM e WHERE n NOT IN (0, 1)
    UNION ALL SELECT 'x' || event_id, 'other' FROM e
""")
def compact_logs_events(t: Tables) -> DataFrame:
    """Batches are compacted; then another load makes some rows newer; these survive the next one."""
    work = fresh_dir(t.spark, "logs")
    raw_events(t).withColumn("cloudwatch_timestamp", F.col("cloudwatch_timestamp").cast("timestamp")).write.parquet(f"{work}/raw")
    extract_logs(stream_raw_logs(t.spark, f"{work}/raw"), SPEC, "id", f"{work}/table", f"{work}/checkpoint")
    other = existing_logs(t).filter("id like 'x%'").withColumn("cloudwatch_timestamp", F.col("cloudwatch_timestamp").cast("timestamp"))
    first = compact_logs(t.spark, other, f"{work}/table", "id", f"{work}/first")
    errors = t.events.filter("event_type = 'error'").select(F.col("event_id").cast("string").alias("id"))
    newer = first.join(errors, "id", "left_semi").withColumn("name", F.lit("newer")).select(*first.columns)
    second = compact_logs(t.spark, upsert(first, newer, ["id"]), f"{work}/table", "id", f"{work}/second")
    return second.select("id", "name")


@query(f"""
    WITH e AS (SELECT {SQL_EVENT_COLUMNS})
    SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'error' THEN 'newer' ELSE 'late' END AS name FROM e WHERE n NOT IN (0, 1)
    UNION ALL SELECT NULL, 'rejected' FROM e, range(4) WHERE n IN (0, 1)
""")
def fold_logs_events(t: Tables) -> DataFrame:
    """Batches are folded; another load makes errors newer; the raw rows come again and change nothing."""
    work = fresh_dir(t.spark, "logs")
    table = f"{work}/table"
    raw = raw_events(t).withColumn("cloudwatch_timestamp", F.col("cloudwatch_timestamp").cast("timestamp"))
    for turn in range(2):
        raw.write.mode("append").parquet(f"{work}/raw")
        extract_logs(stream_raw_logs(t.spark, f"{work}/raw"), SPEC, "id", f"{work}/batches", f"{work}/checkpoint")
        fold_logs(t.spark, f"{work}/batches", table, "id", f"{work}/staging{turn}")
        if turn == 0:
            held = read_files(t.spark, table)
            errors = t.events.filter("event_type = 'error'").select(F.col("event_id").cast("string").alias("id"))
            later = F.col("cloudwatch_timestamp") + F.expr("INTERVAL 1 DAY")
            newer = held.join(errors, "id", "left_semi").withColumns({"name": F.lit("newer"), "cloudwatch_timestamp": later})
            upsert_files(newer.select(*held.columns), table, ["id"], f"{work}/newer")
    rejects = folded_rejects(t.spark, table).select(F.lit(None).cast("string").alias("id"), F.lit("rejected").alias("name"))
    return read_files(t.spark, table).select("id", "name").unionByName(rejects)


@query(SQL_LOGIN_WINDOWS.format(where=""))
def login_stream(t: Tables) -> DataFrame:
    """An alert per login, and their windows when they are read."""
    work = fresh_dir(t.spark, "logins")
    stream = stream_table(t, "events").select(
        F.concat(F.lit(" user-"), "user_id").alias("user_name"), F.col("event_type").alias("event"), F.col("ts").alias("record_time")
    )
    alerts = watched_login_stream(stream, users=None, event="signup")
    drain_to_files(alerts, f"{work}/alerts", f"{work}/checkpoint")
    rows = watched_login_windows(t.spark.read.schema(alerts.schema).parquet(f"{work}/alerts"), None)
    return rows.withColumns({c: stamp(c) for c in ("window_start", "window_end")})


@query("""
    SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d %H:%M') AS starttime, strftime(l_shipdate, '%Y-%m-%d %H:%M') AS endtime,
           l_quantity AS line_count
    FROM lineitem WHERE l_quantity > 45
""")
def export_stream(t: Tables) -> DataFrame:
    work = fresh_dir(t.spark, "exports")
    stream = stream_table(t, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").alias("start_time"), F.col("l_shipdate").alias("end_time"), F.col("l_quantity").alias("line_count")
    )
    alerts = large_export_stream(stream, lines=45)
    drain_to_files(alerts, f"{work}/alerts", f"{work}/checkpoint")
    return t.spark.read.schema(alerts.schema).parquet(f"{work}/alerts")


def encrypted_events(t: Tables) -> DataFrame:
    """Events encrypted with AES-GCM. Number 0 is no base64, number 1 encrypted with another key."""
    payload = F.struct(
        "user_id",
        F.concat(F.lit("uuid-"), "user_id").alias("user_uuid"),
        (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)").alias("occurred_at"),
    )
    events = F.map_from_arrays(F.array(F.concat(F.lit("urn:type:"), "event_type")), F.array(payload))
    text = F.to_json(F.struct(F.col("event_id").cast("string").alias("jti"), events.alias("events")))
    number = k()
    secret = F.when(number == 1, secret_key("another key 0000")).otherwise(secret_key())
    message = F.when(number == 0, "no cipher text!").otherwise(F.base64(F.aes_encrypt(text, secret, F.lit("GCM"))))
    processed = F.when(F.col("event_type") == "error", F.col("ts").cast("timestamp"))
    return t.events.select(
        F.col("event_id").cast("string").alias("event_key"), message.alias("message"), processed.alias("dw_processed_at"),
        F.col("ts").cast("date").alias("partition_dt"),
    )


def secret_key(text: str = "sixteen byte key") -> Column:
    return F.encode(F.lit(text), "UTF-8")


SQL_PLAIN = f"""'{{{{"jti":"' || event_id || '","events":{{{{"urn:type:' || event_type || '":{{{{"user_id":' || user_id || ',"user_uuid":"uuid-' ||
           user_id || '","occurred_at":' || epoch_us(ts) // 1000000 || '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') || '}}}}}}}}}}}}'"""
SQL_PLAIN_IN = SQL_PLAIN.replace("{{", "{").replace("}}", "}")
SQL_DECRYPTED = f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, {SQL_PLAIN} AS message, user_id, 'uuid-' || user_id AS user_uuid,
           {sql_stamp("ts")} AS event_timestamp, 'ok' AS status
    FROM events WHERE {{where}} {SQL_K} NOT IN (0, 1)
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), NULL, NULL, NULL, NULL, 'failed' FROM events WHERE {{where}} {SQL_K} IN (0, 1)
"""


def decryption_result(rows: DataFrame) -> DataFrame:
    return rows.select("event_key", "message", "user_id", "user_uuid", stamp("event_timestamp").alias("event_timestamp"), "status")


@query(SQL_DECRYPTED.format(where=""))
def decrypted(t: Tables) -> DataFrame:
    """One pass over all rows: whole message, time to the microsecond, failures with their status."""
    return decryption_result(decryption(encrypted_events(t), aes_gcm(secret_key()), dt.datetime(2024, 2, 1)))


@query(f"SELECT CAST(event_id AS VARCHAR) AS event_key, CASE WHEN {SQL_K} NOT IN (0, 1) THEN user_id END AS user_id FROM events")
def decrypt_sql_function(t: Tables) -> DataFrame:
    """Decryption as an SQL function, without Python."""
    register_decryptor(t.spark, "encode('sixteen byte key', 'UTF-8')")
    text = F.expr("decrypt_message(message)")
    user = F.get_json_object(text, "$.jti").isNotNull() & text.isNotNull()
    inner = F.from_json(F.get_json_object(text, "$.events"), "map<string,struct<user_id bigint>>")
    return encrypted_events(t).select("event_key", F.when(user, F.get(F.map_values(inner), F.lit(0))["user_id"]).alias("user_id"))


@query(SQL_DECRYPTED.format(where="event_type <> 'error' AND"))
def decrypt_unprocessed_stream(t: Tables) -> DataFrame:
    work = fresh_dir(t.spark, "decrypt")
    encrypted = encrypted_events(t)
    encrypted.write.parquet(f"{work}/encrypted")
    stream = t.spark.readStream.schema(encrypted.schema).parquet(f"{work}/encrypted")
    decrypt_stream(stream, aes_gcm(secret_key()), dt.datetime(2024, 2, 1), f"{work}/events", f"{work}/checkpoint")
    good = decrypted_events(t.spark, f"{work}/events").withColumn("status", F.lit("ok"))
    bad = failed_events(t.spark, f"{work}/events").select("event_key", F.lit("failed").alias("status"))
    return decryption_result(good.unionByName(bad, allowMissingColumns=True))


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, CASE WHEN {SQL_K} <> 0 THEN user_id END AS user_id,
           CASE WHEN {SQL_K} = 0 THEN 'expired' ELSE 'ok' END AS status
    FROM events WHERE event_type <> 'error'
""")
def decrypt_retry_stream(t: Tables) -> DataFrame:
    """What fails is kept as state. A day later, with the other key, it is due: some rows come right, the rest expires."""
    work = fresh_dir(t.spark, "retries")
    encrypted = encrypted_events(t)
    encrypted.write.parquet(f"{work}/encrypted")
    stream = t.spark.readStream.schema(encrypted.schema).parquet(f"{work}/encrypted")
    policy = Retries(dt.timedelta(hours=12), attempts=2)
    for day, key in enumerate((secret_key(), secret_key("another key 0000")), 1):
        decrypt_stream(stream, aes_gcm(key), dt.datetime(2024, 2, day), f"{work}/events", f"{work}/checkpoint", policy)
    good = decrypted_events(t.spark, f"{work}/events").select("event_key", "user_id", F.lit("ok").alias("status"))
    gone = expired_events(t.spark, f"{work}/events").select("event_key", F.lit("expired").alias("status"))
    waiting = pending(t.spark, f"{work}/events").select("event_key", F.lit("pending").alias("status"))
    return good.unionByName(gone, allowMissingColumns=True).unionByName(waiting, allowMissingColumns=True)


def processed(t: Tables) -> Processed:
    """Purchases are in the event table already, under their keys, with an older message."""
    events = t.events.filter("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("event_key"), F.lit("older").alias("message"),
        F.lit(None).cast("bigint").alias("user_id"), F.lit("old uuid").alias("user_uuid"),
        F.lit(None).cast("timestamp").alias("event_timestamp"), F.col("ts").cast("timestamp").alias("dw_created_at"),
    )
    return process_encrypted(encrypted_events(t), events, aes_gcm(secret_key()), dt.datetime(2024, 2, 1), fresh_dir(t.spark, "process"))


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, {SQL_PLAIN_IN} AS message, user_id, 'uuid-' || user_id AS user_uuid,
           {sql_stamp("ts")} AS event_timestamp, '2024-02-01 00:00:00.000000' AS dw_created_at
    FROM events WHERE event_type <> 'error' AND {SQL_K} NOT IN (0, 1)
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), 'older', NULL, 'old uuid', NULL, {sql_stamp("ts")} FROM events WHERE event_type = 'purchase' AND {SQL_K} IN (0, 1)
""")
def decrypted_event_table(t: Tables) -> DataFrame:
    events = processed(t).events
    return events.withColumns({c: stamp(c) for c in ("event_timestamp", "dw_created_at")})


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key,
           CASE WHEN event_type = 'error' THEN {sql_stamp("ts")} WHEN {SQL_K} NOT IN (0, 1) THEN '2024-02-01 00:00:00.000000' END AS dw_processed_at
    FROM events
""")
def encrypted_event_marks(t: Tables) -> DataFrame:
    return processed(t).encrypted.select("event_key", stamp("dw_processed_at").alias("dw_processed_at"))
