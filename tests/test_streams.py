"""Streams drain to what the batch form gives, and replays change nothing."""

import datetime as dt
import json

from pyspark.sql import functions as F

from weirstone.operators.decrypt import aes_gcm
from weirstone.operators.extract import EVENT_COLUMNS
from weirstone.operators.quality import watched_login_windows
from weirstone.sources.bucket_stream import stream_buckets
from weirstone.sources.buckets import bucket_name
from weirstone.sources.logs import RAW_LOG_SCHEMA, read_raw_logs, stream_raw_logs
from weirstone.streaming.batches import folded_batch, retire
from weirstone.streaming.decrypt import decrypt_stream, decrypted_events, failed_events
from weirstone.streaming.exports import large_export_stream
from weirstone.streaming.ingest import ENCRYPTED_SCHEMA, current_events, fold_batches, ingest_buckets, ingest_events, merge_encrypted, rejected_events
from weirstone.streaming.logins import watched_login_stream
from weirstone.streaming.logs import compact_logs, current_logs, extract_logs, fold_logs, folded_rejects, rejected_rows
from weirstone.streaming.runner import drain_to_files

from helpers import rows, ts

EVENT = "event_key string, message string, ts timestamp"
LOADED = "2024-01-02 00:00:00"


def feed(spark, path, data, schema=EVENT):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


NOW = ts("2024-01-03 00:00:00")


def ingest(spark, tmp_path, as_of=NOW, files_per_batch=100):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_batch).parquet(f"{tmp_path}/in")
    ingest_events(stream, f"{tmp_path}/batches", f"{tmp_path}/checkpoint", loaded_at=F.lit(ts(LOADED)))
    return current_events(spark, f"{tmp_path}/batches", as_of)


def test_rerun_adds_only_new_rows(spark, tmp_path):
    first = [(f"k{n:02}", "m", ts("2024-01-01 10:01:00")) for n in range(50)]
    feed(spark, f"{tmp_path}/in", first)
    assert ingest(spark, tmp_path).count() == 50
    assert ingest(spark, tmp_path).count() == 50
    again = [(k, "m2", ts("2024-01-01 10:06:00")) for k, _, _ in first] + [(f"n{n}", "m", ts("2024-01-01 10:07:00")) for n in range(5)]
    feed(spark, f"{tmp_path}/in", [*again])
    table = ingest(spark, tmp_path)
    assert table.count() == 55
    assert rows(table.filter("event_key like 'k%'").select("message", "bucket_name", "dw_created_at").distinct()) == [
        ("m2", "fraud-ops-events:2024-01-01T10:05:00Z", ts(LOADED))
    ]


def test_open_bucket_waits(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [("a", "open", ts("2024-01-01 10:06:00")), ("b", "open", ts("2024-01-01 10:09:59")), ("c", "before", ts("2024-01-01 10:04:00"))])
    assert rows(ingest(spark, tmp_path, ts("2024-01-01 10:09:59")), "event_key") == [("c",)]
    # the bucket closes with the clock; no newer event is needed for the tail of a quiet source
    assert rows(ingest(spark, tmp_path, ts("2024-01-01 10:10:00")), "event_key") == [("a",), ("b",), ("c",)]


def test_late_rows_and_late_updates_arrive(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [("a", "first", ts("2024-01-01 10:02:00")), ("clock", "", ts("2024-01-01 11:00:00"))])
    ingest(spark, tmp_path)
    feed(spark, f"{tmp_path}/in", [("new", "late", ts("2024-01-01 10:02:00")), ("a", "newer", ts("2024-01-01 10:03:00")), ("clock", "older", ts("2024-01-01 10:30:00"))])
    for _ in range(2):
        assert rows(ingest(spark, tmp_path), "event_key", "message") == [("a", "newer"), ("clock", ""), ("new", "late")]


def test_key_on_two_days_whatever_the_batches(spark, tmp_path):
    for n, files in enumerate((1, 100)):
        at = tmp_path / str(n)
        feed(spark, f"{at}/in", [("a", "one", ts("2024-01-01 10:00:00"))])
        feed(spark, f"{at}/in", [("a", "two", ts("2024-01-02 10:00:00"))])
        table = ingest(spark, at, files_per_batch=files)
        assert rows(table, "message", "partition_dt") == [("one", dt.date(2024, 1, 1)), ("two", dt.date(2024, 1, 2))]


def test_last_write_in_the_latest_bucket_wins(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [
        ("a", "late in bucket", ts("2024-01-01 10:01:30")), ("a", "early in bucket", ts("2024-01-01 10:01:00")),
        ("b", "old bucket", ts("2024-01-01 10:02:00")), ("b", "new bucket", ts("2024-01-01 10:07:00")),
    ])
    assert rows(ingest(spark, tmp_path), "event_key", "message") == [("a", "late in bucket"), ("b", "new bucket")]


def test_fold_touches_its_days_only_and_retires_batches(spark, tmp_path):
    batches, table = f"{tmp_path}/batches", f"{tmp_path}/table"
    feed(spark, f"{tmp_path}/in", [("a", "m", ts("2024-01-01 23:50:00")), ("b", "m", ts("2024-01-02 00:01:00"))])
    ingest(spark, tmp_path)
    assert rows(fold_batches(spark, batches, table, ts("2024-01-02 00:02:00")), "event_key") == []  # b's bucket is open
    once = rows(fold_batches(spark, batches, table, NOW), "event_key", "message", "dw_created_at", "dw_processed_at")
    assert once == [("a", "m", ts(LOADED), None), ("b", "m", ts(LOADED), None)]
    assert not list((tmp_path / "batches").glob("batch_id=*"))
    first_day = sorted(p.name for p in (tmp_path / "table" / "partition_dt=2024-01-01").glob("*.parquet"))

    feed(spark, f"{tmp_path}/in", [("b", "again", ts("2024-01-02 00:11:00"))])
    feed(spark, f"{tmp_path}/in", [("b", "older bucket", ts("2024-01-02 00:06:00")), ("c", "late", ts("2024-01-02 00:02:00"))])
    ingest(spark, tmp_path, files_per_batch=1)
    for _ in range(2):
        folded = fold_batches(spark, batches, table, NOW)
        assert rows(folded, "event_key", "message") == [("a", "m"), ("b", "again"), ("c", "late")]
    feed(spark, f"{tmp_path}/in", [("b", "older still", ts("2024-01-02 00:03:00"))])
    ingest(spark, tmp_path)
    assert rows(fold_batches(spark, batches, table, NOW), "event_key", "message") == [("a", "m"), ("b", "again"), ("c", "late")]
    assert sorted(p.name for p in (tmp_path / "table" / "partition_dt=2024-01-01").glob("*.parquet")) == first_day


def test_rows_without_a_time_are_rejects_and_no_fold_loses_a_row(spark, tmp_path):
    batches, table = f"{tmp_path}/batches", f"{tmp_path}/table"
    feed(spark, f"{tmp_path}/in", [("a", "m", ts("2024-01-01 10:00:00")), ("n1", "no time", None)])
    assert rows(ingest(spark, tmp_path), "event_key") == [("a",)]
    fold_batches(spark, batches, table, NOW)
    feed(spark, f"{tmp_path}/in", [("b", "m", ts("2024-01-01 11:00:00")), ("n2", "no time", None)])
    ingest(spark, tmp_path)
    for _ in range(2):
        assert rows(fold_batches(spark, batches, table, NOW), "event_key") == [("a",), ("b",)]
    found = rejected_events(spark, batches)
    assert rows(found, "event_key", "message", "batch_id") == [("n1", "no time", 0), ("n2", "no time", 1)]
    assert rows(found.groupBy("batch_id").count()) == [(0, 1), (1, 1)]


def test_undated_rows_of_earlier_batches_are_folded(spark, tmp_path):
    """Batches from before rows without a time were rejects: no fold replaces what the other has brought."""
    batches, table = f"{tmp_path}/batches", f"{tmp_path}/table"
    for n in range(2):
        undated = spark.createDataFrame([(f"n{n}", "m", None, None, ts(LOADED), None)], "event_key string, message string, ts timestamp, bucket_name string, dw_created_at timestamp, partition_dt date")
        undated.write.partitionBy("partition_dt").parquet(f"{batches}/batch_id={n}")
        folded = fold_batches(spark, batches, table, NOW)
    assert rows(folded, "event_key", "partition_dt") == [("n0", None), ("n1", None)]


def test_buckets_are_drained_into_batches(spark, tmp_path):
    rows_in = spark.createDataFrame([(f"k{n}", "m", ts(f"2024-01-01 10:{n:02}:00")) for n in range(30)], EVENT)
    rows_in.withColumn("bucket_name", bucket_name(F.col("ts"))).drop("ts").write.partitionBy("bucket_name").parquet(f"{tmp_path}/buckets")
    as_of = ts("2024-01-01 10:27:00")
    for _ in range(2):
        ingest_buckets(stream_buckets(spark, f"{tmp_path}/buckets", limit=10, as_of=as_of), f"{tmp_path}/batches", f"{tmp_path}/checkpoint", F.lit(ts(LOADED)))
    assert rows(current_events(spark, f"{tmp_path}/batches", NOW), "event_key") == sorted((f"k{n}",) for n in range(25))
    assert len(list((tmp_path / "batches").glob("batch_id=*"))) == 3


def test_a_backlog_of_buckets_takes_one_turn(spark, tmp_path):
    rows_in = spark.createDataFrame([(f"k{n % 12}", f"m{n}", ts(f"2024-01-01 10:{n:02}:00")) for n in range(30)], EVENT)
    named = rows_in.withColumn("bucket_name", F.when(F.col("event_key") == "k3", "fraud-ops-events:no time").otherwise(bucket_name(F.col("ts"))))
    for way, batches in (("one", None), ("many", 50)):
        path = f"{tmp_path}/{way}"
        named.drop("ts").coalesce(1).write.partitionBy("bucket_name").parquet(f"{path}/buckets")
        for _ in range(2):
            stream = stream_buckets(spark, f"{path}/buckets", limit=4, as_of=NOW, batches=batches)
            ingest_buckets(stream, f"{path}/batches", f"{path}/checkpoint", F.lit(ts(LOADED)))
    assert rows(current_events(spark, f"{tmp_path}/many/batches", NOW)) == rows(current_events(spark, f"{tmp_path}/one/batches", NOW))
    assert rows(rejected_events(spark, f"{tmp_path}/many/batches"), "message") == [("m15",), ("m27",), ("m3",)]
    # as many batches, one micro-batch
    assert [len(list((tmp_path / way / "checkpoint" / "commits").glob("[0-9]*"))) for way in ("one", "many")] == [8, 1]
    folders = [{p.name for at in ("batches", "batches__rejected") for p in (tmp_path / way / at).glob("batch_id=*")} for way in ("one", "many")]
    assert [len(f) for f in folders] == [8, 8]


def test_merge_keeps_marks_and_first_load(spark):
    target = spark.createDataFrame([("a", "m", "b1", ts(LOADED), ts(LOADED), dt.date(2024, 1, 1))], ENCRYPTED_SCHEMA)
    update = spark.createDataFrame(
        [("a", "m2", "b2", ts("2025-01-01"), dt.date(2024, 1, 1)), ("a", "x", "b3", ts("2025-01-01"), dt.date(2024, 1, 2))],
        "event_key string, message string, bucket_name string, dw_created_at timestamp, partition_dt date",
    )
    once = merge_encrypted(target, update)
    assert rows(once, "message", "bucket_name", "dw_created_at", "dw_processed_at") == [
        ("m2", "b2", ts(LOADED), ts(LOADED)), ("x", "b3", ts("2025-01-01"), None),
    ]
    assert rows(merge_encrypted(once, update)) == rows(once)


def test_log_stream_equals_batch(spark, tmp_path):
    def message(key, name):
        return json.dumps({"id": key, "name": name, "properties": {"pid": 1}})

    def raw(data):
        spark.createDataFrame(data, RAW_LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{tmp_path}/raw")

    def drain():
        stream = stream_raw_logs(spark, f"{tmp_path}/raw", "json", files_per_batch=1)
        extract_logs(stream, EVENT_COLUMNS, "id", f"{tmp_path}/log", f"{tmp_path}/checkpoint")
        return current_logs(spark, f"{tmp_path}/log", "id")

    at = ts("2024-01-01 10:00:00")
    raw([(message("a", "one"), at), (message("a", "dup"), ts("2024-01-01 09:00:00")), ("{}", at), (message("b", "b"), at)])
    assert rows(drain(), "id", "name") == [("a", "one"), ("b", "b")]
    raw([(message("a", "two"), ts("2024-01-01 08:00:00")), ("bad", at)])
    merged = drain()
    assert rows(merged, "id", "name") == [("a", "two"), ("b", "b")]  # a later batch replaces, as an upsert does
    assert rows(drain()) == rows(merged)
    assert rows(rejected_rows(spark, f"{tmp_path}/log"), "message") == [("bad",), ("{}",)]
    snapshot = merged.filter("id = 'b'").withColumn("name", F.lit("old"))
    first = compact_logs(spark, snapshot, f"{tmp_path}/log", "id", f"{tmp_path}/v1")
    assert rows(first, "id", "name") == [("a", "two"), ("b", "b")]
    raw([(message("b", "three"), at)])
    drain()
    # a direct load that is newer than a folded batch survives; the new batch is merged
    direct = first.withColumn("name", F.when(F.col("id") == "a", "direct").otherwise(F.col("name")))
    second = compact_logs(spark, direct, f"{tmp_path}/log", "id", f"{tmp_path}/v2")
    assert rows(second, "id", "name") == [("a", "direct"), ("b", "three")]
    assert retire(spark, f"{tmp_path}/log", folded_batch(spark, f"{tmp_path}/log")) == [0, 1, 2]
    assert read_raw_logs(spark, f"{tmp_path}/raw", "json").count() == 7


def test_log_fold_goes_by_arrival_and_leaves_other_files(spark, tmp_path):
    def raw(*rows_in):
        data = [(json.dumps({"id": key, "name": name}) if key else "bad", ts(f"2024-01-01 {at}:00")) for key, name, at in rows_in]
        spark.createDataFrame(data, RAW_LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{tmp_path}/raw")
        extract_logs(stream_raw_logs(spark, f"{tmp_path}/raw", "json", files_per_batch=1), EVENT_COLUMNS, "id", f"{tmp_path}/log", f"{tmp_path}/checkpoint")

    def fold(n):
        return fold_logs(spark, f"{tmp_path}/log", f"{tmp_path}/table", "id", f"{tmp_path}/staging{n}")

    raw(("a", "one", "10:00"), (None, "", "10:00"), ("b", "late in batch", "10:05"), ("b", "early in batch", "10:01"))
    assert fold(0) == [] and fold(1) == []
    raw(("c", "new", "11:00"))
    assert fold(2) == []  # no file holds the key
    raw(("a", "older", "09:00"), ("c", "newer", "12:00"), (None, "", "13:00"))
    assert len(fold(3)) == 2
    table = spark.read.parquet(f"{tmp_path}/table")
    assert rows(table, "id", "name") == [("a", "one"), ("b", "late in batch"), ("c", "newer")]
    assert folded_rejects(spark, f"{tmp_path}/table").count() == 2
    assert not list((tmp_path / "log").glob("batch_id=*"))
    raw(("d", "new", "14:00"))
    fold(4)
    assert rows(spark.read.parquet(f"{tmp_path}/table"), "id") == [("a",), ("b",), ("c",), ("d",)]


def test_login_alerts(spark, tmp_path):
    schema = "user_name string, event string, record_time timestamp"
    data = [("superuser", "authenticated", ts("2024-01-01 10:01:00")), ("superuser", "authenticated", ts("2024-01-01 10:07:00")),
            ("superuser", "failed", ts("2024-01-01 18:07:00")), ("other", "authenticated", ts("2024-01-01 10:07:00"))]
    late = [("pii_reader", "authenticated", ts("2024-01-01 09:00:00"))]

    def drain():
        alerts = watched_login_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
        drain_to_files(alerts, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        return spark.read.schema(schema).parquet(f"{tmp_path}/out")

    feed(spark, f"{tmp_path}/in", data[:1], schema)
    assert drain().count() == 1  # at once, without a later login
    feed(spark, f"{tmp_path}/in", data[1:] + late, schema)
    windows = watched_login_windows(drain(), None)
    batch = watched_login_windows(spark.createDataFrame(data + late, schema).filter("event = 'authenticated'"), ["superuser", "pii_reader"])
    assert rows(windows) == rows(batch)
    assert (ts("2024-01-01 09:55:00"), ts("2024-01-01 10:10:00"), "superuser", 2) in rows(windows)


def test_export_stream(spark, tmp_path):
    schema = "query int, start_time timestamp, end_time timestamp, line_count int"
    at = ts("2024-01-01 10:00:59")
    feed(spark, f"{tmp_path}/in", [(1, at, at, 10001), (2, at, at, 10000)], schema)
    alerts = large_export_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    for _ in range(2):
        drain_to_files(alerts, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert rows(spark.read.schema(alerts.schema).parquet(f"{tmp_path}/out")) == [(1, "2024-01-01 10:00", "2024-01-01 10:00", 10001)]


def test_decrypt_stream(spark, tmp_path):
    schema = "event_key string, message string, dw_processed_at timestamp"
    key = F.encode(F.lit("sixteen byte key"), "UTF-8")
    cipher = spark.range(1).select(F.base64(F.aes_encrypt(F.lit('{"user_id": 4}'), key))).first()[0]

    def drain():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        decrypt_stream(stream, aes_gcm(key), ts(LOADED), f"{tmp_path}/events", f"{tmp_path}/checkpoint")
        return decrypted_events(spark, f"{tmp_path}/events")

    feed(spark, f"{tmp_path}/in", [("a", cipher, None), ("b", "nonsense", None), ("done", cipher, ts(LOADED))], schema)
    assert rows(drain(), "event_key", "user_id") == [("a", 4)]
    feed(spark, f"{tmp_path}/in", [("a", cipher, None), ("c", cipher, None)], schema)
    assert rows(drain(), "event_key", "user_id") == [("a", 4), ("c", 4)]
    assert rows(failed_events(spark, f"{tmp_path}/events"), "event_key") == [("b",)]


def test_failed_decryptions_are_tried_again(spark, tmp_path):
    schema = "event_key string, message string, dw_processed_at timestamp"
    key, other = (F.encode(F.lit(k), "UTF-8") for k in ("sixteen byte key", "another key 0000"))
    cipher = spark.range(1).select(F.base64(F.aes_encrypt(F.lit('{"user_id": 4}'), other))).first()[0]
    feed(spark, f"{tmp_path}/in", [("a", cipher, None), ("b", "nonsense", None)], schema)
    for used, good, bad in ((key, [], ["a", "b"]), (other, ["a"], ["b"]), (key, ["a"], ["b"])):
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        decrypt_stream(stream, aes_gcm(used), ts(LOADED), f"{tmp_path}/events", f"{tmp_path}/checkpoint")
        assert rows(decrypted_events(spark, f"{tmp_path}/events"), "event_key") == [(k,) for k in good]
        assert rows(failed_events(spark, f"{tmp_path}/events"), "event_key") == [(k,) for k in bad]
