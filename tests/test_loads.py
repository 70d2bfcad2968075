"""Dedup, upsert, log load, table sync, retention, reconcile, conform."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.operators import conform, reconcile, retention, tablesync
from weirstone.operators.dedup import dedup_latest, split_null_keys
from weirstone.operators.extract import EVENT_COLUMNS, LOG_TABLES, REQUEST_COLUMNS, extract_columns
from weirstone.operators.logload import load_logs
from weirstone.operators.upsert import mark_processed, upsert, upsert_partial
from weirstone.sources.tables import publish

from helpers import plan, rows, ts

EVENT = {
    "name": "Sign in page visited",
    "properties": {
        "event_properties": {"flash": None},
        "new_event": True,
        "path": "/",
        "user_id": "anonymous-uuid",
        "locale": "en",
        "pid": 10330,
        "service_provider": None,
        "browser_mobile": False,
        "browser_bot": False,
    },
    "time": "2024-05-29T20:34:13.334Z",
    "visitor_id": "v",
    "log_filename": "events.log",
}
REQUEST = {"method": "GET", "path": "/api/health", "status": 200, "duration": 2.31, "timestamp": "2024-04-23T15:07:11Z",
           "git_branch": "main", "pid": 8932, "trace_id": None}
RAW = "message string, cloudwatch_timestamp timestamp"


def raw(spark, *messages, at="2024-05-29 20:34:17.933"):
    texts = [(m if isinstance(m, str) else json.dumps(m), ts(at)) for m in messages]
    return spark.createDataFrame(texts, RAW)


def empty_log(spark, spec):
    return extract_columns(raw(spark).limit(0), spec)


def test_log_columns():
    assert len(EVENT_COLUMNS) == 26 and len(REQUEST_COLUMNS) == 16
    assert LOG_TABLES["production"][1] == "uuid"
    success = next(c for c in EVENT_COLUMNS if c.column == "success")
    assert success.path == "properties.event_properties.success" and success.type == "boolean"


def test_load_events(spark):
    source = raw(spark, EVENT | {"id": "a"}, EVENT | {"id": "b"})
    loaded, remaining = load_logs(source, empty_log(spark, EVENT_COLUMNS), EVENT_COLUMNS, "id")
    assert rows(loaded, "id", "pid", "browser_mobile", "service_provider", "time") == [
        ("a", 10330, False, None, ts("2024-05-29 20:34:13.334")), ("b", 10330, False, None, ts("2024-05-29 20:34:13.334")),
    ]
    assert loaded.columns[:2] == ["message", "cloudwatch_timestamp"] and len(loaded.columns) == 28
    assert remaining.count() == 0


def test_load_requests(spark):
    source = raw(spark, REQUEST | {"uuid": "a"}, REQUEST | {"uuid": "b"})
    loaded, _ = load_logs(source, empty_log(spark, REQUEST_COLUMNS), REQUEST_COLUMNS, "uuid")
    assert [(u, float(d), t) for u, d, t in rows(loaded, "uuid", "duration", "trace_id")] == [("a", 2.31, None), ("b", 2.31, None)]
    assert len(loaded.columns) == 18


def test_load_rejects_rows_without_key_and_loads_the_rest(spark):
    source = raw(spark, {}, {}, "no json", EVENT | {"id": "a"})
    loaded, remaining = load_logs(source, empty_log(spark, EVENT_COLUMNS), EVENT_COLUMNS, "id")
    assert rows(loaded, "id") == [("a",)]
    assert rows(remaining, "message") == [("no json",), ("{}",), ("{}",)]


def test_load_keeps_the_latest_and_is_repeatable(spark):
    old, new = raw(spark, EVENT | {"id": "a"}), raw(spark, EVENT | {"id": "a", "name": "later"}, at="2024-05-30 00:00:00")
    source = new.unionByName(old)
    once = load_logs(source, empty_log(spark, EVENT_COLUMNS), EVENT_COLUMNS, "id").target
    assert rows(once, "id", "name") == [("a", "later")]
    twice = load_logs(source, once, EVENT_COLUMNS, "id").target
    assert rows(twice) == rows(once)


def test_staged_load_gives_the_same(spark, tmp_path):
    source = raw(spark, EVENT | {"id": "a"}, EVENT | {"id": "b"}, {})
    target = load_logs(raw(spark, EVENT | {"id": "a", "name": "old"}, EVENT | {"id": "c"}), empty_log(spark, EVENT_COLUMNS), EVENT_COLUMNS, "id").target
    plain = load_logs(source, target, EVENT_COLUMNS, "id").target
    assert rows(load_logs(source, target, EVENT_COLUMNS, "id", str(tmp_path / "s")).target) == rows(plain)


def test_message_is_parsed_once(spark, tmp_path):
    raw(spark, EVENT | {"id": "a"}).write.parquet(str(tmp_path / "raw"))
    text = plan(extract_columns(spark.read.parquet(str(tmp_path / "raw")), EVENT_COLUMNS).filter("id is not null and pid > 1"))
    assert text.count("from_json") == 1 and "Python" not in text


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    latest = dedup_latest(df, ["k"], [F.col("v").desc()])
    text = plan(latest)
    assert rows(latest) == [(0, 999), (1, 997), (2, 998)]
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_split_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None)], "x int, y string")
    good, bad = split_null_keys(df, ["x", "y"])
    assert rows(good) == [(1, "a")] and bad.count() == 2


def test_upsert_with_null_keys_is_repeatable(spark):
    target = spark.createDataFrame([(1, None, "old"), (1, 2, "old"), (3, 3, "keep")], "a int, b int, v string")
    updates = spark.createDataFrame([(1, None, "new"), (9, 9, "new")], "a int, b int, v string")
    once = upsert(target, updates, ["a", "b"])
    assert rows(once) == [(1, 2, "old"), (1, None, "new"), (3, 3, "keep"), (9, 9, "new")]
    assert rows(upsert(once, updates, ["a", "b"])) == rows(once)


def test_upsert_never_needs_a_nested_loop(spark, monkeypatch):
    a = spark.range(100).select("id", F.col("id").alias("b"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(upsert_partial(a, a.filter("id > 50"), ["id", "b"], ["v"])) + plan(upsert(a, a.filter("id < 9"), ["id", "b"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


ENCRYPTED = "event_key string, message string, partition_dt date, bucket_name string, dw_created_at timestamp, dw_processed_at timestamp"


def test_upsert_partial(spark):
    day, first, second = dt.date(2024, 1, 1), ts("2024-01-01 01:00:00"), ts("2024-01-02 01:00:00")
    target = spark.createDataFrame([("k1", "m1", day, "b1", first, first), ("k2", "m2", day, "b1", first, None)], ENCRYPTED)
    updates = spark.createDataFrame(
        [("k1", "m1'", day, "b2"), ("k1", "other day", dt.date(2024, 1, 2), "b2"), ("k3", "m3", day, "b2")],
        "event_key string, message string, partition_dt date, bucket_name string",
    )

    def run(table):
        return upsert_partial(table, updates, ["event_key", "partition_dt"], ["message", "bucket_name"], {"dw_created_at": F.lit(second)})

    once = run(target)
    assert rows(once, "event_key", "message", "bucket_name", "dw_created_at", "dw_processed_at") == [
        ("k1", "m1'", "b2", first, first),
        ("k1", "other day", "b2", second, None),
        ("k2", "m2", "b1", first, None),
        ("k3", "m3", "b2", second, None),
    ]
    assert rows(run(once)) == rows(once)
    assert once.columns == target.columns


def test_mark_processed(spark):
    target = spark.createDataFrame([("a", None), ("b", None), ("c", ts("2024-01-01"))], "event_key string, dw_processed_at timestamp")
    done = spark.createDataFrame([("a",), ("a",), ("x",)], "event_key string")
    marked = mark_processed(target, done, ["event_key"], F.lit(ts("2024-02-02")))
    assert rows(marked) == [("a", ts("2024-02-02")), ("b", None), ("c", ts("2024-01-01"))]


def test_sync_creates_adds_columns_and_keeps_lost_ones(spark, tmp_path):
    order = [F.col("v").desc()]
    source = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    created = tablesync.sync_table(source, None, ["k"], order)
    assert rows(created) == [(1, "y"), (2, "z")]
    wider = source.withColumn("extra", F.lit(7))
    synced = tablesync.sync_table(wider, created, ["k"], order)
    assert rows(synced) == [(1, "y", 7), (2, "z", 7)]
    assert rows(tablesync.sync_table(wider, created, ["k"], order, staging=str(tmp_path / "s"))) == rows(synced)
    narrow = tablesync.sync_table(source.limit(0).unionByName(spark.createDataFrame([(2, "new")], "k int, v string")), synced, ["k"], order)
    assert rows(narrow) == [(1, "y", 7), (2, "new", 7)]
    assert rows(tablesync.sync_table(wider, synced, ["k"], order)) == rows(synced)


def test_sync_since(spark):
    source = spark.createDataFrame([(1, ts("2024-01-01")), (2, ts("2024-03-01"))], "k int, at timestamp")
    metadata = spark.createDataFrame([("t", ts("2024-02-01"))], "table_name string, last_sync_time timestamp")
    source = source.unionByName(spark.createDataFrame([(3, None)], source.schema))
    since = tablesync.last_sync(metadata, "t")
    empty = source.limit(0)
    assert rows(tablesync.sync_table(source, empty, ["k"], [F.col("at")], F.lit(since), "at"), "k") == [(2,), (3,)]
    # the first sync copies everything, whatever its age
    assert tablesync.last_sync(metadata, "new") is None
    for first in (F.lit(since), None):
        assert rows(tablesync.sync_table(source, None, ["k"], [F.col("at")], first, "at"), "k") == [(1,), (2,), (3,)]
    assert rows(tablesync.record_sync(metadata, "t", ts("2024-03-02"))) == [("t", ts("2024-03-02"))]


def test_wide_types():
    schema = T.StructType([T.StructField("a", T.CharType(3)), T.StructField("b", T.VarcharType(4)), T.StructField("c", T.StringType())])
    assert tablesync.wide_types(schema) == {"a": "string", "b": "string"}


def test_run_each_collects_errors():
    done = []

    def fail():
        raise ValueError("broken")

    with pytest.raises(RuntimeError, match="Error processing table bad: broken"):
        tablesync.run_each({"bad": fail, "good": lambda: done.append(1)})
    assert done == [1]


def test_publish_switches_after_the_write(spark, tmp_path):
    first = publish(spark.range(3).toDF("id"), "current_table", str(tmp_path / "v1"))
    merged = upsert(first, spark.range(2, 5).toDF("id"), ["id"])
    assert rows(publish(merged, "current_table", str(tmp_path / "v2"))) == [(0,), (1,), (2,), (3,), (4,)]
    with pytest.raises(Exception):
        publish(spark.range(1).toDF("id"), "current_table", str(tmp_path / "v2"))
    assert spark.table("current_table").count() == 5


def test_retention_boundary_and_nulls(spark):
    stamps = [ts("2024-12-31 23:59:59"), ts("2025-01-01"), ts("2026-01-01"), None]
    df = spark.createDataFrame([(s,) for s in stamps], "created_at timestamp")
    as_of = dt.date(2026, 1, 2)
    assert retention.cutoff(as_of) == ts("2025-01-01")
    assert rows(retention.apply_retention(df, "created_at", as_of)) == [(ts("2025-01-01"),), (ts("2026-01-01"),), (None,)]
    assert rows(retention.count_expired(df, "created_at", as_of)) == [(4, 1, 1)]


def test_retention_tables():
    names = ["a", "b", "c"]
    assert retention.selected_tables(names, None) == names == retention.selected_tables(names, []) == retention.selected_tables(names, ["*"])
    assert retention.selected_tables(names, ["a", "b", "z"], ["b"]) == ["a"]
    assert retention.selected_tables(names, "c") == ["c"]
    assert retention.timestamp_column("t", ["created_at", "updated_at"]) == "updated_at"
    assert retention.timestamp_column("t", ["created_at", "dw_created_at"]) == "dw_created_at"
    assert retention.timestamp_column("t", ["x"]) is None
    assert retention.timestamp_column("t", ["created_at"], {"t": "x"}) == "x"


def test_retention_plan(spark):
    old = spark.createDataFrame([(ts("2020-01-01"),), (ts("2026-01-01"),)], "created_at timestamp")
    tables = {"a": old, "undated": spark.range(1), "b": old}
    result = retention.plan_retention(tables, dt.date(2026, 1, 2), included=["a", "undated", "gone"], excluded=["b"])
    assert list(result.kept) == ["a"] and result.skipped == ["undated"]
    assert result.errors == ["gone: configured table does not exist"]
    assert rows(result.counts) == [("a", "created_at", 2, 1, 0)]


POLICY = "policy_name string, schema_name string, table_name string, column_name string, grantee string, priority int"


def test_policy_drift(spark):
    expected = spark.createDataFrame(
        [("mask_public_users_phone", "public", "users", "phone", "IAM:charlie", 100),
         ("unmask_public_users_address", "public", "users", "address", "IAM:dave", 300),
         ("mask_public_users_name", "public", "users", "name", "IAM:eve", 100)], POLICY)
    actual = spark.createDataFrame(
        [("mask_public_users_email", "public", "users", "email", "IAM:bob", 100),
         ("mask_public_users_address", "public", "users", "address", "IAM:dave", 100),
         ("mask_public_users_name", "public", "users", "name", "iam:EVE", 100)], POLICY)
    assert rows(reconcile.policy_drift(expected, actual), "drift", "column_id") == [
        ("extra", "public.users.email"), ("mismatched", "public.users.address"), ("missing", "public.users.phone"),
    ]
    assert rows(reconcile.policy_drift(expected, actual, keep_same=True), "drift")[-1] == ("same",)


def test_reconcile_nulls(spark):
    left = spark.createDataFrame([(None, None), (1, None), (2, 5)], "k int, v int")
    right = spark.createDataFrame([(None, None), (1, 4), (2, 5), (2, 5)], "k int, v int")
    assert rows(reconcile.reconcile(left, right, ["k"], ["v"])) == [(1, "mismatched", None, 4)]


SPECS = conform.column_specs([
    {"name": "id", "datatype": "integer", "not_null": True},
    {"name": "name", "datatype": "string", "limit": 3},
    {"name": "tags", "datatype": "array"},
    {"name": "encrypted_ssn", "datatype": "string", "encrypt": True},
])


def test_conform(spark):
    df = spark.createDataFrame([("1", "long name", "{a,b}", 1), ("x", None, None, 2)], "id string, name string, tags string, gone int")
    at = ts("2024-01-01")
    assert rows(conform.conform(df, SPECS, at)) == [
        (1, "long name", ["a", "b"], None, at, at), (None, None, None, None, at, at),
    ]
    assert rows(conform.conform_issues(df, SPECS)) == [
        ("encrypted_ssn", 0, 0, 0), ("id", 1, 1, 0), ("name", 0, 0, 1), ("tags", 0, 0, 0),
    ]
    assert conform.schema_diff(df.schema, SPECS) == [
        ("id", "change"), ("tags", "change"), ("encrypted_ssn", "add"), ("dw_created_at", "add"), ("dw_updated_at", "add"), ("gone", "drop"),
    ]
    again = conform.conform(conform.conform(df, SPECS, at), SPECS, ts("2025-01-01"))
    assert rows(again, "dw_created_at") == [(at,), (at,)]


def test_split_pii(spark):
    df = spark.createDataFrame([(1, "n", "123")], "id bigint, name string, ssn string")
    specs = [conform.ColumnSpec("id", "bigint"), conform.ColumnSpec("name", "string")]
    main, pii = conform.split_pii(df, "id", specs, [conform.ColumnSpec("id", "bigint"), conform.ColumnSpec("ssn", "string")], ts("2024-01-01"))
    assert rows(main, "id", "name") == [(1, "n")] and rows(pii, "id", "ssn") == [(1, "123")]
    with pytest.raises(ValueError):
        conform.split_pii(df, "id", specs, [conform.ColumnSpec("ssn", "string")], ts("2024-01-01"))
