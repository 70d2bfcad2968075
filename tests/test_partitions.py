"""Partition-wise merge and retention on catalogue tables, hot keys, session settings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weirstone import session
from weirstone.operators.retention import apply_retention
from weirstone.operators.upsert import upsert
from weirstone.sources.partitions import create_day_table, drop_expired_days, merge_days, replace_days

from helpers import plan, rows

SCHEMA = "id string, v string, day date"


def d(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def table(spark):
    name = "merge_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = spark.createDataFrame([("a", "1", d(1)), ("b", "1", d(2)), ("c", "1", d(2)), ("d", "1", d(3))], SCHEMA)
    create_day_table(first, name, "day")
    create_day_table(first, name, "day")
    assert spark.table(name).count() == 0
    replace_days(first, name)
    return name


def files(spark, table):
    found = spark.table(table).select("day", F.input_file_name().alias("f")).distinct().collect()
    return {(r.day, r.f) for r in found}


def test_merge_equals_upsert_and_touches_only_its_days(spark, table, tmp_path):
    updates = spark.createDataFrame([("b", "2", d(2)), ("d", "2", d(4)), ("e", "2", d(5))], SCHEMA)
    expected = rows(upsert(spark.table(table), updates, ["id"]), "id", "v", "day")
    before = files(spark, table)
    merge_days(updates, table, ["id"], "day", str(tmp_path / "s1"))
    assert rows(spark.table(table), "id", "v", "day") == expected == [
        ("a", "1", d(1)), ("b", "2", d(2)), ("c", "1", d(2)), ("d", "2", d(4)), ("e", "2", d(5)),
    ]
    after = files(spark, table)
    assert {f for f in before if f[0] == d(1)} <= after  # not rewritten
    assert d(3) not in {day for day, _ in after}  # emptied, dropped
    merge_days(updates, table, ["id"], "day", str(tmp_path / "s2"))
    assert rows(spark.table(table), "id", "v", "day") == expected


def test_merge_needs_a_day(spark, table, tmp_path):
    with pytest.raises(ValueError):
        merge_days(spark.createDataFrame([("x", "1", None)], SCHEMA), table, ["id"], "day", str(tmp_path / "s"))


def test_expired_days_are_dropped(spark, table):
    as_of = dt.date(2024, 1, 13)
    expected = rows(apply_retention(spark.table(table), "day", as_of, days=11), "id")
    assert drop_expired_days(spark, table, "day", as_of, days=11) == [d(1)]
    assert rows(spark.table(table), "id") == expected == [("b",), ("c",), ("d",)]


def test_shared_root(spark):
    root = session.shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_dir(spark, "x") != session.fresh_dir(spark, "x")
    assert session.fresh_dir(spark, "x").startswith(root)


def test_shared_root_is_the_same_rule_on_every_master():
    class Conf:
        def get(self, key, default):
            return default

    for master in ("local[2]", "local-cluster[2,1,1024]", "yarn"):
        unset = type("S", (), {"conf": Conf(), "sparkContext": type("C", (), {"master": master})})()
        assert session.shared_root(unset) == "weirstone-work"


def test_a_hot_key_never_reaches_one_task(spark):
    """A third of the rows share one key: what the final task of the dedup receives is one row per
    map task, whatever the size of the group."""
    from weirstone.operators.dedup import dedup_latest

    data = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    latest = dedup_latest(data, ["k"], [F.col("v").desc()])
    text = plan(latest)
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert latest.count() == 60_001 and rows(latest.filter("k = 0")) == [(0, 89_997)]


def test_partial_merge_and_marks_touch_their_days_only(spark, tmp_path):
    from weirstone.sources.partitions import mark_processed_days, merge_days_partial

    at, later = dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    table = "partial_days"
    data = [("a", "m", None, d(1)), ("a", "m", None, d(2)), ("b", "m", at, d(2)), ("c", "m", None, d(3))]
    first = spark.createDataFrame(data, "id string, message string, dw_processed_at timestamp, day date")
    create_day_table(first, table, "day")
    replace_days(first, table)

    def files(n):
        return {f.input_file_name for f in spark.table(table).filter(F.col("day") == d(n)).select(F.input_file_name().alias("input_file_name")).collect()}

    before = {n: files(n) for n in (1, 2, 3)}
    updates = spark.createDataFrame([("a", "new", d(2)), ("x", "new", d(2))], "id string, message string, day date")
    merge_days_partial(updates, table, ["id", "day"], ["message"], "day", str(tmp_path / "s"))
    assert rows(spark.table(table), "id", "message", "dw_processed_at", "day") == [
        ("a", "m", None, d(1)), ("a", "new", None, d(2)), ("b", "m", at, d(2)), ("c", "m", None, d(3)), ("x", "new", None, d(2)),
    ]
    assert files(1) == before[1] and files(3) == before[3] and files(2) != before[2]
    done = spark.createDataFrame([("a", d(2)), ("b", d(2))], "id string, day date")
    mark_processed_days(done, table, ["id", "day"], F.lit(later), "day")
    assert rows(spark.table(table).filter("dw_processed_at is not null"), "id", "dw_processed_at", "day") == [("a", later, d(2)), ("b", at, d(2))]
    assert files(1) == before[1]


def test_load_by_day_parses_once(spark, tmp_path):
    import json

    from weirstone.operators.extract import EVENT_COLUMNS, extract_columns
    from weirstone.operators.logload import load_logs_by_day

    at = dt.datetime(2024, 1, 2, 10)
    raw = spark.createDataFrame([(json.dumps({"id": k, "name": "n"}), t) for k, t in (("a", at), ("b", None))] + [("{}", at), ('{"id":"d"}{"id":"e"}', at)], "message string, cloudwatch_timestamp timestamp")
    empty = extract_columns(raw.limit(0), EVENT_COLUMNS).withColumn("day", F.to_date("cloudwatch_timestamp"))
    create_day_table(empty, "loaded_days", "day")
    rest = load_logs_by_day(raw, "loaded_days", EVENT_COLUMNS, "id", "day", str(tmp_path / "load"))
    assert rows(spark.table("loaded_days"), "id", "day") == [("a", dt.date(2024, 1, 2)), ("b", dt.date(1970, 1, 1))]
    assert rows(rest, "message") == [('{"id":"d"}{"id":"e"}',), ("{}",)]
    assert "from_json" not in plan(rest) and "from_json" not in plan(spark.table("loaded_days"))
