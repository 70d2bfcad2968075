"""Undecryptable rows as keyed state: timers, expiry, replays, and what a run reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, ts
from weirstone.operators.decrypt import aes_gcm
from weirstone.streaming import retries
from weirstone.streaming.decrypt import decrypt_stream, decrypted_events, expired_events, failed_events
from weirstone.streaming.retries import Retries, attempts_path, pending

SCHEMA = "event_key string, message string, dw_processed_at timestamp, seen timestamp, n decimal(10,2)"
START = ts("2024-01-02 00:00:00")


def key(text="sixteen byte key"):
    return F.encode(F.lit(text), "UTF-8")


def feed(spark, tmp_path, *names, other="another key 0000"):
    """a: encrypted with another key; everything else is no cipher text."""
    cipher = spark.range(1).select(F.base64(F.aes_encrypt(F.lit('{"user_id": 4}'), key(other)))).first()[0]
    data = [(n, cipher if (n or "").startswith("a") else f"bad {n}", None, ts("2024-01-01 01:02:03.123456"), 1) for n in names]
    spark.createDataFrame(data, "event_key string, message string, dw_processed_at timestamp, seen timestamp, n int").select(
        "event_key", "message", "dw_processed_at", "seen", F.col("n").cast("decimal(10,2)").alias("n")
    ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def attempts(spark, out):
    return spark.read.schema("id string, status string").parquet(attempts_path(out))


def run(spark, tmp_path, minutes, policy=Retries(), used="sixteen byte key", retire=True):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    decrypt_stream(stream, aes_gcm(key(used)), START + dt.timedelta(minutes=minutes), f"{tmp_path}/out", f"{tmp_path}/checkpoint", policy, retire)


def test_waits_grow_up_to_the_longest():
    policy = Retries(dt.timedelta(minutes=1), 3.0, dt.timedelta(minutes=5))
    assert [policy.wait_ms(n) // 1000 for n in range(1, 5)] == [60, 180, 300, 300]
    assert [Retries().wait_ms(n) for n in (1, 2, 90)] == [1, 1, 1]
    assert Retries(dt.timedelta(minutes=1), 1.0).wait_ms(50) == 60_000


def test_timers_and_expiry(spark, tmp_path):
    policy = Retries(dt.timedelta(minutes=10), 2.0, attempts=3)
    out = f"{tmp_path}/out"
    feed(spark, tmp_path, "b", None)

    def waiting():
        return rows(pending(spark, out), "event_key", "failures")

    expected = {0: 1, 5: 1, 11: 2, 30: 2}
    for minutes, failures in expected.items():
        run(spark, tmp_path, minutes, policy)
        assert waiting() == [("b", failures), (None, failures)]
        assert expired_events(spark, out).count() == 0
    run(spark, tmp_path, 32, policy)  # 20 minutes after the second failure
    assert waiting() == []
    assert rows(expired_events(spark, out), "event_key", "seen") == [("b", ts("2024-01-01 01:02:03.123456")), (None, ts("2024-01-01 01:02:03.123456"))]
    made = attempts(spark, out).count()
    run(spark, tmp_path, 300, policy)
    assert attempts(spark, out).count() == made == 4
    assert rows(failed_events(spark, out), "event_key", "message") == [("b", "bad b"), (None, "bad None")]


def test_a_run_reads_what_is_new_and_what_is_due(spark, tmp_path):
    out = f"{tmp_path}/out"
    policy = Retries(dt.timedelta(hours=1))
    feed(spark, tmp_path, *[f"b{n}" for n in range(30)], "a")
    run(spark, tmp_path, 0, policy)
    assert not list((tmp_path / "out").glob("batch_id=*/status=failed"))  # they are state now
    feed(spark, tmp_path, "c")
    run(spark, tmp_path, 5, policy)
    assert attempts(spark, out).count() == 0  # nothing is due
    run(spark, tmp_path, 61, policy, used="another key 0000")
    assert attempts(spark, out).count() == 31  # c is not due
    assert rows(decrypted_events(spark, out), "event_key", "user_id") == [("a", 4)]
    assert pending(spark, out).count() == 31 and "a" not in {r.event_key for r in pending(spark, out).collect()}
    run(spark, tmp_path, 62, policy)
    state = spark.read.format("statestore").option("stateVarName", "pending").load(f"{out}__retry/state")
    assert state.count() == 31  # the outcome has been read back
    assert len(list((tmp_path / "out__retry" / "ticks").glob("at=*"))) == 1


def test_a_run_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    feed(spark, tmp_path, "a", "b")
    run(spark, tmp_path, 0)
    write = retries.write_batch

    def breaks(*args):
        write(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(retries, "write_batch", breaks)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, tmp_path, 1, used="another key 0000")
    monkeypatch.setattr(retries, "write_batch", write)
    run(spark, tmp_path, 1, used="another key 0000")
    run(spark, tmp_path, 2)
    assert rows(decrypted_events(spark, out), "event_key") == [("a",)]
    assert rows(failed_events(spark, out), "event_key") == [("b",)]
    # at most one attempt more than needed, and none once its outcome has been read
    good = attempts(spark, out).filter("status = 'ok'")
    assert good.select("id").distinct().count() == 1
    made = good.count()
    for minutes in (3, 4):
        run(spark, tmp_path, minutes, used="another key 0000")
    assert good.count() == made <= 2


def test_a_repeated_row_is_kept_once_and_a_settled_one_not_at_all(spark, tmp_path):
    out = f"{tmp_path}/out"
    feed(spark, tmp_path, "b", "b", "a")
    run(spark, tmp_path, 0)
    feed(spark, tmp_path, "b")
    run(spark, tmp_path, 0, used="another key 0000", retire=False)  # the clock still moves on
    run(spark, tmp_path, 0, retire=False)
    assert rows(failed_events(spark, out), "event_key") == [("b",)]
    assert rows(decrypted_events(spark, out), "event_key") == [("a",)]
    assert rows(pending(spark, out), "event_key", "failures") == [("b", 3)]
