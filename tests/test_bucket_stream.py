"""The bucket source: limits, the open bucket, late files, and each event once after a crash."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import ts
from weirstone.sources.bucket_stream import BucketReader, Part, drain, stream_buckets
from weirstone.sources.buckets import bucket_name

NOW = ts("2024-01-01 10:12:00")


def fill(spark, root, data):
    rows = spark.createDataFrame(data, "event_key string, message string, ts timestamp").withColumn("bucket_name", bucket_name(F.col("ts")))
    rows.drop("ts").coalesce(1).write.mode("append").partitionBy("bucket_name").parquet(str(root))


class Sink:
    def __init__(self):
        self.batches, self.lose = {}, None

    def __call__(self, batch, batch_id):
        self.batches[batch_id] = [tuple(r) for r in batch.collect()]
        if batch_id == self.lose:
            self.lose = None
            raise RuntimeError("lost after the write")

    def keys(self):
        return [r[0] for n in sorted(self.batches) for r in self.batches[n]]


def at(text):
    return ts(f"2024-01-01 {text}")


def events(*minutes, tag=""):
    return [(f"{tag}{m}-{n}", f"m{n}", at(f"10:{m:02}:{n:02}")) for m in minutes for n in range(10)]


def test_closed_buckets_in_order_and_in_limits(spark, tmp_path):
    fill(spark, tmp_path / "in", events(1, 6, 11))
    sink = Sink()
    for _ in range(2):
        drain(stream_buckets(spark, f"{tmp_path}/in", limit=7, as_of=NOW), sink, f"{tmp_path}/cp")
    assert [len(b) for _, b in sorted(sink.batches.items())] == [7, 7, 6]
    assert sink.keys() == [f"{m}-{n}" for m in (1, 6) for n in range(10)]
    assert sink.batches[0][0] == ("1-0", "m0", "fraud-ops-events:2024-01-01T10:00:00Z", dt.date(2024, 1, 1))
    # the bucket closes with the clock
    drain(stream_buckets(spark, f"{tmp_path}/in", limit=100, as_of=at("10:15:00")), sink, f"{tmp_path}/cp")
    assert len(sink.keys()) == 30 and len(sink.batches) == 4


def test_late_files_of_an_old_bucket_arrive(spark, tmp_path):
    sink = Sink()
    fill(spark, tmp_path / "in", events(1, 6))
    drain(stream_buckets(spark, f"{tmp_path}/in", as_of=NOW), sink, f"{tmp_path}/cp")
    fill(spark, tmp_path / "in", events(1, 2, tag="late"))
    drain(stream_buckets(spark, f"{tmp_path}/in", as_of=NOW), sink, f"{tmp_path}/cp")
    assert sorted(sink.keys()) == sorted(k for k, _, _ in events(1, 6) + events(1, 2, tag="late"))
    fill(spark, tmp_path / "in", events(7))
    drain(stream_buckets(spark, f"{tmp_path}/in", as_of=NOW), sink, f"{tmp_path}/cp")
    assert len(sink.keys()) == 50
    # what has been read is gone but for the last batch, which nothing has followed
    assert len(list((tmp_path / "in").glob("bucket_name=*/*.parquet"))) == 1
    assert len(list((tmp_path / "in" / "_plans").glob("*.json"))) <= 2


@pytest.mark.parametrize("lost", [0, 1, 2])
def test_replay_after_a_crash_gives_each_event_once(spark, tmp_path, lost):
    sink = Sink()
    sink.lose = lost
    fill(spark, tmp_path / "in", events(1, 6))
    with pytest.raises(Exception, match="lost after the write"):
        drain(stream_buckets(spark, f"{tmp_path}/in", limit=8, as_of=NOW), sink, f"{tmp_path}/cp")
    before = dict(sink.batches)
    fill(spark, tmp_path / "in", events(0, 3, tag="late"))  # arrives in between, in an older bucket
    drain(stream_buckets(spark, f"{tmp_path}/in", limit=8, as_of=NOW), sink, f"{tmp_path}/cp")
    assert all(sink.batches[n] == before[n] for n in before)  # the repeated batch is the same
    expected = [k for k, _, _ in events(1, 6) + events(0, 3, tag="late")]
    assert sorted(sink.keys()) == sorted(expected)


def test_kept_files_are_read_once(spark, tmp_path):
    sink = Sink()
    fill(spark, tmp_path / "in", events(1, 6))
    for _ in range(2):
        drain(stream_buckets(spark, f"{tmp_path}/in", limit=3, as_of=NOW, keep=True), sink, f"{tmp_path}/cp")
        fill(spark, tmp_path / "in", events(2))
    assert len(sink.keys()) == 30
    assert len(list((tmp_path / "in").glob("bucket_name=*/*.parquet"))) == 4


def test_plans_survive_a_planner_that_broke_off(spark, tmp_path):
    fill(spark, tmp_path / "in", events(1))
    options = {"root": f"file://{tmp_path}/in", "limit": "6", "as_of": NOW.isoformat()}
    assert BucketReader(options).latestOffset() == {"plan": 1}  # nobody has heard of it
    reader = BucketReader(options)
    assert reader.latestOffset() == {"plan": 2} == reader.latestOffset()
    parts = reader.partitions({"plan": 0}, {"plan": 2})
    assert [r[2:] for p in parts for r in p.ranges] == [(0, 6), (6, 10)] and all(isinstance(p, Part) for p in parts)
    assert len(BucketReader(options | {"tasks": "1"}).partitions({"plan": 0}, {"plan": 2})) == 1
    assert [r for p in parts for b in reader.read(p) for r in b.column(0).to_pylist()] == [f"1-{n}" for n in range(10)]
    reader.commit({"plan": 1})
    assert reader.partitions({"plan": 1}, {"plan": 2})[0].ranges[0][3] == 10
    reader.commit({"plan": 2})
    assert BucketReader(options).latestOffset() == {"plan": 2}
    assert BucketReader({"root": f"file://{tmp_path}/none"}).latestOffset() == {"plan": 0}


@pytest.mark.parametrize("lost", [None, 0])
def test_a_backlog_is_drained_many_batches_at_a_time(spark, tmp_path, lost):
    sink = Sink()
    sink.lose = lost
    fill(spark, tmp_path / "in", events(1, 6))
    if lost is not None:
        with pytest.raises(Exception, match="lost after the write"):
            drain(stream_buckets(spark, f"{tmp_path}/in", limit=7, as_of=NOW, batches=2), sink, f"{tmp_path}/cp")
        before = dict(sink.batches)
    drain(stream_buckets(spark, f"{tmp_path}/in", limit=7, as_of=NOW, batches=2), sink, f"{tmp_path}/cp")
    assert [len(b) for _, b in sorted(sink.batches.items())] == [14, 6]  # two turns
    assert [r[3] for n in sorted(sink.batches) for r in sink.batches[n]] == [1] * 7 + [2] * 7 + [3] * 6
    assert sink.keys() == [f"{m}-{n}" for m in (1, 6) for n in range(10)]
    assert lost is None or sink.batches[0] == before[0]
    fill(spark, tmp_path / "in", events(2, tag="late"))
    drain(stream_buckets(spark, f"{tmp_path}/in", limit=7, as_of=NOW, batches=2), sink, f"{tmp_path}/cp")
    assert [r[3] for r in sink.batches[2]] == [4] * 7 + [5] * 3 and len(sink.keys()) == 30


def test_only_row_groups_of_a_range_are_read(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "in" / "fraud-ops-events:2024-01-01T10:00:00Z"
    folder.mkdir(parents=True)
    text = [str(n) for n in range(100)]
    pq.write_table(pa.table({"event_key": text, "message": text}), folder / "one.parquet", row_group_size=10)
    reader = BucketReader({"root": f"file://{tmp_path}/in", "limit": "8", "batches": "5", "tasks": "2", "as_of": NOW.isoformat()})
    assert reader.latestOffset() == {"plan": 5}
    asked, plain = [], pq.ParquetFile.iter_batches
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, **how: asked.append(how["row_groups"]) or plain(self, **how))
    parts = reader.partitions({"plan": 0}, {"plan": 5})
    read = [[(r["event_key"], r["batch"]) for b in reader.read(p) for r in b.to_pylist()] for p in parts]
    assert read == [[(str(n), n // 8 + 1) for n in range(24)], [(str(n), n // 8 + 1) for n in range(24, 40)]]
    assert asked == [[0, 1, 2], [2, 3]]
    with pytest.raises(FileNotFoundError):
        reader.partitions({"plan": 0}, {"plan": 6})
