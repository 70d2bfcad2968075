"""Changes to a table without days: rows as by the whole-table operators, untouched files as they were."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, ts
from weirstone.operators.upsert import mark_processed, upsert, upsert_partial
from weirstone.sources import file_rewrite
from weirstone.sources.file_rewrite import expire_files, mark_files, read_files, upsert_files, upsert_files_partial

SCHEMA = "id long, name string, at timestamp, done timestamp"
BASE = [(n, f"n{n}", ts("2024-01-01 00:00:00") + dt.timedelta(days=n // 10), None) for n in range(50)] + [(None, "null key", None, None)]


@pytest.fixture
def table(spark, tmp_path):
    """Six files: ten rows with a day of their own each, and one row without key and time."""
    for n in range(6):
        spark.createDataFrame(BASE[10 * n : 10 * n + 10], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    return tmp_path / "t"


def files(table):
    return {p.name: p.stat().st_mtime_ns for p in table.glob("*.parquet")}


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upsert_rewrites_the_files_of_its_keys(spark, tmp_path, table):
    updates = frame(spark, [(3, "new", None, None), (7, "new", None, None), (None, "null", None, None), (900, "insert", None, None)])
    expected = rows(upsert(frame(spark, BASE), updates, ["id"]))
    before = files(table)
    for n in range(2):  # a repeated upsert changes nothing
        rewritten = upsert_files(updates, str(table), ["id"], f"{tmp_path}/s{n}")
        assert rows(read_files(spark, str(table))) == expected
        if n == 0:
            assert len(rewritten) == 2
            kept = {k: v for k, v in before.items() if k not in rewritten}
            assert len(kept) == 4 and kept.items() <= files(table).items()
    assert not list(table.glob("_rewrite-*"))


def test_partial_upsert(spark, tmp_path, table):
    updates = frame(spark, [(13, "new", ts("2025-01-01 00:00:00"), None), (901, "insert", None, None)])
    loaded = {"done": F.lit(ts("2026-01-01 00:00:00"))}
    expected = rows(upsert_partial(frame(spark, BASE), updates, ["id"], ["name"], loaded))
    assert len(upsert_files_partial(updates, str(table), ["id"], ["name"], f"{tmp_path}/s", loaded)) == 1
    assert rows(read_files(spark, str(table))) == expected


def test_inserts_alone_rewrite_nothing(spark, tmp_path, table):
    before = files(table)
    assert upsert_files(frame(spark, [(1000, "x", None, None)]), str(table), ["id"], f"{tmp_path}/s") == []
    assert before.items() <= files(table).items()
    assert read_files(spark, str(table)).count() == 52


def test_marks(spark, tmp_path, table):
    at = F.lit(ts("2024-06-01 00:00:00"))
    done = spark.createDataFrame([(21,), (22,), (None,), (77,)], "id long")
    expected = rows(mark_processed(frame(spark, BASE), done, ["id"], at, "done"))
    assert len(mark_files(done, str(table), ["id"], at, f"{tmp_path}/s1", "done")) == 2
    assert rows(read_files(spark, str(table))) == expected
    before = files(table)
    assert mark_files(done, str(table), ["id"], F.lit(ts("2030-01-01 00:00:00")), f"{tmp_path}/s2", "done") == []  # all are marked
    assert files(table) == before


def test_retention_removes_and_rewrites(spark, table):
    before = files(table)
    frame(spark, [(60, "old", ts("2023-01-01 00:00:00"), None), (61, "young", ts("2024-03-01 00:00:00"), None)]).coalesce(1).write.mode("append").parquet(str(table))
    gone = expire_files(spark, str(table), "at", dt.date(2024, 1, 3), days=0)
    assert len(gone) == 3  # two of one day each, and the one with an old and a young row
    assert rows(read_files(spark, str(table)), "id") == sorted([(n,) for n in range(20, 50)] + [(61,), (None,)], key=lambda r: (r[0] is None, str(r[0])))
    kept = {k: v for k, v in before.items() if k not in gone}
    assert len(kept) == 4 and kept.items() <= files(table).items()
    assert expire_files(spark, str(table), "at", dt.date(2024, 1, 3), days=0) == []


@pytest.mark.parametrize("lost", ["before the journal", "after the journal", "between moving and removing"])
def test_a_change_that_broke_off(spark, tmp_path, table, monkeypatch, lost):
    updates = frame(spark, [(3, "new", None, None)])
    before = rows(read_files(spark, str(table)))
    expected = rows(upsert(frame(spark, BASE), updates, ["id"]))
    done = []

    def breaks(name, real, keep=0):
        def call(*args):
            if len(done) >= keep:
                raise RuntimeError("lost")
            done.append(name)
            return real(*args)

        monkeypatch.setattr(file_rewrite, name, call)

    if lost == "before the journal":
        real = spark.createDataFrame
        monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, schema=None, **more: (_ for _ in ()).throw(RuntimeError("lost")) if schema == "file string" else real(data, schema, **more))
    elif lost == "after the journal":
        breaks("move", file_rewrite.move)
    else:
        breaks("remove", file_rewrite.remove)
    with pytest.raises(RuntimeError, match="lost"):
        upsert_files(updates, str(table), ["id"], f"{tmp_path}/s")
    monkeypatch.undo()
    assert rows(read_files(spark, str(table))) == (before if lost == "before the journal" else expected)
    upsert_files(updates, str(table), ["id"], f"{tmp_path}/s2")
    assert rows(read_files(spark, str(table))) == expected
    assert not list(table.glob("_rewrite-*"))
