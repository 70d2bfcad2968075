"""Distinct users from stored bitmaps equal those of the events, in parts and merged."""

from helpers import rows
from weirstone.operators import bitmaps

SCHEMA = "day int, issuer string, user string"
FIRST = [(n % 5, f"i{n % 2}", f"u{n % 37}") for n in range(300)] + [(0, "i0", None), (1, None, "u1")]
SECOND = [(n % 5, f"i{n % 3}", f"u{n}") for n in range(30, 60)]


def test_parts_add_up_and_numbers_stay(spark, tmp_path):
    path, seen, numbers = str(tmp_path / "dictionary"), [], {}
    for n, part in enumerate((FIRST, SECOND, SECOND, [])):
        events = spark.createDataFrame(part, SCHEMA)
        dictionary = bitmaps.number_users(events, path, "user", f"{tmp_path}/s{n}")
        found = {r.user_id: r.number for r in dictionary.collect()}
        assert numbers.items() <= found.items() and sorted(found.values()) == list(range(1, len(found) + 1))
        assert set(found) == {u for _, _, u in FIRST + (SECOND if n else []) if u}
        numbers = found
        bitmaps.user_bitmaps(events, dictionary, ["day", "issuer"], "user").write.mode("append").parquet(f"{tmp_path}/days")
        seen += part
    days = spark.read.parquet(f"{tmp_path}/days")
    for keys in (["day", "issuer"], ["issuer"], ["day"]):
        at = [("day", "issuer").index(k) for k in keys]
        expected = {}
        for row in seen:
            if row[2]:
                expected.setdefault(tuple(row[i] for i in at), set()).add(row[2])
        assert {tuple(r[:-1]): r[-1] for r in bitmaps.distinct_users(days, keys).collect()} == {k: len(v) for k, v in expected.items()}


def test_numbers_beyond_one_bitmap(spark, tmp_path):
    users = spark.range(100_000)
    dictionary = bitmaps.number_users(users, str(tmp_path / "d"), "id", f"{tmp_path}/s")
    days = bitmaps.user_bitmaps(users.selectExpr("id % 2 as day", "id"), dictionary, ["day"], "id")
    assert rows(bitmaps.distinct_users(days, [])) == [(100_000,)]
    assert rows(bitmaps.distinct_users(days, ["day"])) == [(0, 50_000), (1, 50_000)]
    assert days.select("bucket").distinct().count() == 4
    left, right = days.filter("day = 0"), days
    assert rows(bitmaps.in_both(left, right, [])) == [(50_000,)]
    assert bitmaps.in_both(left, days.filter("day = 1"), []).count() == 0
