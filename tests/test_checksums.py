"""Comparison by checksums gives what the comparison of all rows gives, and reads single ranges."""

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from weirstone.operators.checksums import changed_rows, differing_ranges, hashed_key, narrowed, reconcile_by_checksum, row_hash
from weirstone.operators.reconcile import reconcile

SCHEMA = "id long, a string, b string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


SAME = [(n, f"a{n}", None if n % 3 else "b") for n in range(-40, 400)] + [(None, "null key", "x"), (5, "repeated", "r"), (5, "repeated", "r")]
CHANGED = [(n, "changed" if n in (17, 300) else a, b) for n, a, b in SAME if n != 18] + [(9999, "extra", None), (-500, None, "extra")]


@pytest.mark.parametrize("widths", [(64,), (128, 16), (100, 10), (1 << 24, 1 << 14)])
@pytest.mark.parametrize("pushed", [0, 200])
def test_equals_the_comparison_of_all_rows(spark, widths, pushed):
    expected, actual = frame(spark, SAME), frame(spark, CHANGED)
    assert rows(reconcile_by_checksum(expected, actual, "id", ["a", "b"], widths, pushed)) == rows(reconcile(expected, actual, ["id"], ["a", "b"]))
    assert reconcile_by_checksum(expected, frame(spark, SAME[::-1]), "id", ["a", "b"], widths, pushed).count() == 0
    assert reconcile_by_checksum(expected.limit(0), expected.limit(0), "id", ["a", "b"], widths, pushed).count() == 0


def test_null_in_another_column_or_key_and_repeats(spark):
    one = frame(spark, [(1, "x", None), (None, "k", "k"), (2, "y", "y")])
    for other in ([(1, None, "x"), (None, "k", "k"), (2, "y", "y")], [(1, "x", None), (None, "k", "l"), (2, "y", "y")], [(1, "x", None), (None, "k", "k"), (2, "y", "y"), (2, "y", "y")]):
        assert differing_ranges(one, frame(spark, other), "id", ["id", "a", "b"], 16).count() == 1


def test_one_changed_row_leaves_one_range(spark, tmp_path):
    spark.range(100_000).select("id", F.md5(F.col("id").cast("string")).alias("a"), F.lit("b").alias("b")).repartitionByRange(8, "id").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    changed = table.withColumn("a", F.when(F.col("id") == 77_777, "changed").otherwise(F.col("a")))
    e, a = narrowed(table, changed, "id", ["id", "a", "b"], (16_384, 128))
    assert (e.count(), a.count()) == (128, 128)
    assert "GreaterThanOrEqual(id,77696)" in plan(e, "formatted") and "LessThan(id,77824)" in plan(e, "formatted")
    drift = reconcile_by_checksum(table, changed, "id", ["a", "b"], (16_384, 128))
    assert rows(drift, "id", "drift", "actual_a") == [(77_777, "mismatched", "changed")]


def test_changed_rows_are_new_or_other_than_in_the_copy(spark):
    source, copy = frame(spark, [(1, "a", None), (2, "new", "b"), (3, "insert", None), (None, "k", "k")]), frame(spark, [(1, "a", None), (2, "old", "b"), (9, "gone", "x"), (None, "k", "k")])
    assert rows(changed_rows(source, copy, "id", (4,))) == [(2, "new", "b"), (3, "insert", None)]


def test_keys_of_several_columns_are_hashed(spark):
    expected = frame(spark, SAME).dropDuplicates(["id", "a"]).withColumn("k", hashed_key("id", "a"))
    actual = expected.withColumn("b", F.when(F.col("id") == 30, "changed").otherwise(F.col("b")))
    assert rows(reconcile_by_checksum(expected, actual, "k", ["id", "a", "b"], (1 << 50,)), "drift", "actual_b") == [("mismatched", "changed")]
    one = frame(spark, [(None, "x", "")]).select(hashed_key("id", "a"), row_hash(frame(spark, []), ["id", "a"]))
    assert one.first()[0] is not None
