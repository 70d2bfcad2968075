"""Two large tables compared by checksums of key ranges, then row by row in the ranges that differ.

A range's checksum is an order-free sum over hashes of its rows. Rows of one side count positive, of the
other negative, so equal ranges sum to zero and one aggregation, combined on the map side, compares both
tables: what is shuffled is a row per task and range. Wide ranges that differ are cut into narrow ones,
and only the rows of these go through the comparison of rows. Where they are few, the bounds of the ranges
are pushed into the scans, so that files sorted by key are hardly read a second time.

Ranges are those of one whole-number key column; other keys can be hashed to a number first
(``hashed_key``). NULL keys make a range of their own. Hashes have 64 bits; different rows are taken to
differ in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.operators.reconcile import reconcile
from weirstone.operators.upsert import same_key

WIDTHS = (1 << 24, 1 << 14)  # keys per range, from wide to narrow
PUSHED = 200  # so many ranges at most become filters of the scan


def hashed_key(*keys: str) -> Column:
    """A whole number from any keys, NULL-aware: equal keys lie in the same range."""
    return F.xxhash64(*[part for k in keys for part in (F.col(k), F.col(k).isNull())])


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of a row that tells NULL in one column from NULL in another."""
    parts: list[Column] = []
    for c in columns:
        kind = df.schema[c].dataType
        plain = F.to_json(F.struct(c)) if isinstance(kind, (T.MapType, T.VariantType)) else F.col(c)
        parts += [plain, F.col(c).isNull()]
    return F.xxhash64(*parts)


def range_of(key: str, width: int) -> Column:
    return F.floor(F.col(key) / F.lit(width)) if width & (width - 1) else F.shiftright(F.col(key).cast("long"), width.bit_length() - 1)


def differing_ranges(expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str], width: int) -> DataFrame:
    """(range) of the ranges of ``key`` whose rows are not the same on both sides, repeats included."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        h = row_hash(df, columns)
        halves = {"low": h.bitwiseAND(F.lit(0xFFFFFFFF)), "high": F.shiftrightunsigned(h, 32)}
        return df.select(range_of(key, width).alias("range"), F.lit(sign).cast("long").alias("rows"), *[(v * sign).alias(k) for k, v in halves.items()])

    both = side(expected, 1).unionByName(side(actual, -1))
    sums = both.groupBy("range").agg(*[F.try_sum(c).alias(c) for c in ("rows", "low", "high")])
    # a sum that does not fit 64 bits is no proof of equality
    differs = reduce(or_, [F.coalesce(F.col(c) != 0, F.lit(True)) for c in ("rows", "low", "high")])
    return sums.filter(differs).select("range")


def rows_in(df: DataFrame, ranges: DataFrame, key: str, width: int, pushed: int = PUSHED) -> DataFrame:
    """Rows of the given ranges: by filters that scans can use if these are few, else by a semi join."""
    few = [r[0] for r in ranges.limit(pushed + 1).collect()]
    if len(few) <= pushed:
        bounds = [F.col(key).isNull() if r is None else (F.col(key) >= r * width) & (F.col(key) < (r + 1) * width) for r in sorted(few, key=lambda r: (r is not None, r or 0))]
        return df.filter(reduce(or_, bounds)) if bounds else df.filter(F.lit(False))
    found = ranges.select(F.col("range").alias("__range"))
    return df.withColumn("__at", range_of(key, width)).join(found, F.col("__at").eqNullSafe(F.col("__range")), "left_semi").drop("__at")


def narrowed(
    expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str], widths: Sequence[int] = WIDTHS, pushed: int = PUSHED
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in the narrowest ranges that differ."""
    for width in widths:
        ranges = differing_ranges(expected, actual, key, columns, width)
        expected, actual = rows_in(expected, ranges, key, width, pushed), rows_in(actual, ranges, key, width, pushed)
    return expected, actual


def reconcile_by_checksum(
    expected: DataFrame, actual: DataFrame, key: str, compare: Sequence[str], widths: Sequence[int] = WIDTHS, pushed: int = PUSHED
) -> DataFrame:
    """The rows of ``reconcile`` on (key, compared columns), from the ranges that differ alone."""
    e, a = narrowed(expected.select(key, *compare), actual.select(key, *compare), key, [key, *compare], widths, pushed)
    return reconcile(e, a, [key], compare)


def changed_rows(source: DataFrame, copy: DataFrame, key: str, widths: Sequence[int] = WIDTHS, pushed: int = PUSHED) -> DataFrame:
    """Source rows (one per key) that the copy does not hold as they are: what a sync has to upsert."""
    s, c = narrowed(source, copy.select(*source.columns), key, source.columns, widths, pushed)
    held = c.select(key, row_hash(c, source.columns).alias("__h"))
    given = s.withColumn("__h", row_hash(s, source.columns))
    return given.alias("t").join(held.alias("u"), same_key("t", "u", [key, "__h"]), "left_anti").drop("__h")
