"""Expected against actual state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING, EXTRA, MISMATCHED, SAME = "missing", "extra", "mismatched", "same"


def reconcile(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], compare: Sequence[str], keep_same: bool = False
) -> DataFrame:
    """One row per key that differs: keys, drift, ``expected_*`` and ``actual_*`` columns.

    Both sides are stacked and grouped by key: one shuffle with map-side combining instead of
    a full outer join, so repeated keys on either side collapse before the shuffle. A repeated
    key counts once, with its greatest compared values. NULL keys match each other and NULL
    values compare as equal.
    """
    values = F.struct(*compare)

    def side(df: DataFrame, expected_side: bool) -> DataFrame:
        return df.select(*keys, F.lit(expected_side).alias("__expected"), values.alias("__values"))

    both = side(expected, True).unionByName(side(actual, False))
    grouped = both.groupBy(*keys).agg(
        F.max(F.when(F.col("__expected"), F.col("__values"))).alias("__e"),
        F.max(F.when(~F.col("__expected"), F.col("__values"))).alias("__a"),
    )
    drift = (
        F.when(F.col("__a").isNull(), MISSING)
        .when(F.col("__e").isNull(), EXTRA)
        .when(F.col("__e").eqNullSafe(F.col("__a")), SAME)
        .otherwise(MISMATCHED)
    )
    columns: list[Column] = [F.col(f"__e.{c}").alias(f"expected_{c}") for c in compare]
    columns += [F.col(f"__a.{c}").alias(f"actual_{c}") for c in compare]
    result = grouped.select(*keys, drift.alias("drift"), *columns)
    return result if keep_same else result.filter(F.col("drift") != SAME)


def policy_drift(expected: DataFrame, actual: DataFrame, keep_same: bool = False) -> DataFrame:
    """Drift of masking policies: the grantee is compared without case, name and priority with."""

    def keyed(df: DataFrame) -> DataFrame:
        column_id = F.concat_ws(".", "schema_name", "table_name", "column_name")
        return df.select(
            column_id.alias("column_id"), F.upper("grantee").alias("grantee_key"), "policy_name", "priority", "grantee"
        )

    return reconcile(
        keyed(expected), keyed(actual), ["column_id", "grantee_key"], ["policy_name", "priority"], keep_same
    )


def only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")


def in_both(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that both sides have."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_semi")
