"""Upserts on plain DataFrames: the result is a new table, the inputs are left alone.

Keys match null-safely, so a second run over the same updates changes nothing. Updates must be
unique on the keys (``dedup_latest`` first). No side is marked for broadcast: Spark broadcasts
the updates when their size is under ``spark.sql.autoBroadcastJoinThreshold`` (the target is
then streamed without a shuffle), and otherwise joins by shuffle with AQE skew splitting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def without_matches(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``updates``."""
    return target.alias("t").join(updates.select(*keys).alias("u"), same_key("t", "u", keys), "left_anti")


def with_matches(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is in ``updates``."""
    return target.alias("t").join(updates.select(*keys).alias("u"), same_key("t", "u", keys), "left_semi")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], changed: DataFrame | None = None) -> DataFrame:
    """Replace matched rows, insert the others. Columns new in ``updates`` are added.

    ``changed`` may hold the keys of ``updates`` more cheaply (with repeats, before the dedup),
    so that finding the matches does not repeat the dedup.
    """
    matched = updates if changed is None else changed.select(*keys).distinct()
    keep = without_matches(target, matched, keys)
    return keep.unionByName(updates, allowMissingColumns=True)


def upsert_partial(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """On a match change only ``update_cols``; on insert fill ``insert_defaults`` as well.

    The target is read by a semi and an anti join with the same small side, so small updates
    never shuffle it; the merge itself touches at most as many rows as there are updates.
    """
    defaults = insert_defaults or {}
    existing = with_matches(target, updates, keys).withColumn("__found", F.lit(True))
    matched = F.col("e.__found").isNotNull()

    def value(column: str) -> Column:
        if column in keys:
            return F.col(f"u.{column}")
        given = F.col(f"u.{column}") if column in updates.columns else None
        if given is not None and column in update_cols:
            return given
        fallback = defaults.get(column, given if given is not None else F.lit(None))
        return F.when(matched, F.col(f"e.{column}")).otherwise(fallback)

    merged = (
        updates.alias("u")
        .join(existing.alias("e"), same_key("u", "e", keys), "left")
        .select([value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    )
    return without_matches(target, updates, keys).unionByName(merged)


def mark_processed(
    target: DataFrame, done: DataFrame, keys: Sequence[str], at: Column, mark: str = "dw_processed_at"
) -> DataFrame:
    """Stamp the unmarked rows whose key is in ``done``; a mark that is there stays. The keys come by
    join, not as a literal list."""
    flags = done.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn("__done", F.lit(True))
    condition = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    stamp = F.coalesce(F.col(mark), F.when(F.col("__done"), at)).cast(target.schema[mark].dataType)
    joined = target.join(flags, condition, "left")
    return joined.select([stamp.alias(c) if c == mark else F.col(c) for c in target.columns])
