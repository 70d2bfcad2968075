"""One row per key, with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order``, which should be total.

    Spark limits each key to one row on the map side before the shuffle (WindowGroupLimit), so
    a key that owns a third of the rows sends one row per task, not its whole group.
    NULL keys form one group; use ``split_null_keys`` first where they are rejects.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def has_keys(keys: Sequence[str]) -> Column:
    """True where every key column is present."""
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rejected rows)."""
    present = has_keys(keys)
    return df.filter(present), df.filter(~present)
