"""Copy-on-write by file for tables without a day: only files that hold a row concerned are rewritten.

The metadata column of a scan says which file a row is in. A semi join with the keys, or a filter that
Parquet statistics can prune, reads key columns alone and gives the names of those files; their rows
are merged and written anew, all other files keep name and time.

A change is staged below ``_rewrite-<run>`` in the table's folder, which readers do not see: the
new files first, then a journal of the old ones. From then on it is decided: the new files are moved in,
the old ones removed. What broke off before is dropped by the next change, what broke off after is finished by
it (``finish``). One change at a time; a reader between the two steps would see both versions.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.operators.retention import RETENTION_DAYS, apply_retention, is_expired
from weirstone.operators.upsert import mark_processed, upsert, upsert_partial, with_matches
from weirstone.sources.tables import staged
from weirstone.streaming.batches import folders, move, remove

STAGED = "_rewrite-"


def finish(spark: SparkSession, path: str) -> None:
    """Complete the changes that were decided and drop those that were not."""
    for name in folders(spark, path):
        if not name.startswith(STAGED):
            continue
        run = f"{path}/{name}"
        if "_SUCCESS" in folders(spark, f"{run}/journal"):
            for file in folders(spark, f"{run}/data"):
                if file.endswith(".parquet"):
                    move(spark, f"{run}/data/{file}", f"{path}/{name.removeprefix(STAGED)}-{file}")
            for row in spark.read.text(f"{run}/journal").collect():  # names of the files concerned
                remove(spark, f"{path}/{row[0]}")
        remove(spark, run)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    finish(spark, path)
    return spark.read.parquet(path)


def _replace(spark: SparkSession, path: str, files: Sequence[str], rows: DataFrame) -> None:
    """Put ``rows`` in the place of ``files``."""
    run = f"{path}/{STAGED}{uuid.uuid4().hex}"
    rows.write.parquet(f"{run}/data")
    names = spark.createDataFrame([(f,) for f in files], "file string")
    names.coalesce(1).write.text(f"{run}/journal")
    finish(spark, path)


def _files_of(rows: DataFrame) -> list[str]:
    """Names of the files that rows of a scan come from."""
    return sorted(r[0] for r in rows.select("__file").distinct().collect())


def _with_file(table: DataFrame) -> DataFrame:
    return table.withColumn("__file", F.col("_metadata.file_name"))


def _rows_of(table: DataFrame, path: str, files: Sequence[str]) -> DataFrame:
    spark = table.sparkSession
    if not files:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(*[f"{path}/{f}" for f in files])


def upsert_files(
    updates: DataFrame, path: str, keys: Sequence[str], staging: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
) -> list[str]:
    """Upsert ``updates`` (unique on the keys); returns the names of the files that were rewritten.

    A key that no file holds is inserted. ``merge`` may be another merge of (rows of those files, updates). The
    updates are written to ``staging`` first (a new folder in shared storage) and computed once.
    """
    spark = updates.sparkSession
    rows = staged(updates, staging)
    table = read_files(spark, path)
    files = _files_of(with_matches(_with_file(table).select("__file", *keys), rows, keys))
    _replace(spark, path, files, (merge or (lambda t, u: upsert(t, u, keys)))(_rows_of(table, path, files), rows))
    return files


def upsert_files_partial(updates: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str], staging: str, defaults: dict[str, Column] | None = None) -> list[str]:
    """A match changes ``columns`` only; an insert gets ``defaults`` as well."""
    return upsert_files(updates, path, keys, staging, lambda t, u: upsert_partial(t, u, keys, columns, defaults))


def mark_files(done: DataFrame, path: str, keys: Sequence[str], at: Column, staging: str, mark: str = "dw_processed_at") -> list[str]:
    """Stamp the unmarked rows with a key in ``done``; files without such a row stay."""
    spark = done.sparkSession
    marks = staged(done.select(*keys).distinct(), staging)
    table = read_files(spark, path)
    unmarked = _with_file(table).filter(F.col(mark).isNull()).select("__file", *keys)
    files = _files_of(with_matches(unmarked, marks, keys))
    if files:
        _replace(spark, path, files, mark_processed(_rows_of(table, path, files), marks, keys, at, mark))
    return files


def expire_files(spark: SparkSession, path: str, timestamp: str, as_of: dt.date, days: int = RETENTION_DAYS) -> list[str]:
    """Remove the rows past their age: the filter skips files by their statistics, the rest is rewritten or goes."""
    table = read_files(spark, path)
    files = _files_of(_with_file(table).filter(is_expired(timestamp, as_of, days)).select("__file"))
    if files:
        _replace(spark, path, files, apply_retention(_rows_of(table, path, files), timestamp, as_of, days))
    return files
