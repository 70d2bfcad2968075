"""Which batches have been folded into a snapshot, and the removal of their folders."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MARKER = "last_batch long, at timestamp"


def _marker(snapshot: str) -> str:
    return f"{snapshot.rstrip('/')}__folded"


def folded_batch(spark: SparkSession, snapshot: str) -> int:
    """Number of the last batch that the snapshot holds, -1 if there is none."""
    if not _exists(spark, _marker(snapshot)):
        return -1
    found = spark.read.schema(MARKER).parquet(_marker(snapshot)).agg(F.max("last_batch")).first()[0]
    return -1 if found is None else found


def record_folded(spark: SparkSession, snapshot: str, batch_id: int) -> None:
    """Append the number; the largest one counts."""
    row = spark.range(1).select(F.lit(batch_id).cast("long").alias("last_batch"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").parquet(_marker(snapshot))


def retire(spark: SparkSession, batches: str, upto: int) -> list[int]:
    """Remove the batch folders up to a number. They have been merged; their rows are not needed."""
    gone = []
    root = _path(spark, batches)
    for status in _files(spark, root).listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.partition("=")[2]) <= upto:
            _files(spark, root).delete(status.getPath(), True)
            gone.append(int(name.partition("=")[2]))
    return sorted(gone)


def has_batches(spark: SparkSession, batches: str) -> bool:
    return _exists(spark, batches)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none if there is no such folder."""
    if not _exists(spark, path):
        return []
    root = _path(spark, path)
    return sorted(status.getPath().getName() for status in _files(spark, root).listStatus(root))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all that is in it; False if there is none."""
    at = _path(spark, path)
    return _files(spark, at).delete(at, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file; one that is there already stays."""
    to = _path(spark, target)
    store = _files(spark, to)
    if not store.exists(to) and not store.rename(_path(spark, path), to):
        raise OSError(f"{path} could not be moved to {target}")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    at = _path(spark, path)
    return _files(spark, at).exists(at)
