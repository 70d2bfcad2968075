"""Table scans and published snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table ``name`` below ``root``; a dot in the name separates schema and table."""
    return spark.read.parquet(f"{root}/{name.replace('.', '/')}.parquet")


def staged(df: DataFrame, path: str | None) -> DataFrame:
    """Write ``df`` to a new folder in shared storage and read it back; without a path, ``df``.

    For a costly result that a plan uses several times: it is computed once, and what a lost
    executor had done of it is not lost.
    """
    if path is None:
        return df
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Partitioned Parquet with a declared schema; an empty or new folder is an empty table."""
    return spark.read.schema(schema).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *partition_columns: str) -> None:
    """Replace only the partitions present in ``df``.

    Spark stages a dynamic overwrite and moves it at commit, so ``df`` may read from ``path``.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_columns)
        .parquet(path)
    )


def create_partitioned(df: DataFrame, path: str, *partition_columns: str) -> None:
    """Create an empty table folder with the schema of ``df`` if there is none yet."""
    df.limit(0).write.mode("ignore").partitionBy(*partition_columns).parquet(path)


def publish(df: DataFrame, view: str, path: str) -> DataFrame:
    """Write a new snapshot folder, then point the view ``view`` at it.

    Plain Parquet has no MERGE or DELETE, and a path in the plan must not be overwritten: each
    run writes its own folder and readers switch when the view is replaced, after the write
    has been committed. A failed run leaves the old snapshot in place.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return spark.table(view)
