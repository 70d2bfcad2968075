"""Messages stored as shredded VARIANT: each path of a document is a Parquet column of its own."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.functions.jsonpath import STORED, stored_document

SHREDDED = {
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    # of a repeated key the last one counts, as when text is parsed
    "spark.sql.variant.allowDuplicateKeys": "true",
}


@contextmanager
def shredding(spark: SparkSession) -> Iterator[None]:
    """Write VARIANT columns shredded by what their first rows hold; the rest stays in the binary part."""
    before = {name: spark.conf.get(name, None) for name in SHREDDED}
    for name, value in SHREDDED.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def store_documents(df: DataFrame, path: str, *partitions: str, text: str = "message", keep_text: bool = True, mode: str = "errorifexists") -> DataFrame:
    """Write the rows with their message as the column ``document``, parsed once, and read them back.

    Reports on the result (``functions.jsonpath.with_message``) read the columns of their paths. The text
    can be left out where nothing scans it; rows whose text is no JSON keep it either way.
    """
    spark = df.sparkSession
    with shredding(spark):
        stored = df.withColumn(STORED, stored_document(F.col(text)))
        if not keep_text:
            stored = stored.withColumn(text, F.when(F.col(STORED).isNull(), F.col(text)))
        stored.write.mode(mode).partitionBy(*partitions).parquet(path)
    return spark.read.parquet(path)
