"""Start a query, and drain what is available."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

BatchSink = Callable[[DataFrame, int], None]


def drain_to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet files (exactly once by the sink's own log) until the input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain_to_batches(stream: DataFrame, sink: BatchSink, checkpoint: str) -> StreamingQuery:
    """Hand each micro-batch to ``sink`` until the input is used up."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_batch(df: DataFrame, path: str, batch_id: int, *partition_columns: str) -> None:
    """One folder per batch, replaced as a whole when the batch is replayed."""
    df.write.mode("overwrite").partitionBy(*partition_columns).parquet(f"{path}/batch_id={batch_id}")
