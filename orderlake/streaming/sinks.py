"""Streaming sinks. Each query needs its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from orderlake.sources.writers import MONTH

BATCH = "_batch_id"


def _trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A processing-time trigger, or everything available and stop when ``every`` is None."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    """Start a query that hands each micro-batch and its number to ``write``."""
    writer = (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def to_parquet(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Append to Parquet with Spark's exactly-once file sink (the bronze writer)."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def to_silver(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "1 minute"
) -> StreamingQuery:
    """Rows with a year and month to ``path`` by month, others to ``<path>_invalid_dates``.

    Each micro-batch owns a folder and replaces it when replayed after a failure,
    so nothing is lost or written twice. Errors stop the query.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            dated = F.col(MONTH[0]).isNotNull() & F.col(MONTH[1]).isNotNull()
            (
                batch.filter(dated)
                .hint("rebalance", *MONTH)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy(*MONTH)
                .parquet(f"{path}/{BATCH}={batch_id}")
            )
            (
                batch.filter(~dated)
                .write.mode("overwrite")
                .parquet(f"{path}_invalid_dates/{BATCH}={batch_id}")
            )
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def to_memory(
    stream: DataFrame,
    table: str,
    output_mode: str = "complete",
    every: str | None = "10 seconds",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """A named in-memory table on the driver: for tests and for small aggregates only."""
    writer = stream.writeStream.format("memory").queryName(table).outputMode(output_mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def to_table_snapshot(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Replace a Parquet folder with the current state of an aggregate at each trigger."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    writer = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def to_console(
    stream: DataFrame, output_mode: str = "append", every: str | None = "10 seconds"
) -> StreamingQuery:
    """Print each batch; for debugging."""
    writer = stream.writeStream.format("console").outputMode(output_mode).option("truncate", False)
    return _trigger(writer, every).start()
