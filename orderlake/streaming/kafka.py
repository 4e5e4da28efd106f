"""A Kafka topic into tables that account for every offset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.operators.msglog import offset_gaps
from orderlake.sources import readers
from orderlake.streaming.batches import BatchTables
from orderlake.streaming.sinks import start_batches

LOG = ("topic", "partition")


def log_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, "log")


def to_log_tables(
    messages: DataFrame, base: str, checkpoint: str, schema: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Messages with the Kafka source's columns into ``events``, ``undecodable`` and ``gaps``.

    ``undecodable`` holds messages that are no JSON of the schema, as they came; ``gaps`` the
    ranges of offsets that never came, within a batch or between one and the next;
    ``positions`` the next offset of each partition. Messages below it, which a source may
    deliver again, are dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables = log_tables(batch.sparkSession, base)
        last = tables.newest(before=batch_id)
        positions = tables.table("positions", last)
        known = None
        if positions is not None:
            # One row a partition of the log.
            next_offset = positions.select(*LOG, "next_offset")
            batch = (
                batch.join(next_offset, [*LOG], "left")
                .filter(F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset")))
                .drop("next_offset")
            )
            known = positions.select(*LOG, (F.col("next_offset") - 1).alias("offset"))
        decoded = readers.decode_kafka_kept(batch, schema)
        events = tables.write("events", readers.decoded_events(decoded), batch_id)
        undecodable = tables.write("undecodable", readers.undecodable(decoded), batch_id)
        seen = batch.select(*LOG, "offset")
        seen = seen if known is None else seen.unionByName(known)
        gaps = tables.write("gaps", offset_gaps(seen), batch_id)
        moved = tables.write(
            "positions", seen.groupBy(*LOG).agg((F.max("offset") + 1).alias("next_offset")), batch_id
        )
        tables.commit(
            last, batch_id, None,
            append={"events": events, "undecodable": undecodable, "gaps": gaps},
            replace={"positions": moved},
        )

    return start_batches(messages, write, checkpoint, every)
