"""Questions about a message log, asked of a table with the Kafka source's columns."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators.live import At, as_of_time


def topic_partitions(topics: DataFrame) -> DataFrame:
    """(topic, partition) of every declared topic."""
    return topics.filter("partitions > 0").select(
        "topic", F.explode(F.sequence(F.lit(0), F.col("partitions") - 1)).alias("partition")
    )


def partition_stats(messages: DataFrame, topics: DataFrame) -> DataFrame:
    """Messages and offsets per declared partition; empty ones are kept (offsets -1)."""
    seen = messages.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("earliest_offset"),
        F.max("offset").alias("latest_offset"),
    )
    keys = ["topic", "partition"]
    return topic_partitions(topics).join(seen, keys, "left").fillna(
        {"messages": 0, "earliest_offset": -1, "latest_offset": -1}
    )


def offset_gaps(messages: DataFrame) -> DataFrame:
    """(topic, partition, gap_start, gap_end, missing): offsets that a log lacks in between.

    Blocks of 32,768 offsets are summed up as bitmaps, which are combined before the shuffle
    and count a repeated message once. Only blocks with holes are looked at offset by offset, a
    block at a time, so a partition that holds most of the log is not one task.
    """
    place = F.col("offset") + 1
    block = F.bitmap_bucket_number(place)
    keys = ["topic", "partition"]
    blocks = messages.groupBy(*keys, block.alias("_block")).agg(
        F.min("offset").alias("_first"),
        F.max("offset").alias("_last"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("_n"),
    )
    # One row a block: the gap between a block and the one before it.
    by_block = Window.partitionBy(*keys).orderBy("_block")
    between = blocks.select(
        *keys, (F.lag("_last").over(by_block) + 1).alias("gap_start"), (F.col("_first") - 1).alias("gap_end")
    )
    holed = blocks.filter(F.col("_last") - F.col("_first") + 1 > F.col("_n")).select(*keys, "_block")
    by_offset = Window.partitionBy(*keys, "_block").orderBy("offset")
    within = (
        messages.select(*keys, "offset", block.alias("_block"))
        .join(holed, [*keys, "_block"], "left_semi")
        .select(*keys, (F.lag("offset").over(by_offset) + 1).alias("gap_start"), (F.col("offset") - 1).alias("gap_end"))
    )
    return (
        between.unionByName(within)
        .filter("gap_start <= gap_end")
        .withColumn("missing", F.col("gap_end") - F.col("gap_start") + 1)
    )


def topic_stats(stats: DataFrame) -> DataFrame:
    """Per-topic totals over ``partition_stats``."""
    return (
        stats.groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("partition_count"),
            F.sum("messages").alias("total_messages"),
        )
        .withColumn("status", F.when(F.col("total_messages") > 0, "Active").otherwise("Empty"))
    )


def consumer_lag(stats: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages each group has not read yet; a group that never committed starts at 0."""
    groups = committed.select("group_id", "topic").distinct()
    keys = ["group_id", "topic", "partition"]
    return (
        stats.join(groups, "topic")
        .join(committed.select(*keys, "committed_offset"), keys, "left")
        .withColumn("committed_offset", F.coalesce("committed_offset", F.lit(0)))
        .withColumn("lag", F.col("latest_offset") + 1 - F.col("committed_offset"))
        .select(*keys, "latest_offset", "committed_offset", "lag")
    )


def message_snapshots(messages: DataFrame, every: str = "1 hour") -> DataFrame:
    """Running message total per topic at the end of each interval that had messages."""
    per_interval = messages.groupBy("topic", F.window("timestamp", every).alias("w")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # One row per topic and interval, however many messages there were.
    by_time = Window.partitionBy("topic").orderBy("snapshot_time")
    return per_interval.select("topic", F.col("w.end").alias("snapshot_time"), "n").select(
        "topic", "snapshot_time", F.sum("n").over(by_time).alias("total_messages")
    )


def message_rates(snapshots: DataFrame, history: int = 10) -> DataFrame:
    """Messages per minute over the last ``history`` snapshots, at each snapshot."""
    recent = (
        Window.partitionBy("topic").orderBy("snapshot_time").rowsBetween(1 - history, 0)
    )
    seconds = F.unix_micros(F.col("snapshot_time").cast("timestamp")) / F.lit(1_000_000)
    gained = F.col("total_messages") - F.first("total_messages").over(recent)
    elapsed = seconds - F.first(seconds).over(recent)
    rate = F.try_divide(gained * 60, elapsed)
    return snapshots.withColumn("messages_per_minute", F.round(F.coalesce(rate, F.lit(0)), 4))


def read_from(
    messages: DataFrame,
    from_offset: int = 0,
    limit: int = 100,
    topic: str | None = None,
    partition: int | None = None,
) -> DataFrame:
    """The next ``limit`` messages of each partition from an offset on.

    One chosen partition is a plain top-n. Over several, a histogram of offsets tells where
    each partition's last wanted message lies, whatever the limit.
    """
    wanted = messages.filter(F.col("offset") >= from_offset)
    if topic is not None:
        wanted = wanted.filter(F.col("topic") == topic)
    if partition is not None:
        wanted = wanted.filter(F.col("partition") == partition)
    if topic is not None and partition is not None:
        return wanted.orderBy("offset").limit(limit)
    offset = F.col("offset")
    return _first_per(wanted, ["topic", "partition"], offset, [offset], limit, OFFSET_WIDTHS)


def latest_messages(messages: DataFrame, n: int = 5, topic: str | None = None) -> DataFrame:
    """The newest ``n`` messages of each topic, or of one topic."""
    newest = [F.col("timestamp").desc(), F.col("offset").desc(), F.col("partition").desc()]
    if topic is not None:
        return messages.filter(F.col("topic") == topic).orderBy(*newest).limit(n)
    age = -F.unix_micros(F.col("timestamp").cast("timestamp"))
    return _first_per(messages, ["topic"], age, newest, n, TIME_WIDTHS)


# Widths of histogram bins, coarse to fine: offsets; hours and seconds in microseconds.
OFFSET_WIDTHS = (1 << 24, 1 << 12)
TIME_WIDTHS = (3_600_000_000, 1_000_000)


def _first_per(
    df: DataFrame, keys: list[str], value: Column, order: list[Column], n: int, widths: tuple[int, ...]
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, whose first term rises with ``value``.

    Counts by bin, combined before the shuffle, find the bin that holds a group's n-th row;
    finer bins inside it narrow it down. Rows of earlier bins are taken by a plain filter and
    only the last bin's rows are put in order. Rows without a value come last of all.
    """
    # Whatever ``order`` does with nulls, a missing value is beyond every bin.
    rows = df.withColumn("_value", F.coalesce(value, F.lit((1 << 62) - 1)))
    cut, inside = None, rows.withColumn("_before", F.lit(0).cast("bigint"))
    for width in widths:
        bin_of = F.floor(F.col("_value") / width)
        counts = inside.groupBy(*keys, "_before", bin_of.alias("_bin")).agg(F.count(F.lit(1)).alias("_size"))
        upto = F.col("_before") + F.sum("_size").over(Window.partitionBy(*keys).orderBy("_bin"))
        cut = (
            counts.withColumn("_upto", upto)
            .filter((F.col("_upto") >= n) & (F.col("_upto") - F.col("_size") < n))
            .select(*keys, F.col("_bin").alias("_cut"), (F.col("_upto") - F.col("_size")).alias("_before"))
        )
        inside = _with_keys(rows, cut, keys, "inner").filter(bin_of == F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    last = inside.withColumn("_rank", rank).filter(F.col("_before") + F.col("_rank") <= n)
    # Groups of fewer rows have no cut.
    early = _with_keys(rows, cut, keys, "left").filter(F.col("_cut").isNull() | (bin_of < F.col("_cut")))
    return early.select(*df.columns).unionByName(last.select(*df.columns))


def _with_keys(rows: DataFrame, cut: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows beside their group's cut; null is a group like any other."""
    renamed = cut.withColumnsRenamed({k: f"_cut_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_cut_{k}")) for k in keys])
    return rows.join(renamed, same, how).drop(*[f"_cut_{k}" for k in keys])


def flatten_messages(messages: DataFrame, schema: str) -> DataFrame:
    """JSON values spread into columns, with the log position kept beside them."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("_kafka_timestamp"),
        F.col("offset").alias("_kafka_offset"),
        F.col("partition").alias("_kafka_partition"),
    ).select("data.*", "_kafka_timestamp", "_kafka_offset", "_kafka_partition")


def retained(messages: DataFrame, topics: DataFrame, as_of: At = None) -> DataFrame:
    """Messages still within their topic's retention."""
    cutoff = as_of_time(as_of) - F.make_dt_interval(F.lit(0), F.col("retention_hours"))
    return (
        messages.join(topics.select("topic", "retention_hours"), "topic", "left")
        .filter(F.col("retention_hours").isNull() | (F.col("timestamp") >= cutoff))
        .drop("retention_hours")
    )
