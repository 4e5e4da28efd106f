"""Layer writers.

Rows are spread by size, not by key, before a partitioned write: a rebalance
lets adaptive execution merge small months and split one that holds much of the
table, so no single task writes a hot partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.numeric import decimals_to_double
from orderlake.sources.files import Files

MONTH = ("order_year", "order_month")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_by_month(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by year and month; only months present in ``df`` are replaced."""
    (
        df.hint("rebalance", *MONTH)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MONTH)
        .parquet(path)
    )


def write_bronze(tables: Mapping[str, DataFrame], base: str) -> None:
    """Raw tables as they were read, one folder each."""
    for name, df in tables.items():
        write_parquet(df, f"{base}/{name}")


def write_silver(
    orders: DataFrame, fact: DataFrame, customer_metrics: DataFrame, base: str
) -> None:
    write_by_month(orders, f"{base}/orders_enriched")
    write_fact_orders(fact, f"{base}/fact_orders")
    write_customer_metrics(customer_metrics, f"{base}/customer_metrics")


def write_fact_orders(fact: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_by_month(fact, path, mode)


def write_customer_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_parquet(metrics, path, mode)


def write_gold(dashboard: DataFrame, base: str, mode: str = "overwrite") -> None:
    write_parquet(dashboard, f"{base}/customer_segment_monthly", mode)


def export_csv(report: DataFrame, path: str, single_file: bool = False) -> None:
    """Headered CSV. ``single_file`` is for reports whose size does not grow with the data."""
    out = decimals_to_double(report)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def rewrite_retained(kept: DataFrame, path: str) -> None:
    """Store the retained part of a message log, partitioned by topic, in a new place.

    The new copy is complete before readers are pointed at it.
    """
    (
        kept.hint("rebalance", "topic")
        .sortWithinPartitions("topic", "partition", F.col("offset"))
        .write.mode("overwrite")
        .partitionBy("topic")
        .parquet(path)
    )


LOG_DAY = "day"


def write_log(messages: DataFrame, path: str, mode: str = "append") -> None:
    """A message log partitioned by topic and day; messages without a time have no day."""
    (
        messages.withColumn(LOG_DAY, F.to_date("timestamp"))
        .hint("rebalance", "topic", LOG_DAY)
        .sortWithinPartitions("topic", LOG_DAY, "partition", F.col("offset"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", LOG_DAY)
        .parquet(path)
    )


def retain_log(
    spark: SparkSession, path: str, schema: str, topics: DataFrame, as_of: dt.datetime, scratch: str
) -> dict[str, int]:
    """Apply each topic's retention to a log from ``write_log`` in place.

    Whole days before the cutoff go by their folders; of each topic only the cutoff's own day
    is written again, through ``scratch``, and files of other days stay as they are. Topics
    without a retention keep everything, as do messages without a time. Safe to run again.
    Returns how many days were dropped and how many rewritten.
    """
    files = Files(spark, path)
    hours = {r.topic: r.retention_hours for r in topics.select("topic", "retention_hours").distinct().collect()}
    border, dropped = [], 0
    # Folders only: as many names as topics and days.
    for folder in files.names(path):
        topic = unquote(folder.partition("=")[2])
        if not folder.startswith("topic=") or hours.get(topic) is None:
            continue
        cutoff = as_of - dt.timedelta(hours=hours[topic])
        for name in files.names(f"{path}/{folder}"):
            day = name.partition("=")[2]
            if not name.startswith(f"{LOG_DAY}=") or day.startswith("__HIVE"):
                continue
            if day < cutoff.date().isoformat():
                files.delete(f"{path}/{folder}/{name}")
                dropped += 1
            elif day == cutoff.date().isoformat():
                border.append((f"{path}/{folder}/{name}", topic, cutoff))
    for n, (folder, topic, cutoff) in enumerate(border):
        rows = spark.read.schema(schema).parquet(folder).drop("topic")
        kept = rows.filter(F.col("timestamp") >= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp"))
        kept.write.mode("overwrite").parquet(f"{scratch}/{n}")
        kept = spark.read.schema(kept.schema).parquet(f"{scratch}/{n}")
        if kept.isEmpty():
            files.delete(folder)
        else:
            kept.sortWithinPartitions("partition", F.col("offset")).write.mode("overwrite").parquet(folder)
    return {"dropped": dropped, "rewritten": len(border)}


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log from ``write_log``, without the day."""
    return spark.read.schema(f"{schema}, {LOG_DAY} DATE").parquet(path).drop(LOG_DAY)
