"""Streaming transformations; each also runs on a static frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.cleaners import STREAM_DATE_PATTERNS, clean_date
from orderlake.functions.numeric import avg_money, money, sum_money
from orderlake.operators.enrich import flag
from orderlake.operators.fraud import suspicious_rows

WATERMARK = "10 minutes"


def enrich_order_events(events: DataFrame) -> DataFrame:
    """Parsed times, partition columns and flags.

    An order whose date cannot be told keeps null year and month, which sends it
    to quarantine instead of into an invented month.
    """
    timed = events.withColumns(
        {
            "processing_timestamp": F.current_timestamp(),
            "order_timestamp": F.try_to_timestamp("event_timestamp"),
            "order_date_parsed": clean_date(F.col("order_date"), STREAM_DATE_PATTERNS),
        }
    )
    day = F.coalesce("order_date_parsed", F.col("order_timestamp").cast("date"))
    usable = (
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("total_amount") > 0)
    )
    return timed.withColumns(
        {
            "order_year": F.year(day),
            "order_month": F.month(day),
            "is_completed": flag(F.col("status") == "completed"),
            "is_valid_order": flag(usable),
        }
    )


def revenue_by_window(
    orders: DataFrame,
    duration: str = "1 minute",
    slide: str | None = None,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Revenue of valid completed orders per time window; ``slide`` makes windows overlap."""
    amount = money(F.col("total_amount"))
    span = F.window("order_timestamp", duration, slide) if slide else F.window("order_timestamp", duration)
    return (
        orders.filter((F.col("is_valid_order") == 1) & (F.col("status") == "completed"))
        .withWatermark("order_timestamp", watermark)
        .groupBy(span, "status")
        .agg(
            F.count("order_id").alias("order_count"),
            sum_money(amount).alias("total_revenue"),
            F.approx_count_distinct("customer_id").alias("unique_customers"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "status",
            "order_count",
            "total_revenue",
            avg_money(F.col("total_revenue"), F.col("order_count")).alias("avg_order_value"),
            "unique_customers",
        )
    )


def fraud_stream(orders: DataFrame) -> DataFrame:
    """Suspicious orders row by row; order velocity is ``customer_velocity``."""
    return suspicious_rows(orders).select(
        "order_id", "customer_id", "order_timestamp", "total_amount", "fraud_score", "status"
    )


def customer_velocity(
    orders: DataFrame,
    window: str = "1 hour",
    step: str = "5 minutes",
    min_orders: int = 1,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Orders per customer in the trailing window, at each step in which they ordered.

    Two chained windowed aggregations instead of a stream-stream self-join, which
    would emit every pair of a busy customer's orders. The first counts per step
    and is combined before the shuffle, so a customer sends one row per step and
    task; the second adds the steps of the trailing window.
    """
    valid = orders.filter(F.col("is_valid_order") == 1).withWatermark("order_timestamp", watermark)
    per_step = valid.groupBy(F.window("order_timestamp", step).alias("tick"), "customer_id").agg(
        F.count("order_id").alias("orders")
    )
    trailing = F.window(F.window_time("tick"), window, step).alias("span")
    return (
        per_step.withColumn("tick_end", F.col("tick.end"))
        .groupBy(trailing, "customer_id")
        .agg(
            F.sum("orders").alias("orders_in_window"),
            F.max("tick_end").alias("last_tick"),
        )
        .filter((F.col("last_tick") == F.col("span.end")) & (F.col("orders_in_window") >= min_orders))
        .select("customer_id", F.col("span.end").alias("as_of"), "orders_in_window")
    )
