"""Live dashboard views over whole tables; only small results leave Spark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.numeric import avg_money, count_when, money, percent, sum_money

At = dt.datetime | Column | None


def as_of_time(as_of: At) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def live_kpis(
    df: DataFrame, time: str = "event_timestamp", as_of: At = None, recent: str = "1 HOUR"
) -> DataFrame:
    """Totals, last-hour figures, customers and completion rate, in one aggregation."""
    amount = money(F.col("total_amount"))
    is_recent = F.col(time) >= as_of_time(as_of) - F.expr(f"INTERVAL {recent}")
    zero = F.lit(0)
    return (
        df.agg(
            F.count(F.lit(1)).alias("total_orders"),
            count_when(is_recent).alias("recent_orders"),
            F.coalesce(sum_money(amount), zero).alias("total_revenue"),
            F.coalesce(sum_money(F.when(is_recent, amount)), zero).alias("recent_revenue"),
            F.count(amount).alias("_amounts"),
            F.count_distinct("customer_id").alias("unique_customers"),
            count_when(F.col("status") == "completed").alias("completed_orders"),
        )
        .withColumn("avg_order_value", avg_money(F.col("total_revenue"), F.col("_amounts")))
        .withColumn(
            "completion_rate",
            F.coalesce(percent(F.col("completed_orders"), F.col("total_orders")), zero),
        )
        .drop("_amounts")
    )


def order_buckets(
    df: DataFrame,
    time: str = "event_timestamp",
    as_of: At = None,
    history: str = "2 HOURS",
    width: str = "5 minutes",
) -> DataFrame:
    """Orders and revenue per time bucket over the recent past."""
    recent = df.filter(F.col(time) >= as_of_time(as_of) - F.expr(f"INTERVAL {history}"))
    return (
        recent.groupBy(F.window(F.col(time), width).alias("w"))
        .agg(
            F.count("order_id").alias("orders"),
            sum_money(money(F.col("total_amount"))).alias("revenue"),
        )
        .select(F.col("w.start").alias("time_bucket"), "orders", "revenue")
        .orderBy("time_bucket")
    )


def customer_event_kpis(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("customer_id").alias("unique_customers"),
        count_when(F.col("event_type") == "customer_create").alias("new_customers"),
        count_when(F.col("event_type") == "customer_update").alias("customer_updates"),
    )


def customer_events_by_segment(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("customer_segment")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.col("events").desc(), "customer_segment")
    )


def item_event_kpis(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_distinct("order_id").alias("orders_with_items"),
        F.sum("quantity").alias("total_quantity"),
        sum_money(money(F.col("total_price"))).alias("total_value"),
    )


def item_events_by_category(events: DataFrame, categories: DataFrame) -> DataFrame:
    """Sums by the product's category; one row a product is joined, not one an event."""
    by_product = events.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"),
        sum_money(money(F.col("total_price"))).alias("revenue"),
        F.count("item_id").alias("items"),
    )
    return (
        by_product.join(categories.select("product_id", "category"), "product_id", "left")
        .groupBy("category")
        .agg(
            F.sum("quantity").alias("total_quantity"),
            sum_money(F.col("revenue")).alias("total_revenue"),
            F.sum("items").alias("item_count"),
        )
        .orderBy(F.col("total_revenue").desc(), "category")
    )


def union_layers(valid: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Valid and quarantined rows together, matched by column name."""
    return valid.unionByName(quarantined, allowMissingColumns=True)


def layer_freshness(
    df: DataFrame, layer: str, event_time: str | None = None
) -> DataFrame:
    """Files, rows, last write and last event of a layer read from files."""
    last_event = F.max(event_time) if event_time else F.lit(None).cast("timestamp")
    return df.agg(
        F.lit(layer).alias("layer"),
        F.count_distinct("_metadata.file_path").alias("files"),
        F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_modification_time").alias("last_modified"),
        last_event.alias("last_event"),
    )
