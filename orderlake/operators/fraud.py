"""Fraud scoring of orders, in batch and row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions import scores as S
from orderlake.functions.numeric import avg_money, count_when, sum_money
from orderlake.operators.model import with_item_totals


def days_since_last_order(orders: DataFrame) -> DataFrame:
    """Adds the customer's previous order date and the gap in days.

    Equivalent to a lag over (order_date, order_id) per customer, without
    gathering a customer's orders in one task: every order but a day's first
    follows one of the same day, so only (customer, day) pairs need the window.
    Days are formed by pre-aggregated group-bys, and a customer has at most one row per
    calendar day in the window. Only one order opens a day: the first in the order of
    number and all other columns. Copies of a row are interchangeable, so they are counted,
    per input split before the shuffle, and the first of the count opens.
    """
    columns, day = orders.columns, ["customer_id", "order_date"]
    rest = ["order_id", *[c for c in columns if c not in (*day, "order_id")]]
    # Copies of one split stay a row of their own: none stands for an unbounded number.
    rows = (
        orders.withColumn("_split", F.spark_partition_id())
        .groupBy(*columns, "_split").agg(F.count(F.lit(1)).alias("_copies"))
    )
    by_customer = Window.partitionBy("customer_id").orderBy("order_date")
    days = (
        rows.groupBy(*day)
        .agg(F.min(F.struct(*rest, "_split")).alias("_first"))
        .withColumn("_day_before", F.lag("order_date").over(by_customer))
    )
    opens = F.struct(*rest, "_split").eqNullSafe(F.col("_first")) & (F.col("_copy") == 1)
    return (
        rows.join(days, day)
        .select(*columns, "_split", "_first", "_day_before", F.explode(F.expr("sequence(1L, _copies)")).alias("_copy"))
        .withColumn("prev_order_date", F.when(opens, F.col("_day_before")).otherwise(F.col("order_date")))
        .withColumn("days_since_last_order", F.datediff("order_date", "prev_order_date"))
        .select(*columns, "prev_order_date", "days_since_last_order")
    )


def score_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Valid orders with their four part scores, total score, type and risk level."""
    valid = orders.filter(F.col("is_valid_order") == 1).select(
        "order_id", "customer_id", "order_date", "total_amount"
    )
    observed = with_item_totals(days_since_last_order(valid), items)
    parts = {
        "amount": S.points_above(F.col("total_amount"), S.BATCH_AMOUNT_TIERS),
        "velocity": S.points_below(F.col("days_since_last_order"), S.VELOCITY_TIERS),
        "quantity": S.points_above(F.col("total_quantity"), S.QUANTITY_TIERS),
        "item": S.points_above(F.col("max_item_quantity"), S.ITEM_TIERS),
    }
    scored = observed.withColumns({f"{name}_score": points for name, points in parts.items()})
    by_name = {name: F.col(f"{name}_score") for name in parts}
    return (
        scored.withColumn("fraud_score", reduce(Column.__add__, by_name.values()))
        .withColumn("fraud_type", S.fraud_type(by_name))
        .withColumn("risk_level", S.batch_risk_level(F.col("fraud_score")))
    )


def potential_fraud(
    orders: DataFrame, items: DataFrame, threshold: int = S.FRAUD_THRESHOLD
) -> DataFrame:
    """Orders whose score reaches the threshold."""
    return (
        score_orders(orders, items)
        .filter(F.col("fraud_score") >= threshold)
        .select(
            "order_id",
            "customer_id",
            F.col("order_date").alias("order_date_cleaned"),
            F.col("total_amount").alias("total_amount_cleaned"),
            "total_quantity",
            "max_item_quantity",
            "fraud_score",
            "fraud_type",
            "risk_level",
            F.lit(True).alias("potential_fraud"),
        )
    )


def row_scores(df: DataFrame) -> DataFrame:
    """Amount and status score of each row; stateless, for streams and tables alike."""
    return df.withColumn(
        "fraud_score",
        S.points_above(F.col("total_amount"), S.STREAM_AMOUNT_TIERS)
        + S.status_points(F.col("status")),
    )


def suspicious_rows(
    df: DataFrame, only_valid: bool = True, threshold: int = S.FRAUD_THRESHOLD
) -> DataFrame:
    if only_valid:
        df = df.filter(F.col("is_valid_order") == 1)
    return row_scores(df).filter(F.col("fraud_score") >= threshold)


def fraud_alerts(orders: DataFrame, at: str = "event_timestamp") -> DataFrame:
    """Alert events for orders that score high enough, with the reasons."""
    amount = S.points_above(F.col("total_amount"), S.ALERT_AMOUNT_TIERS)
    status = S.status_points(F.col("status"))
    reasons = F.array_compact(
        F.array(
            F.when(amount == 4, S.HIGH_AMOUNT_REASON).when(amount == 2, S.ELEVATED_AMOUNT_REASON),
            F.when(status == 1, S.STATUS_REASON),
        )
    )
    needs_review = F.col("fraud_score") >= S.REVIEW_THRESHOLD
    return (
        orders.withColumn("fraud_score", amount + status)
        .filter(F.col("fraud_score") >= S.FRAUD_THRESHOLD)
        .select(
            F.lit("fraud_alert").alias("event_type"),
            F.col(at).alias("event_timestamp"),
            F.concat_ws(
                "_", F.lit("FRAUD"), "order_id", F.unix_seconds(F.col(at).cast("timestamp"))
            ).alias("alert_id"),
            "order_id",
            "customer_id",
            "fraud_score",
            F.when(needs_review, "HIGH").otherwise("MEDIUM").alias("risk_level"),
            reasons.alias("reasons"),
            "total_amount",
            "status",
            needs_review.alias("requires_review"),
        )
    )


def fraud_kpis(scored: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Alerts, high-risk alerts, amount at risk, average and highest score."""
    return scored.agg(
        F.count(F.lit(1)).alias("alerts"),
        count_when(F.col("fraud_score") >= S.REVIEW_THRESHOLD).alias("high_risk"),
        F.coalesce(sum_money(F.col(amount)), F.lit(0)).alias("fraud_amount"),
        F.sum("fraud_score").alias("_points"),
        F.max("fraud_score").alias("max_score"),
    ).select(
        "alerts",
        "high_risk",
        "fraud_amount",
        avg_money(F.col("fraud_amount"), F.col("alerts")).alias("avg_amount"),
        avg_money(F.col("_points").cast("decimal(20,2)"), F.col("alerts")).alias("avg_score"),
        "max_score",
    )


def alert_kpis(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        count_when(F.col("risk_level") == "HIGH").alias("high_risk"),
        count_when(F.col("requires_review")).alias("requires_review"),
        F.sum("fraud_score").cast("decimal(20,2)").alias("_points"),
    ).select(
        "total_alerts",
        "high_risk",
        "requires_review",
        avg_money(F.col("_points"), F.col("total_alerts")).alias("avg_fraud_score"),
    )


def alerts_by_risk(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("risk_level")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy(F.col("alerts").desc(), "risk_level")
    )


def reason_frequency(alerts: DataFrame) -> DataFrame:
    return (
        alerts.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .orderBy(F.col("frequency").desc(), "reason")
    )


def top_scores(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy(F.col("fraud_score").desc(), "order_id").limit(n)


def orders_in_window(
    df: DataFrame,
    key: str = "customer_id",
    time: str = "order_timestamp",
    seconds: int = 3600,
    name: str = "orders_in_last_hour",
) -> DataFrame:
    """Per row, the rows of the same key in the ``seconds`` up to and including its time.

    A sliding frame would re-add its whole content for each row and needs a key's
    full history in one task. Here each instant counts twice: as an arrival in
    its own time bucket, and as an expiry (one instant after it leaves the window)
    in the following bucket. Running sums within (key, bucket) then give the
    count, in linear time. Rows of equal key and time collapse before the shuffle.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    instants = (
        df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        .groupBy(F.col(key).alias("_key"), at.alias("_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = counts_in_window(instants, seconds, name).withColumnRenamed("_key", key)
    return (
        df.withColumn("_at", at).join(counts, [key, "_at"], "left").drop("_at")
    )


def counts_in_window(
    instants: DataFrame, seconds: int, name: str, blocks: int = 64
) -> DataFrame:
    """(_key, _at, name): rows of the key in the ``seconds`` up to and including each instant.

    ``instants`` has the number of rows ``_n`` of each key and time in microseconds. Running
    sums are formed in two steps, so a key that has most of its rows in one window is not one
    task: sums of ``blocks`` parts of a bucket, combined before the shuffle, tell what came
    before a part, and only a part's own rows are put in order.
    """
    # Buckets as long as the window: only the bucket before can still count.
    span = seconds * 1_000_000
    bucket = F.floor(F.col("_at") / span)
    arrival = F.struct(
        bucket.alias("_bucket"), F.col("_at").alias("_tick"),
        F.col("_n").alias("_in"), F.lit(0).cast("bigint").alias("_out"),
    )
    expiry = F.struct(
        (bucket + 1).alias("_bucket"), (F.col("_at") + span + 1).alias("_tick"),
        F.lit(0).cast("bigint").alias("_in"), F.col("_n").alias("_out"),
    )
    place = ["_key", "_bucket", "_block"]
    block = F.floor((F.col("_tick") - F.col("_bucket") * span) / max(1, span // blocks))
    ticks = instants.select("_key", "_at", F.inline(F.array(arrival, expiry))).withColumn("_block", block)
    group = Window.partitionBy("_key", "_bucket")
    by_block = group.orderBy("_block")
    parts = (
        ticks.groupBy(*place).agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
        .select(
            *place,
            (F.sum("_in").over(by_block) - F.col("_in")).alias("_came"),
            # Arrivals of the bucket before that the window still held when the block began.
            (F.sum("_out").over(group) - F.sum("_out").over(by_block) + F.col("_out")).alias("_held"),
        )
    )
    so_far = Window.partitionBy(*place).orderBy("_tick")
    inside = F.sum("_in").over(so_far) - F.sum("_out").over(so_far)
    return (
        ticks.join(parts, place)
        .withColumn(name, F.col("_came") + F.col("_held") + inside)
        .filter(F.col("_in") > 0)
        .select("_key", "_at", name)
    )
