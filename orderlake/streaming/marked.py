"""Event-time queries that lose no row: each batch is compared with the query's own saved mark.

The mark of a batch is the latest event time of all batches before it less a delay, as with a
watermark. What is too late for it goes to a table of late rows instead of vanishing; what can
still change is kept in small tables that the next batch reads (``batches.BatchTables``).
Batches are plain DataFrame jobs, so aggregates are combined before the shuffle and a key that
holds most rows is split like in batch. All of a batch's tables become visible at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.functions.numeric import avg_money, money, sum_money
from orderlake.operators.fraud import counts_in_window
from orderlake.sources.writers import MONTH
from orderlake.streaming.batches import BatchTables, Version
from orderlake.streaming.sinks import start_batches

NO_TIME, NO_KEY, TOO_LATE = "no_time", "no_key", "too_late"
SECOND = 1_000_000
WINDOW = ("window_start", "window_end", "status")


def _moved(mark: int | None, latest: int | None, delay_seconds: int) -> int | None:
    """The mark after event times up to ``latest``; it never goes back."""
    if latest is None:
        return mark
    return max(latest - delay_seconds * SECOND, mark if mark is not None else latest - delay_seconds * SECOND)


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _after(column: str, mark: int | None) -> Column:
    return F.lit(True) if mark is None else _micros(column) > F.lit(mark)


# ---- revenue windows -------------------------------------------------------------------
def window_parts(orders: DataFrame, duration: str) -> DataFrame:
    """Mergeable figures of each window: sums, latest time and a sketch of the customers."""
    return (
        orders.groupBy(F.window("order_timestamp", duration).alias("_w"), "status")
        .agg(
            F.count("order_id").alias("order_count"),
            sum_money(money(F.col("total_amount"))).alias("total_revenue"),
            F.hll_sketch_agg("customer_id").alias("customers"),
            F.max("order_timestamp").alias("latest"),
        )
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "status",
                "order_count", F.col("total_revenue").cast("decimal(18,2)").alias("total_revenue"),
                "customers", "latest")
    )


def merged_parts(parts: DataFrame, keys: tuple[str, ...] = WINDOW) -> DataFrame:
    """Parts of equal keys as one."""
    return parts.groupBy(*keys).agg(
        F.sum("order_count").alias("order_count"),
        sum_money(F.col("total_revenue")).cast("decimal(18,2)").alias("total_revenue"),
        F.hll_union_agg("customers").alias("customers"),
        F.max("latest").alias("latest"),
    )


def window_figures(parts: DataFrame) -> DataFrame:
    """Revenue windows of merged parts; distinct customers are an estimate (1.6 % standard error)."""
    named = [c for c in parts.columns if c not in ("order_count", "total_revenue", "customers", "latest")]
    return parts.select(
        *named,
        "order_count",
        "total_revenue",
        avg_money(F.col("total_revenue"), F.col("order_count")).alias("avg_order_value"),
        F.hll_sketch_estimate("customers").alias("unique_customers"),
    )


def rolled_up(parts: DataFrame, duration: str) -> DataFrame:
    """Parts of shorter windows merged into longer ones, distinct customers included."""
    longer = F.window("window_start", duration)
    wide = parts.withColumn("_w", longer).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
        *[c for c in parts.columns if c not in ("window_start", "window_end")],
    )
    return merged_parts(wide)


def revenue_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, "revenue")


def to_windows(
    orders: DataFrame,
    base: str,
    checkpoint: str,
    duration: str = "1 minute",
    delay_seconds: int = 600,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Revenue of valid completed orders per window, and the orders that came too late for it.

    Below ``base``: ``revenue_by_window`` holds the parts of closed windows, ``revenue_open``
    those that may still change, ``revenue_late`` the orders of windows closed before they
    came and those without a time. Every valid completed order is in one of the three.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables = revenue_tables(batch.sparkSession, base)
        last = tables.newest(before=batch_id)
        sales = batch.filter((F.col("is_valid_order") == 1) & (F.col("status") == "completed"))
        in_time = _after("window_end", last.mark)
        parts = window_parts(sales, duration).filter(in_time)
        before = tables.table("revenue_open", last)
        if before is not None:
            parts = merged_parts(parts.unionByName(before.filter(in_time)))
        opened = tables.write("revenue_open", parts, batch_id)
        latest = opened.rows.agg(F.max(_micros("latest"))).first()[0]
        mark = _moved(last.mark, latest, delay_seconds)
        closed = tables.write("revenue_by_window", opened.rows.filter(~_after("window_end", mark)), batch_id)
        # A row's window, for rows with and without a time alike.
        ends = F.window("order_timestamp", duration)["end"]
        timed = sales.filter(F.col("order_timestamp").isNotNull())
        late = timed.withColumn("window_end", ends).filter(~_after("window_end", last.mark))
        untimed = sales.filter(F.col("order_timestamp").isNull())
        late_rows = late.withColumn("late_reason", F.lit(TOO_LATE)).unionByName(
            untimed.withColumns(
                {"window_end": F.lit(None).cast("timestamp"), "late_reason": F.lit(NO_TIME)}
            )
        )
        late = tables.write("revenue_late", late_rows, batch_id)
        tables.commit(
            last, batch_id, mark,
            append={"revenue_by_window": closed, "revenue_late": late},
            replace={"revenue_open": opened},
        )

    return start_batches(orders, write, checkpoint, every)


def window_parts_now(spark: SparkSession, base: str) -> DataFrame:
    """The parts of all windows as the newest version has them, with ``is_closed``.

    The version is read once; a batch that is being written does not show.
    """
    tables = revenue_tables(spark, base)
    now = tables.newest()
    opened = tables.table("revenue_open", now)
    if opened is None:
        raise ValueError(f"no batch has been written below {base}")
    return (
        tables.table("revenue_by_window", now).withColumn("is_closed", F.lit(True))
        .unionByName(opened.filter(_after("window_end", now.mark)).withColumn("is_closed", F.lit(False)))
    )


def windows_now(spark: SparkSession, base: str) -> DataFrame:
    """Revenue by window as of the newest version, open windows included (``is_closed``)."""
    return window_figures(window_parts_now(spark, base))


# ---- orders in the last hour, on each order ----------------------------------------------
VELOCITY = ("order_id", "customer_id", "order_timestamp", "total_amount", "status")


def velocity_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, "order_velocity")


def to_order_velocity(
    orders: DataFrame,
    base: str,
    checkpoint: str,
    seconds: int = 3600,
    delay_seconds: int = 600,
    every: str | None = "1 minute",
) -> StreamingQuery:
    """Each valid order with its customer's orders in the ``seconds`` up to and including it.

    Times count in whole seconds. An order is told once the mark has passed it, because earlier
    ones may still come until then. Below ``base``: ``order_velocity`` holds the orders told,
    ``order_velocity_pending`` those that wait, ``order_velocity_late`` those that came when
    their second had been told, or lack a time or customer; ``order_velocity_recent`` counts
    orders by customer and second: at most ``seconds`` rows a customer, however busy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables = velocity_tables(batch.sparkSession, base)
        last = tables.newest(before=batch_id)
        valid = batch.filter(F.col("is_valid_order") == 1).select(*VELOCITY)
        usable = F.col("order_timestamp").isNotNull() & F.col("customer_id").isNotNull()
        second = F.date_trunc("second", F.col("order_timestamp"))
        timed = valid.filter(usable).withColumn("second", second)
        pool = timed.filter(_after("second", last.mark))
        waiting = tables.table("order_velocity_pending", last)
        if waiting is not None:
            pool = pool.unionByName(waiting.filter(_after("second", last.mark)))
        pending = tables.write("order_velocity_pending", pool, batch_id)
        latest = pending.rows.agg(F.max(_micros("second"))).first()[0]
        mark = _moved(last.mark, latest, delay_seconds)

        told = pending.rows.filter(~_after("second", mark))
        counts = told.groupBy("customer_id", "second").agg(F.count(F.lit(1)).alias("n"))
        recent = tables.table("order_velocity_recent", last)
        if recent is not None:
            counts = counts.unionByName(recent)
        last_hour = counts_in_window(
            counts.select(F.col("customer_id").alias("_key"), _micros("second").alias("_at"), F.col("n").alias("_n")),
            seconds,
            "orders_in_last_hour",
        ).select(F.col("_key").alias("customer_id"), F.timestamp_micros("_at").alias("second"), "orders_in_last_hour")
        velocity = tables.write(
            "order_velocity",
            told.join(last_hour, ["customer_id", "second"]).select(*VELOCITY, "orders_in_last_hour"),
            batch_id,
        )
        floor = None if mark is None else mark - seconds * SECOND
        kept = tables.write("order_velocity_recent", counts.filter(_after("second", floor)), batch_id)
        reason = F.when(F.col("order_timestamp").isNull(), NO_TIME).otherwise(NO_KEY)
        late = tables.write(
            "order_velocity_late",
            timed.filter(~_after("second", last.mark)).drop("second").withColumn("late_reason", F.lit(TOO_LATE))
            .unionByName(valid.filter(~usable).withColumn("late_reason", reason)),
            batch_id,
        )
        tables.commit(
            last, batch_id, mark,
            append={"order_velocity": velocity, "order_velocity_late": late},
            replace={"order_velocity_pending": pending, "order_velocity_recent": kept},
        )

    return start_batches(orders, write, checkpoint, every)


def velocity_now(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(orders told, orders that wait, orders that came too late), all of one version."""
    tables = velocity_tables(spark, base)
    now: Version = tables.newest()
    waiting = tables.table("order_velocity_pending", now)
    if waiting is None:
        raise ValueError(f"no batch has been written below {base}")
    return (
        tables.table("order_velocity", now),
        waiting.filter(_after("second", now.mark)).drop("second"),
        tables.table("order_velocity_late", now),
    )


# ---- silver orders ---------------------------------------------------------------------------
SILVER = "orders_enriched_streaming"


def silver_tables(spark: SparkSession, base: str) -> BatchTables:
    return BatchTables(spark, base, SILVER, partition_by={SILVER: ("dated", *MONTH)})


def to_silver_table(
    orders: DataFrame, base: str, checkpoint: str, every: str | None = "1 minute"
) -> StreamingQuery:
    """Enriched orders in one write a batch, split by whether they have a month, and by month.

    Nothing is held in memory; small folders are merged, so files stay few however many
    batches there are.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables = silver_tables(batch.sparkSession, base)
        last = tables.newest(before=batch_id)
        dated = F.col(MONTH[0]).isNotNull() & F.col(MONTH[1]).isNotNull()
        rows = batch.withColumn("dated", dated).hint("rebalance", "dated", *MONTH)
        tables.commit(last, batch_id, None, append={SILVER: tables.write(SILVER, rows, batch_id)})

    return start_batches(orders, write, checkpoint, every)


def silver_now(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(orders with a month, orders in quarantine), both of the newest version."""
    rows = silver_tables(spark, base).table(SILVER)
    if rows is None:
        raise ValueError(f"no batch has been written below {base}")
    return rows.filter("dated").drop("dated"), rows.filter("not dated").drop("dated")
