"""Business aggregates.

Order-level figures read one row per order (``model.order_facts``) or, cheaper
for all of them, one row per customer and month (``customer_months``). Where the
input is the item-grain fact, ``grain="line"`` sums once per line and
``grain="order"`` first goes back to one row per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.numeric import avg_money, sum_money
from orderlake.functions.scores import VALUE_SEGMENTS, value_segment
from orderlake.operators.enrich import AsOf, as_of_date
from orderlake.operators.model import order_grain, unique_dimension, with_value_segment


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "completed")


def _order_rows(df: DataFrame, grain: str) -> DataFrame:
    """Rows to sum, with the number of orders each stands for.

    ``as_is``: one row per order or per customer and month; ``order``: collapse
    lines to orders first; ``line``: sum per line.
    """
    if grain not in ("as_is", "order", "line"):
        raise ValueError(f"unknown grain {grain!r}")
    rows = order_grain(df) if grain == "order" else df
    if "orders" not in rows.columns:
        rows = rows.withColumn("orders", F.col("order_id").isNotNull().cast("bigint"))
    return rows


def customer_months(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed sales of known customers, one row per customer and month.

    Orders are summed before anything is joined: a customer sends one row per
    month and map task, however many orders they placed. Segment, RFM, gold and
    dashboard figures all follow from this table.
    """
    sales = (
        completed(orders)
        .filter(F.col("is_valid_order") == 1)
        .groupBy("customer_id", "order_year", "order_month")
        .agg(
            F.sum("total_amount").alias("total_amount"),
            F.count("order_id").alias("orders"),
            F.max("order_date").alias("order_date"),
        )
    )
    known = unique_dimension(
        customers.select("customer_id", "name", "segment"), "customer_id"
    ).filter(F.col("name").isNotNull())
    return sales.join(known, "customer_id").select(
        "customer_id",
        F.col("segment").alias("customer_segment"),
        "order_year",
        "order_month",
        F.lit("completed").alias("status"),
        "total_amount",
        "orders",
        "order_date",
    )


def line_months(fact: DataFrame) -> DataFrame:
    """Completed facts summed per line, one row per customer, segment and month.

    The line-grain counterpart of ``customer_months``: ``rows`` is the number of facts.
    """
    return (
        completed(fact)
        .groupBy("customer_id", "customer_segment", "order_year", "order_month", "status")
        .agg(
            F.sum("total_amount").alias("total_amount"),
            F.count("order_id").alias("orders"),
            F.count("customer_id").alias("rows"),
            F.max("order_date").alias("order_date"),
        )
    )


def _with_average(df: DataFrame, total: str, n: str, name: str = "avg_order_value") -> DataFrame:
    return df.withColumn(name, avg_money(F.col(total), F.col(n)))


def overall_revenue(orders: DataFrame) -> DataFrame:
    totals = completed(orders).agg(
        sum_money(F.col("total_amount")).alias("total_revenue"),
        F.count("order_id").alias("completed_orders"),
    )
    return _with_average(totals, "total_revenue", "completed_orders")


def customer_metrics(orders: DataFrame, customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Completed orders, revenue and average per customer, with segment and tenure."""
    per_customer = (
        completed(orders)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            sum_money(F.col("total_amount")).alias("total_revenue"),
        )
    )
    people = unique_dimension(
        customers.select("customer_id", "join_date", "segment"), "customer_id"
    )
    return (
        _with_average(per_customer, "total_revenue", "total_orders")
        .join(people, "customer_id")
        .withColumn("tenure_days", F.datediff(as_of_date(as_of), F.col("join_date")))
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return (
        completed(orders)
        .groupBy("order_year", "order_month")
        .agg(sum_money(F.col("total_amount")).alias("monthly_revenue"))
        .orderBy("order_year", "order_month")
    )


def revenue_drops(monthly: DataFrame, drop_threshold: float = 0.2) -> DataFrame:
    """Months whose revenue fell by at least the threshold against the month before.

    The only window over a whole frame in the engine; its input has one row per month.
    """
    previous = F.lag("monthly_revenue").over(Window.orderBy("order_year", "order_month"))
    return (
        monthly.withColumn("prev_month_revenue", previous)
        .withColumn(
            "revenue_drop_pct",
            F.try_divide(
                F.col("prev_month_revenue") - F.col("monthly_revenue"), F.col("prev_month_revenue")
            ),
        )
        .filter(F.col("revenue_drop_pct") >= F.lit(drop_threshold))
    )


def segment_analysis(fact: DataFrame, grain: str = "as_is") -> DataFrame:
    totals = (
        completed(_order_rows(fact, grain))
        .groupBy("customer_segment")
        .agg(
            sum_money(F.col("total_amount")).alias("total_revenue"),
            F.sum("orders").alias("order_count"),
        )
    )
    return _with_average(totals, "total_revenue", "order_count").orderBy(
        F.col("total_revenue").desc(), "customer_segment"
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status")
        .agg(F.count("order_id").alias("count"))
        .orderBy(F.col("count").desc(), "status")
    )


def category_performance(fact: DataFrame, measure: str = "line_total") -> DataFrame:
    """Revenue and units per category over completed lines.

    ``measure="order_total"`` weighs each line's quantity with its order's total.
    """
    measures = {
        "line_total": F.col("line_total"),
        "order_total": F.col("quantity") * F.col("total_amount"),
    }
    return (
        fact.filter(F.col("is_completed") == 1)
        .groupBy("product_category")
        .agg(
            sum_money(measures[measure]).alias("category_revenue"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy(F.col("category_revenue").desc_nulls_last(), "product_category")
    )


def customer_rfm(
    fact: DataFrame, as_of: AsOf = None, grain: str = "as_is", rules=VALUE_SEGMENTS
) -> DataFrame:
    """Recency, frequency and monetary value per customer, with a value segment."""
    return (
        completed(_order_rows(fact, grain))
        .groupBy("customer_id")
        .agg(
            F.sum("total_amount").alias("monetary"),
            F.sum("orders").alias("frequency"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn("recency_days", F.datediff(as_of_date(as_of), F.col("last_order_date")))
        .withColumn(
            "value_segment", value_segment(F.col("monetary"), F.col("recency_days"), rules)
        )
    )


def gold_dashboard(
    fact: DataFrame,
    rfm: DataFrame,
    grain: str = "as_is",
    distinct_customers: bool = True,
    customer_sketch: bool = False,
) -> DataFrame:
    """One row per year, month, customer segment and value segment.

    ``distinct_customers=False`` counts input rows instead of customers. Distinct
    customers do not add up over rows: ``customer_sketch`` adds an HLL sketch, whose
    union over any slice estimates that slice's customers.
    """
    keys = ["order_year", "order_month", "customer_segment", "value_segment"]
    # A customer's month is one row before the join, whatever the number of orders,
    # so distinct customers are simply rows and a hot customer is a few rows.
    sales = completed(_order_rows(fact, grain))
    per_customer = (
        sales.groupBy("customer_id", *keys[:3])
        .agg(
            F.sum("total_amount").alias("amount"),
            F.sum("orders").alias("orders"),
            (F.sum("rows") if "rows" in sales.columns else F.count("customer_id")).alias("rows"),
        )
    )
    customers = F.count("customer_id") if distinct_customers else F.sum("rows")
    measures = [
        sum_money(F.col("amount")).alias("revenue"),
        F.sum("orders").alias("order_count"),
        customers.alias("customer_count"),
    ]
    if customer_sketch:
        measures.append(F.hll_sketch_agg("customer_id").alias("customer_sketch"))
    return with_value_segment(per_customer, rfm).groupBy(*keys).agg(*measures).orderBy(*keys)


def _kpis(df: DataFrame, customers: Column) -> DataFrame:
    zero = F.lit(0)
    return df.agg(
        F.coalesce(sum_money(F.col("revenue")), zero).alias("total_revenue"),
        F.coalesce(F.sum("order_count"), zero).alias("total_orders"),
        F.coalesce(customers, zero).alias("unique_customers"),
    ).withColumn(
        "avg_order_value",
        F.coalesce(avg_money(F.col("total_revenue"), F.col("total_orders")), zero),
    )


def dashboard_kpis(sales: DataFrame) -> DataFrame:
    """Headline figures over a slice of completed sales with their value segment.

    Reads orders or customer months, not the gold table, because a customer must
    be counted once per slice. Per-customer totals are formed first.
    """
    per_customer = (
        completed(_order_rows(sales, "as_is"))
        .groupBy("customer_id")
        .agg(F.sum("total_amount").alias("revenue"), F.sum("orders").alias("order_count"))
    )
    return _kpis(per_customer, F.count("customer_id"))


def dashboard_kpis_from_gold(gold: DataFrame) -> DataFrame:
    """The same from a gold table with sketches; customers are an estimate."""
    return _kpis(gold, F.hll_sketch_estimate(F.hll_union_agg("customer_sketch")))


def dashboard_trend(gold: DataFrame) -> DataFrame:
    month = F.format_string("%d-%02d", "order_year", "order_month")
    return (
        gold.groupBy(month.alias("year_month"))
        .agg(sum_money(F.col("revenue")).alias("revenue"))
        .orderBy("year_month")
    )


def dashboard_segments(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("customer_segment")
        .agg(sum_money(F.col("revenue")).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "customer_segment")
    )


def dashboard_value_segments(sales: DataFrame) -> DataFrame:
    """Revenue and customers per value segment, from orders with their value segment."""
    per_customer = (
        completed(sales)
        .groupBy("value_segment", "customer_id")
        .agg(F.sum("total_amount").alias("amount"))
    )
    return (
        per_customer.groupBy("value_segment")
        .agg(
            sum_money(F.col("amount")).alias("revenue"),
            F.count("customer_id").alias("customers"),
        )
        .orderBy("value_segment")
    )


def top_customers(metrics: DataFrame, n: int = 5) -> DataFrame:
    return (
        metrics.orderBy(F.col("total_revenue").desc(), "customer_id")
        .limit(n)
        .select("customer_id", "total_orders", "total_revenue", "avg_order_value", "segment")
    )

