"""Table-level cleaning: one projection per table, no shuffle.

Each ``clean_*`` keeps the raw columns and adds ``*_cleaned`` ones; the
``canonical_*`` projections give the names everything downstream reads.
``as_of`` is the day recency and tenure are measured against (default today).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import cleaners as C
from orderlake.functions.numeric import money
from orderlake.operators.quality import completeness_score

AsOf = dt.date | Column | None

# ---- fixed values: inclusive bounds outside which a number is discarded ------
ORDER_AMOUNT = (0, 50000)
ITEM_QUANTITY = (1, 100)
ITEM_PRICE = (0, 10000)
ITEM_DISCOUNT = (0, 100)
PRODUCT_PRICE = (0, 100000)
PRODUCT_COST = (0, 100000)
PRODUCT_WEIGHT = (0, 1000)
ADULT_AGE = (18, 120)
LINE_TOTAL_TOLERANCE = 0.01
CUSTOMER_REQUIRED = ("customer_id", "name_cleaned", "email_cleaned", "join_date_cleaned")
# ------------------------------------------------------------------------------


def as_of_date(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def enrich_orders(orders: DataFrame) -> DataFrame:
    """Year, month and completion flag from columns taken as they are."""
    day = F.col("order_date").try_cast("date")
    return orders.withColumns(
        {
            "order_year": F.year(day),
            "order_month": F.month(day),
            "is_completed": flag(F.col("status") == "completed"),
        }
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    amount = money(C.clean_number(F.col("total_amount"), *ORDER_AMOUNT))
    cleaned = orders.withColumns(
        {
            "order_date_cleaned": C.clean_date(F.col("order_date")),
            "status_cleaned": C.clean_status(F.col("status")),
            "total_amount_cleaned": amount,
        }
    )
    usable = (
        F.col("order_date_cleaned").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("total_amount_cleaned") > 0)
    )
    return cleaned.withColumns(
        {
            "order_year": F.year("order_date_cleaned"),
            "order_month": F.month("order_date_cleaned"),
            "is_completed": flag(F.col("status_cleaned") == "completed"),
            "is_valid_order": flag(usable),
        }
    )


def canonical_orders(cleaned: DataFrame) -> DataFrame:
    """Cleaned orders under their plain names."""
    return cleaned.select(
        "order_id",
        "customer_id",
        F.col("order_date_cleaned").alias("order_date"),
        F.col("status_cleaned").alias("status"),
        F.col("total_amount_cleaned").alias("total_amount"),
        "order_year",
        "order_month",
        "is_completed",
        "is_valid_order",
    )


def clean_customers(customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    cleaned = customers.withColumns(
        {
            "name_cleaned": C.clean_name(F.col("name")),
            "email_cleaned": C.clean_email(F.col("email")),
            "join_date_cleaned": C.clean_date(F.col("join_date")),
            "segment_cleaned": C.clean_segment(F.col("segment")),
            "marketing_opt_in_cleaned": C.clean_boolean(F.col("marketing_opt_in")),
            "phone_cleaned": C.clean_phone(F.col("phone")),
            "age_valid": F.when(F.col("age").between(*ADULT_AGE), F.col("age")),
        }
    )
    return completeness_score(cleaned, CUSTOMER_REQUIRED).withColumn(
        "tenure_days", F.datediff(as_of_date(as_of), F.col("join_date_cleaned"))
    )


def canonical_customers(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "customer_id",
        F.col("name_cleaned").alias("name"),
        F.col("segment_cleaned").alias("segment"),
        F.col("join_date_cleaned").alias("join_date"),
        "data_quality_score",
    )


def clean_order_items(items: DataFrame) -> DataFrame:
    cleaned = items.withColumns(
        {
            "quantity_cleaned": C.clean_number(F.col("quantity"), *ITEM_QUANTITY),
            "price_cleaned": money(C.clean_number(F.col("price"), *ITEM_PRICE)),
            "discount_percent_cleaned": C.clean_number(
                F.col("discount_percent"), *ITEM_DISCOUNT
            ).try_cast("decimal(5,2)"),
        }
    )
    subtotal = (F.col("quantity_cleaned") * F.col("price_cleaned")).cast("decimal(18,2)")
    # A hundredth of a percent of a cent: six decimals hold it exactly.
    discount = (
        F.col("subtotal_calculated")
        * F.col("discount_percent_cleaned")
        * F.lit("0.01").cast("decimal(3,2)")
    ).cast("decimal(22,6)")
    total = (
        F.col("subtotal_calculated")
        - F.col("discount_amount_calculated")
        + F.coalesce(money(F.col("tax_amount")), F.lit(0))
    ).cast("decimal(22,6)")
    off_by = F.abs(F.col("line_total").try_cast("decimal(22,6)") - F.col("line_total_calculated"))
    return (
        cleaned.withColumn("subtotal_calculated", subtotal)
        .withColumn("discount_amount_calculated", F.coalesce(discount, F.lit(0).cast("decimal(22,6)")))
        .withColumn("line_total_calculated", total)
        .withColumn("calculation_matches", F.coalesce(off_by < LINE_TOTAL_TOLERANCE, F.lit(False)))
    )


def canonical_items(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "item_id",
        "order_id",
        "product_id",
        F.col("quantity_cleaned").alias("quantity"),
        F.col("price_cleaned").alias("unit_price"),
        F.col("line_total_calculated").alias("line_total"),
        F.col("calculation_matches").alias("line_calc_valid"),
    )


def clean_products(products: DataFrame) -> DataFrame:
    cleaned = products.withColumns(
        {
            "unit_price_cleaned": money(C.clean_number(F.col("unit_price"), *PRODUCT_PRICE)),
            "cost_cleaned": money(C.clean_number(F.col("cost"), *PRODUCT_COST)),
            "weight_kg_cleaned": C.clean_number(F.col("weight_kg"), *PRODUCT_WEIGHT),
            "is_active_cleaned": C.clean_boolean(F.col("is_active")),
            "created_date_cleaned": C.clean_date(F.col("created_date")),
            "product_name_cleaned": C.clean_product_name(F.col("product_name")),
            "category_cleaned": C.clean_category(F.col("category")),
        }
    )
    price, cost = F.col("unit_price_cleaned"), F.col("cost_cleaned")
    return cleaned.withColumns(
        {
            "margin_percent": F.when(
                price > 0, F.round(F.try_divide((price - cost) * 100, price), 2)
            ),
            "price_cost_valid": cost <= price,
        }
    )


def canonical_products(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "product_id",
        F.col("product_name_cleaned").alias("product_name"),
        F.col("category_cleaned").alias("product_category"),
        F.col("is_active_cleaned").alias("product_active"),
    )
