"""Referential integrity between orders, customers, items and products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null key has no parent. Copies of parent keys are merged first."""
    known = parent.select(key).filter(F.col(key).isNotNull()).distinct()
    return child.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str, issue: str) -> DataFrame:
    """Number of orphans. Keys are counted before the join, so a hot key is one row in it."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return orphans(per_key, parent, key).agg(
        F.lit(issue).alias("issue"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_count")
    )


def referential_issues(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    checks = [
        (orders, customers, "customer_id", "orders_missing_customers"),
        (items, orders, "order_id", "order_items_missing_orders"),
        (items, products, "product_id", "order_items_missing_products"),
    ]
    return reduce(DataFrame.unionByName, [orphan_count(*check) for check in checks])
