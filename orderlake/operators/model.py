"""Star schema joins.

Dimension keys are made unique before they are joined, so a join never repeats
an order. Joins are written so that adaptive execution can split a hot key: the
side that may be skewed is the preserved side of an outer join, or the join is
inner. No side is broadcast by hand; Spark does so only below its size limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.dedupe import drop_duplicates_by_key

# ---- fixed values: the columns of the fact table and of its order part, in this order ----
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_name",
    "customer_segment",
    "order_date",
    "order_year",
    "order_month",
    "status",
    "total_amount",
    "is_completed",
    "customer_data_quality",
)
FACT_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_name",
    "customer_segment",
    "order_date",
    "order_year",
    "order_month",
    "status",
    "total_amount",
    "product_id",
    "product_name",
    "product_category",
    "quantity",
    "unit_price",
    "line_total",
    "is_completed",
    "customer_data_quality",
    "line_calc_valid",
    "product_active",
)
# --------------------------------------------------------------------------------------------


def unique_dimension(dim: DataFrame, key: str) -> DataFrame:
    """One row per non-null key."""
    return drop_duplicates_by_key(dim.filter(F.col(key).isNotNull()), [key])


def order_facts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Valid orders of known customers, one row per order.

    Takes canonical frames. Order-level measures read this and never touch items.
    """
    known = unique_dimension(
        customers.select("customer_id", "name", "segment", "data_quality_score"), "customer_id"
    ).filter(F.col("name").isNotNull())
    return (
        orders.filter(F.col("is_valid_order") == 1)
        .join(known, "customer_id")
        .withColumnsRenamed(
            {
                "name": "customer_name",
                "segment": "customer_segment",
                "data_quality_score": "customer_data_quality",
            }
        )
        .select(*ORDER_COLUMNS)
    )


def line_facts(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Order facts at item grain; an order without usable items keeps one row.

    ``orders`` is read twice, so it should be a stored table, or its join runs twice.
    The outer join is spelled as matched lines plus orders without lines: unlike a
    left join, the inner join lets a hot order be split on the item side. Both joins
    take the same numbered orders, which are therefore shuffled once.
    """
    usable = items.filter(F.col("quantity").isNotNull() & F.col("unit_price").isNotNull())
    with_lines = usable.select("order_id").filter(F.col("order_id").isNotNull()).distinct()
    catalogue = unique_dimension(products, "product_id")
    numbered = orders.filter(F.col("order_id").isNotNull())
    lines = (
        numbered.join(usable.drop("item_id"), "order_id")
        .join(catalogue, "product_id", "left")
        .select(*FACT_COLUMNS)
    )
    bare = numbered.join(with_lines, "order_id", "left_anti").unionByName(
        orders.filter(F.col("order_id").isNull())
    )
    return lines.unionByName(bare, allowMissingColumns=True).select(*FACT_COLUMNS)


def fact_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """The 19-column fact table at order x item grain, from canonical frames."""
    return line_facts(order_facts(orders, customers), items, products)


def fact_orders_raw(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """Orders with whatever customer, item and product they match, nothing filtered.

    ``orders`` comes from ``enrich_orders``; the other frames are raw.
    """
    return raw_line_facts(raw_order_heads(orders, customers), items, products)


def raw_order_heads(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the customer they match, if any."""
    people = unique_dimension(customers.select("customer_id", "name", "segment"), "customer_id")
    return (
        orders.join(people, "customer_id", "left")
        .withColumnsRenamed({"name": "customer_name", "segment": "customer_segment"})
    )


def raw_line_facts(head: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with their customers, at item grain. ``head`` is read twice: store it first."""
    catalogue = unique_dimension(
        products.select("product_id", "product_name", "category"), "product_id"
    )
    item_columns = items.select("order_id", "product_id", "quantity")
    with_items = items.select("order_id").filter(F.col("order_id").isNotNull()).distinct()
    columns = (
        "order_id", "customer_id", "customer_name", "customer_segment", "order_date",
        "order_year", "order_month", "status", "total_amount", "product_id",
        "product_name", "product_category", "quantity", "is_completed",
    )
    lines = (
        head.join(item_columns, "order_id")
        .join(catalogue, "product_id", "left")
        .withColumnRenamed("category", "product_category")
        .select(*columns)
    )
    bare = head.join(with_items, "order_id", "left_anti").select(
        *[c for c in columns if c not in ("product_id", "product_name", "product_category", "quantity")]
    )
    return lines.unionByName(bare, allowMissingColumns=True).select(*columns)


def order_grain(fact: DataFrame) -> DataFrame:
    """Back from item grain to one row per order."""
    return fact.select(*ORDER_COLUMNS).distinct()


def with_value_segment(fact: DataFrame, rfm: DataFrame) -> DataFrame:
    """Facts with their customer's value segment; customers without one drop out."""
    return fact.join(rfm.select("customer_id", "value_segment"), "customer_id")


def item_totals(items: DataFrame, quantity: str = "quantity") -> DataFrame:
    """Quantity totals per order, ready to be joined to orders."""
    return (
        items.filter(F.col(quantity).isNotNull() & F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.sum(quantity).alias("total_quantity"),
            F.count("item_id").alias("item_count"),
            F.max(quantity).alias("max_item_quantity"),
        )
    )


def with_item_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(item_totals(items), "order_id", "left")
