"""The batch job: raw files to bronze, silver and gold, with reports.

Each layer is written and read back before the next one is built, so cleaning
runs once, a lost executor re-reads files, and nothing is cached in memory.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import (
    dedupe,
    enrich,
    fraud,
    integrity,
    metrics,
    model,
    quality,
)
from orderlake.operators.enrich import AsOf
from orderlake.sources import readers, writers

KEYS = {
    "orders": "order_id",
    "customers": "customer_id",
    "order_items": "item_id",
    "products": "product_id",
}


@dataclass(frozen=True)
class RawPaths:
    """Where the four inputs lie: CSV, JSON lines, CSV, Parquet."""

    orders: str
    customers: str
    order_items: str
    products: str


def read_raw(spark: SparkSession, paths: RawPaths, allow_missing: bool = False) -> dict[str, DataFrame]:
    """The raw tables. A missing one is an error, or empty with ``allow_missing``.

    Malformed lines of the text sources keep their text in a column beside the fields.
    """
    kept = {"keep_corrupt": True}
    sources = {
        "orders": (partial(readers.read_orders, **kept), paths.orders, schemas.ORDERS),
        "customers": (partial(readers.read_customers, **kept), paths.customers, schemas.CUSTOMERS),
        "order_items": (partial(readers.read_order_items, **kept), paths.order_items, schemas.ORDER_ITEMS),
        "products": (readers.read_products, paths.products, schemas.PRODUCTS),
    }
    if allow_missing:
        return {n: readers.read_or_empty(r, spark, p, s) for n, (r, p, s) in sources.items()}
    return {n: read(spark, path) for n, (read, path, _) in sources.items()}


def reconciled(spark: SparkSession, paths: RawPaths, lake: str) -> DataFrame:
    """Lines of the text sources against the rows that bronze holds of them."""
    text = {"orders": (paths.orders, True), "customers": (paths.customers, False), "order_items": (paths.order_items, True)}
    return quality.line_reconciliation(
        {
            name: (readers.line_counts(spark, path, header), spark.read.parquet(f"{lake}/bronze/{name}"))
            for name, (path, header) in text.items()
        },
        readers.CORRUPT,
    )


def quality_reports(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Measures of the raw tables."""
    return {
        "null_counts": quality.null_counts(raw["orders"]),
        "duplicate_orders": quality.duplicate_keys(raw["orders"], "order_id"),
        "quality_summary": quality.quality_summary(
            {name: (raw[name], key) for name, key in KEYS.items()}
        ),
        "referential_issues": integrity.referential_issues(
            raw["orders"], raw["customers"], raw["order_items"], raw["products"]
        ),
    }


def run_batch(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    lake: str,
    exports: str | None = None,
    as_of: AsOf = None,
    dedupe_orders: bool = True,
) -> dict[str, DataFrame]:
    """Write all layers and return the reports, which read the written tables.

    ``dedupe_orders=False`` keeps repeated order records, which then count twice. Bronze holds
    every line; malformed ones go on to ``silver/quarantine/malformed`` as text.
    """
    bronze, silver = f"{lake}/bronze", f"{lake}/silver"
    writers.write_bronze(raw, bronze)
    raw = {name: spark.read.parquet(f"{bronze}/{name}") for name in KEYS}
    for name in KEYS:
        if readers.CORRUPT in raw[name].columns:
            raw[name], malformed = quality.split_malformed(raw[name], readers.CORRUPT)
            writers.write_parquet(malformed, f"{silver}/quarantine/malformed/{name}")

    orders = raw["orders"]
    if dedupe_orders:
        orders = dedupe.drop_duplicates_by_key(orders, ["order_id"], keep_unkeyed=True)
    cleaned = {
        "orders": enrich.clean_orders(orders),
        "customers": enrich.clean_customers(raw["customers"], as_of),
        "order_items": enrich.clean_order_items(raw["order_items"]),
        "products": enrich.clean_products(raw["products"]),
    }
    for name, df in cleaned.items():
        writers.write_parquet(df, f"{silver}/cleaned/{name}")
    cleaned = {name: spark.read.parquet(f"{silver}/cleaned/{name}") for name in KEYS}

    _, quarantined = quality.split_valid(cleaned["orders"], quality.order_rules())
    writers.write_parquet(quarantined, f"{silver}/quarantine/orders")

    orders = enrich.canonical_orders(cleaned["orders"])
    customers = enrich.canonical_customers(cleaned["customers"])
    items = enrich.canonical_items(cleaned["order_items"])
    products = enrich.canonical_products(cleaned["products"])
    valid = orders.filter(F.col("is_valid_order") == 1)

    # Both halves of the fact table read the orders with their customers.
    writers.write_parquet(model.order_facts(orders, customers), f"{silver}/order_facts")
    order_facts = spark.read.parquet(f"{silver}/order_facts")
    writers.write_silver(
        cleaned["orders"].filter(F.col("is_valid_order") == 1),
        model.line_facts(order_facts, items, products),
        metrics.customer_metrics(valid, customers, as_of),
        silver,
    )
    fact = spark.read.parquet(f"{silver}/fact_orders")
    customer_metrics = spark.read.parquet(f"{silver}/customer_metrics")

    months_path = f"{silver}/customer_months"
    writers.write_parquet(metrics.customer_months(orders, customers), months_path)
    months = spark.read.parquet(months_path)
    rfm = metrics.customer_rfm(months, as_of)
    writers.write_gold(
        metrics.gold_dashboard(months, rfm, customer_sketch=True), f"{lake}/gold"
    )
    gold = spark.read.parquet(f"{lake}/gold/customer_segment_monthly")

    fraud_path = f"{lake}/gold/potential_fraud_orders"
    writers.write_parquet(fraud.potential_fraud(orders, items), fraud_path)
    suspicious = spark.read.parquet(fraud_path)
    if exports:
        # The gold table has a row per month and segment; fraud grows with the data.
        writers.export_csv(
            gold.drop("customer_sketch"), f"{exports}/gold_customer_segment_monthly_csv", True
        )
        writers.export_csv(suspicious, f"{exports}/potential_fraud_orders")

    monthly = metrics.monthly_revenue(valid)
    return {
        **quality_reports(raw),
        "cleaning_impact": quality.cleaning_impact(
            cleaned["orders"], cleaned["customers"], cleaned["order_items"]
        ),
        "valid_ratio": quality.valid_ratio(orders),
        "overall_revenue": metrics.overall_revenue(valid),
        "top_customers": metrics.top_customers(customer_metrics),
        "segment_analysis": metrics.segment_analysis(months),
        "monthly_revenue": monthly,
        "status_distribution": metrics.status_distribution(orders),
        "category_performance": metrics.category_performance(fact),
        "customer_rfm": rfm,
        "revenue_drops": metrics.revenue_drops(monthly),
        "gold": gold,
        "potential_fraud": suspicious,
    }
