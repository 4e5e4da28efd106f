"""Canonical frames of the supplied tables, as the registered queries use them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.numeric import decimals_to_double
from orderlake.operators import enrich, fraud, metrics, model
from orderlake.session import new_scratch_dir
from orderlake.sources import supplied, writers

# The supplied orders end on 2001-08-01.
AS_OF = dt.date(2001, 9, 1)


def live_as_of() -> Column:
    """A time shortly before the last event, in the session's time zone like the events."""
    return F.lit("2024-01-30 23:00:00").cast("timestamp")


_layers: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer table, written on first use and read from then on.

    Reading and cleaning are paid once for all queries of an application, filters
    reach the Parquet scan instead of being evaluated on top of the cleaners, and
    a lost executor costs a re-read, not a re-clean.
    """
    key = (spark.sparkContext.applicationId, d, name)
    if key in _layers:
        try:
            return spark.read.parquet(_layers[key])
        except AnalysisException as error:
            # The scratch folder was cleaned up in between: build the table again.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    path = new_scratch_dir(spark, name)
    writers.write_parquet(build(), path)
    _layers[key] = path
    return spark.read.parquet(path)


def _spread_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A supplied table in at least one split per core.

    A small file may be a single split, which would leave the other cores idle here
    and in every later scan. A table that already has as many splits is not shuffled.
    """
    df = supplied.table(spark, d, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# ---- bronze: raw tables as received --------------------------------------------
def _bronze(spark: SparkSession, d: str, name: str, adapt: Callable) -> DataFrame:
    return stored(spark, d, f"bronze-{name}", lambda: adapt(spark, d, _spread_table))


def incoming_orders(spark: SparkSession, d: str) -> DataFrame:
    """Raw orders for a lake that stores them as its own bronze."""
    return supplied.raw_orders(spark, d, _spread_table)


def incoming_items(spark: SparkSession, d: str) -> DataFrame:
    return supplied.raw_order_items(spark, d, _spread_table)


def raw_orders(spark: SparkSession, d: str) -> DataFrame:
    return _bronze(spark, d, "orders", supplied.raw_orders)


def raw_customers(spark: SparkSession, d: str) -> DataFrame:
    return _bronze(spark, d, "customers", supplied.raw_customers)


def raw_items(spark: SparkSession, d: str) -> DataFrame:
    return _bronze(spark, d, "order_items", supplied.raw_order_items)


def raw_products(spark: SparkSession, d: str) -> DataFrame:
    return _bronze(spark, d, "products", supplied.raw_products)


# ---- silver: raw and cleaned columns side by side --------------------------------
def clean_orders(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark, d, "silver-orders", lambda: enrich.clean_orders(raw_orders(spark, d))
    )


def clean_customers(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark,
        d,
        "silver-customers",
        lambda: enrich.clean_customers(raw_customers(spark, d), AS_OF),
    )


def clean_items(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark, d, "silver-order_items", lambda: enrich.clean_order_items(raw_items(spark, d))
    )


def clean_products(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark, d, "silver-products", lambda: enrich.clean_products(raw_products(spark, d))
    )


# ---- canonical projections of silver --------------------------------------------
def orders(spark: SparkSession, d: str) -> DataFrame:
    return enrich.canonical_orders(clean_orders(spark, d))


def valid_orders(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).filter(F.col("is_valid_order") == 1)


def customers(spark: SparkSession, d: str) -> DataFrame:
    return enrich.canonical_customers(clean_customers(spark, d))


def items(spark: SparkSession, d: str) -> DataFrame:
    return enrich.canonical_items(clean_items(spark, d))


def products(spark: SparkSession, d: str) -> DataFrame:
    return enrich.canonical_products(clean_products(spark, d))


# ---- modelled tables ---------------------------------------------------------------
def order_facts(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark,
        d,
        "silver-order_facts",
        lambda: model.order_facts(orders(spark, d), customers(spark, d)),
    )


def build_fact(spark: SparkSession, d: str) -> DataFrame:
    return model.line_facts(order_facts(spark, d), items(spark, d), products(spark, d))


def fact(spark: SparkSession, d: str) -> DataFrame:
    """Facts at item grain, joined where they are read and not stored.

    The join then carries the columns of that one query, and rows that it filters out
    never reach it. A query that reads facts twice stores what it needs of them.
    """
    return build_fact(spark, d)


def line_months(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark, d, "silver-line_months", lambda: metrics.line_months(fact(spark, d))
    )


def customer_months(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark,
        d,
        "silver-customer_months",
        lambda: metrics.customer_months(orders(spark, d), customers(spark, d)),
    )


def potential_fraud(spark: SparkSession, d: str) -> DataFrame:
    return stored(
        spark,
        d,
        "gold-potential_fraud",
        lambda: fraud.potential_fraud(orders(spark, d), items(spark, d)),
    )


def rfm(spark: SparkSession, d: str) -> DataFrame:
    return metrics.customer_rfm(customer_months(spark, d), AS_OF)


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Completed sales per customer and month, with the customer's value segment."""
    return model.with_value_segment(customer_months(spark, d), rfm(spark, d))


def gold(spark: SparkSession, d: str) -> DataFrame:
    return metrics.gold_dashboard(customer_months(spark, d), rfm(spark, d))


def report(df: DataFrame) -> DataFrame:
    """Doubles for decimals and zone-free timestamps, for comparison with other engines."""
    df = decimals_to_double(df)
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
