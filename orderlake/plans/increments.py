"""A lake that takes new orders and lines by rewriting only the months they touch.

Each arrival is a folder of its own in bronze, so a repeated arrival replaces itself. Silver
orders, facts and customer months are partitioned by month. An arrival touches the months that
its orders, and the orders of its lines, had before and have now; those months are built again
from silver's other rows and bronze's rows of the changed orders. RFM and gold follow from the
customer months, whose sums merge: they never read orders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import dedupe, enrich, metrics, model
from orderlake.operators.enrich import AsOf
from orderlake.session import bulk_settings, new_scratch_dir
from orderlake.sources import writers
from orderlake.sources.files import Files
from orderlake.sources.writers import MONTH

ARRIVAL = "arrival"
# Bytes of stored lines whose facts are joined at once: what a refresh shuffles at a time is some
# ten times as much, however large the lake is.
LINE_BYTES = 1 << 30


@dataclass(frozen=True)
class Dimensions:
    """Canonical customers and products. When they change, every month has to be built anew."""

    customers: DataFrame
    products: DataFrame


@contextmanager
def _scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Stores frames in the scratch folder, from which they go at the end."""
    paths = []

    def stored(df: DataFrame, label: str) -> DataFrame:
        paths.append(new_scratch_dir(spark, label))
        writers.write_parquet(df, paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stored
    finally:
        for path in paths:
            Files(spark, path).delete(path)


def _existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at a path, or no rows like those of a frame."""
    if not Files(spark, path).names(path):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path)


def _within(months: list[tuple[int, int]]) -> Column:
    """Rows of some months; a filter on partition columns.

    Names each column once: below it, a month may be an expression that parses a date.
    """
    return (F.col(MONTH[0]) * 100 + F.col(MONTH[1])).isin([y * 100 + m for y, m in months])


def _replace_months(parts: Iterable[DataFrame], path: str, months: list[tuple[int, int]]) -> None:
    """Write the months' rows, given in parts, in place of what the table had of them.

    All are complete beside the table before any of its files goes, so these may be among the
    inputs. A month without rows goes.
    """
    staged = f"{path}-staged"
    files = None
    for df in parts:
        if files is None:
            files = Files(df.sparkSession, path)
            files.delete(staged)
        writers.write_by_month(df, staged, "append")
    files.make(path)
    for year, month in months:
        folder = f"{MONTH[0]}={year}/{MONTH[1]}={month}"
        files.delete(f"{path}/{folder}")
        if files.names(f"{staged}/{folder}"):
            files.move(f"{staged}/{folder}", f"{path}/{folder}")
    files.delete(staged)


def _fact_parts(heads: DataFrame, raw_items: DataFrame, products: DataFrame, n: int) -> Iterator[DataFrame]:
    """Facts of the orders and their lines, in as many parts by hashes of their numbers."""
    number = F.pmod(F.xxhash64("order_id"), F.lit(n))
    for k in range(n):
        # Every head has a fact, and its join takes no other order's lines.
        lines = enrich.canonical_items(enrich.clean_order_items(raw_items.filter(number == k)))
        yield model.line_facts(heads.filter(number == k), lines, products)


def _clean_orders(raw: DataFrame) -> DataFrame:
    # Columns after the last of these can only tell apart records that are cleaned alike.
    last = max(raw.columns.index(c) for c in ("order_id", "customer_id", "order_date", "status", "total_amount"))
    raw = raw.select(*raw.columns[: last + 1])
    raw = dedupe.drop_duplicates_by_key(raw, ["order_id"], keep_unkeyed=True)
    return enrich.canonical_orders(enrich.clean_orders(raw)).filter(F.col("is_valid_order") == 1)


def refresh(
    spark: SparkSession,
    lake: str,
    arrival: str,
    orders: DataFrame,
    items: DataFrame,
    dimensions: Dimensions,
    as_of: AsOf = None,
) -> list[tuple[int, int]]:
    """Take an arrival of raw orders and lines into the lake; the months it touched.

    ``arrival`` names it; the same name again replaces it. Orders known already are replaced
    by the first of all their records, as in a full run. Orders without a number cannot be
    told apart: those of touched months are read again from bronze.
    """
    with bulk_settings(spark), _scratch(spark) as stored:
        return _refresh(spark, lake, arrival, orders, items, dimensions, as_of, stored)


def _refresh(
    spark: SparkSession,
    lake: str,
    arrival: str,
    orders: DataFrame,
    items: DataFrame,
    dimensions: Dimensions,
    as_of: AsOf,
    stored: Callable[[DataFrame, str], DataFrame],
) -> list[tuple[int, int]]:
    bronze = {"orders": orders, "order_items": items}
    silver = f"{lake}/silver"
    came, replaced = {}, {}
    for name, df in bronze.items():
        path = f"{lake}/bronze/{name}"
        folder = f"{path}/{ARRIVAL}={arrival}"
        # What the arrival held before may have changed as well.
        replaced[name] = stored(_existing(spark, folder, df), f"replaced-{name}")
        writers.write_parquet(df, folder)
        came[name] = spark.read.schema(df.schema).parquet(folder).unionByName(replaced[name])
    raw_orders = spark.read.schema(orders.schema).parquet(*_arrivals(spark, f"{lake}/bronze/orders"))
    raw_items = spark.read.schema(items.schema).parquet(*_arrivals(spark, f"{lake}/bronze/order_items"))

    ids = (
        came["orders"].select("order_id").union(came["order_items"].select("order_id"))
        .filter(F.col("order_id").isNotNull()).distinct()
    )
    ids = stored(ids, "changed-ids")
    changed = stored(_clean_orders(raw_orders.join(ids, "order_id", "left_semi")), "changed")
    unnumbered = _clean_orders(raw_orders.filter(F.col("order_id").isNull()))
    orders_path = f"{silver}/orders"
    before = _existing(spark, orders_path, changed)
    months = sorted(
        tuple(r)
        for r in before.join(ids, "order_id", "left_semi").select(*MONTH)
        .union(changed.select(*MONTH))
        .union(_clean_orders(came["orders"].filter(F.col("order_id").isNull())).select(*MONTH))
        .distinct().collect()
    )
    if not months:
        return []
    now = (
        before.filter(_within(months) & F.col("order_id").isNotNull()).join(ids, "order_id", "left_anti")
        .unionByName(changed)
        .unionByName(unnumbered.filter(_within(months)))
    )
    _replace_months([now], orders_path, months)
    rows = _existing(spark, orders_path, changed).filter(_within(months))
    heads = stored(model.order_facts(rows, dimensions.customers), "order-facts")
    parts = max(1, -(-Files(spark, lake).size(f"{lake}/bronze/order_items") // LINE_BYTES))
    _replace_months(_fact_parts(heads, raw_items, dimensions.products, parts), f"{silver}/fact_orders", months)
    _replace_months([metrics.customer_months(rows, dimensions.customers)], f"{silver}/customer_months", months)
    all_months = spark.read.parquet(f"{silver}/customer_months")
    rfm = metrics.customer_rfm(all_months, as_of)
    writers.write_gold(metrics.gold_dashboard(all_months, rfm, customer_sketch=True), f"{lake}/gold")
    return months


def _arrivals(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{name}" for name in Files(spark, path).names(path) if name.startswith(f"{ARRIVAL}=")]
