"""Registered queries: one per operator, over the supplied tables.

Each takes (spark, folder of Parquet tables) and returns a frame. All rows of a
table take part; only top-k reports are limited, because that is what they are.
"""

from __future__ import annotations

import datetime as dt
import inspect
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.functions import cleaners as C
from orderlake.functions.numeric import money
from orderlake.operators import (
    dedupe,
    distribution,
    enrich,
    filters,
    fraud,
    integrity,
    live,
    metrics,
    model,
    msglog,
    quality,
)
from orderlake.plans import frames, increments
from orderlake.plans.frames import AS_OF, report
from orderlake.session import new_scratch_dir, streaming_session
from orderlake.sources import readers, supplied, writers
from orderlake.streaming import kafka, marked, sinks, stack
from orderlake.streaming import transforms as T

Query = Callable[[SparkSession, str], DataFrame]


# ---- sources, sinks, layers ---------------------------------------------------
def src_csv(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "csv")
    supplied.raw_order_items(spark, d).write.option("header", True).csv(path)
    return readers.read_order_items(spark, path)


def src_json(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "json")
    supplied.raw_customers(spark, d).write.json(path)
    return report(enrich.canonical_customers(
        enrich.clean_customers(readers.read_customers(spark, path), AS_OF)
    ))


def _malformed(df: DataFrame, key: str, found: str) -> DataFrame:
    """(key, fate): rows that were read whole, and keys that a pattern finds in bad lines.

    Bronze is stored first: a text source must be parsed whole to tell its bad lines.
    """
    path = new_scratch_dir(df.sparkSession, "bronze")
    writers.write_parquet(df, path)
    whole, bad = quality.split_malformed(readers.read_parquet(df.sparkSession, path), readers.CORRUPT)
    named = F.regexp_extract("line", found, 1).cast("bigint").alias(key)
    return whole.select(key, F.lit("loaded").alias("fate")).unionByName(
        bad.select(named, F.lit("malformed").alias("fate"))
    )


def _item_file(spark: SparkSession, d: str) -> str:
    path = new_scratch_dir(spark, "csv")
    supplied.item_lines(spark, d).write.option("header", True).option("quote", "\0").csv(path)
    return path


def _customer_file(spark: SparkSession, d: str) -> str:
    path = new_scratch_dir(spark, "json")
    supplied.customer_lines(spark, d).write.text(path)
    return path


def src_csv_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a field too many or an unreadable number keep their text."""
    return _malformed(readers.read_order_items(spark, _item_file(spark, d), keep_corrupt=True), "item_id", "^([0-9]+),")


def src_json_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Cut-off lines and fields of a wrong type keep their text."""
    read = readers.read_customers(spark, _customer_file(spark, d), keep_corrupt=True)
    return _malformed(read, "customer_id", '"customer_id":([0-9]+)')


def dq_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the text sources against rows of bronze."""
    base = new_scratch_dir(spark, "bronze")
    items, customers = _item_file(spark, d), _customer_file(spark, d)
    raw = {
        "order_items": (readers.read_order_items(spark, items, keep_corrupt=True), items, True),
        "customers": (readers.read_customers(spark, customers, keep_corrupt=True), customers, False),
    }
    writers.write_bronze({name: df for name, (df, _, _) in raw.items()}, base)
    return quality.line_reconciliation(
        {
            name: (readers.line_counts(spark, path, header), spark.read.parquet(f"{base}/{name}"))
            for name, (_, path, header) in raw.items()
        },
        readers.CORRUPT,
    )


def src_parquet(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_products(spark, f"{d}/part.parquet")


def src_optional(spark: SparkSession, d: str) -> DataFrame:
    present = readers.read_or_empty(readers.read_parquet, spark, f"{d}/orders.parquet", "o_orderkey BIGINT")
    absent = readers.read_or_empty(readers.read_orders, spark, f"{d}/no_such_file", schemas.ORDERS)
    return present.agg(F.lit("present").alias("input"), F.count(F.lit(1)).alias("n")).union(
        absent.agg(F.lit("absent"), F.count(F.lit(1)))
    )


def src_stream_kafka(spark: SparkSession, d: str) -> DataFrame:
    """Decoding of Kafka records, on a static frame with the Kafka columns."""
    records = supplied.messages(spark, d).withColumn("value", F.col("value").cast("binary"))
    return readers.decode_kafka(
        records, "order_id BIGINT, customer_id BIGINT, total_amount DOUBLE, quantity INT"
    )


MESSAGE_FIELDS = "order_id BIGINT, customer_id BIGINT, total_amount DOUBLE, quantity INT"


def src_kafka_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Messages that could not be decoded, with their place in the log and their text."""
    decoded = readers.decode_kafka_kept(supplied.broken_messages(spark, d), MESSAGE_FIELDS)
    return report(readers.undecodable(decoded))


def src_kafka_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Ranges of offsets that the log lacks."""
    return msglog.offset_gaps(supplied.messages(spark, d))


def snk_bronze(spark: SparkSession, d: str) -> DataFrame:
    base = new_scratch_dir(spark, "bronze")
    raw = {
        "orders": supplied.raw_orders(spark, d),
        "customers": supplied.raw_customers(spark, d),
        "order_items": supplied.raw_order_items(spark, d),
        "products": supplied.raw_products(spark, d),
    }
    writers.write_bronze(raw, base)
    counts = [
        spark.read.parquet(f"{base}/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")
        )
        for name in raw
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def snk_silver(spark: SparkSession, d: str) -> DataFrame:
    base = new_scratch_dir(spark, "silver")
    writers.write_by_month(frames.valid_orders(spark, d), f"{base}/orders_enriched")
    return report(spark.read.parquet(f"{base}/orders_enriched"))


def snk_fact(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "fact")
    writers.write_fact_orders(frames.build_fact(spark, d), path)
    return report(spark.read.parquet(path))


def snk_metrics(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "metrics")
    writers.write_customer_metrics(
        metrics.customer_metrics(frames.valid_orders(spark, d), frames.customers(spark, d), AS_OF),
        path,
    )
    return report(spark.read.parquet(path))


def snk_gold(spark: SparkSession, d: str) -> DataFrame:
    base = new_scratch_dir(spark, "gold")
    writers.write_gold(frames.gold(spark, d), base)
    return report(spark.read.parquet(f"{base}/customer_segment_monthly"))


def snk_csv(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "export")
    writers.export_csv(frames.gold(spark, d), path, single_file=True)
    return readers.read_csv(
        spark,
        path,
        "order_year INT, order_month INT, customer_segment STRING, value_segment STRING, "
        "revenue DOUBLE, order_count BIGINT, customer_count BIGINT",
    )


def _staged_events(spark: SparkSession, events: DataFrame) -> str:
    """Order events as JSON files in a fresh folder, sliced by time."""
    path = new_scratch_dir(spark, "events")
    events.repartitionByRange("event_timestamp").write.json(path)
    return path


def _order_stream(spark: SparkSession, d: str) -> DataFrame:
    """A month of order events as a stream: a backfill, taken as one batch."""
    events = supplied.order_events(spark, d)
    path = _staged_events(spark, events)
    return stack.order_source(streaming_session(spark, events.count()), "file", path, files_per_trigger=None)


def _run_to_parquet(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream over what is available into Parquet and read the result."""
    out = new_scratch_dir(spark, "stream")
    sinks.to_parquet(stream, f"{out}/data", f"{out}/checkpoint", every=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def src_stream_file(spark: SparkSession, d: str) -> DataFrame:
    return _run_to_parquet(spark, _order_stream(spark, d))


def snk_stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    bronze = _run_to_parquet(spark, _order_stream(spark, d))
    return bronze.groupBy("status").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(money(F.col("total_amount"))).cast("double").alias("amount"),
    )


def _silver_layers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    out = new_scratch_dir(spark, "silver")
    stream = T.enrich_order_events(_order_stream(spark, d))
    marked.to_silver_table(stream, out, f"{out}/checkpoint", every=None).awaitTermination()
    return marked.silver_now(spark, out)


def snk_stream_silver(spark: SparkSession, d: str) -> DataFrame:
    valid, quarantined = _silver_layers(spark, d)
    layers = valid.withColumn("layer", F.lit("silver")).unionByName(
        quarantined.withColumn("layer", F.lit("invalid_dates"))
    )
    return layers.groupBy("layer", "order_year", "order_month").agg(
        F.count(F.lit(1)).alias("rows")
    )


def snk_stream_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Revenue windows kept current: closed ones and those still open, of one version."""
    out = new_scratch_dir(spark, "snapshot")
    orders = T.enrich_order_events(_order_stream(spark, d))
    marked.to_windows(orders, f"{out}/gold", f"{out}/checkpoint", "1 hour", every=None).awaitTermination()
    current = marked.windows_now(spark, f"{out}/gold").drop("is_closed")
    return report(_checked_customers(current, _sales(spark, d), 0.05, "1 hour"))


def layer_freshness(spark: SparkSession, d: str) -> DataFrame:
    base = new_scratch_dir(spark, "layers")
    writers.write_parquet(supplied.live_orders(spark, d), f"{base}/bronze")
    writers.write_by_month(frames.valid_orders(spark, d), f"{base}/silver")
    layers = live.layer_freshness(
        spark.read.parquet(f"{base}/bronze"), "bronze", "event_timestamp"
    ).unionByName(live.layer_freshness(spark.read.parquet(f"{base}/silver"), "silver"))
    # File counts and write times differ from run to run; whether there are any does not.
    return report(
        layers.select(
            "layer",
            "rows",
            (F.col("files") > 0).alias("has_files"),
            F.col("last_modified").isNotNull().alias("was_written"),
            "last_event",
        )
    )


# ---- column cleaners ------------------------------------------------------------
def cln_name(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_customers(spark, d).select(
        "customer_id", C.clean_name(F.col("name")).alias("name_cleaned")
    )


def cln_email(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_customers(spark, d).select(
        "customer_id", C.clean_email(F.col("email")).alias("email_cleaned")
    )


def cln_date(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_orders(spark, d).select(
        "order_id", C.clean_date(F.col("order_date")).alias("order_date_cleaned")
    )


def cln_status(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_orders(spark, d).select(
        "order_id", C.clean_status(F.col("status")).alias("status_cleaned")
    )


def cln_segment(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_customers(spark, d).select(
        "customer_id", C.clean_segment(F.col("segment")).alias("segment_cleaned")
    )


def cln_bool(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_customers(spark, d).select(
        "customer_id", C.clean_boolean(F.col("marketing_opt_in")).alias("opt_in_cleaned")
    )


def cln_num(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_orders(spark, d).select(
        "order_id",
        C.clean_number(F.col("total_amount"), *enrich.ORDER_AMOUNT).alias("total_amount_cleaned"),
    )


def cln_phone(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_customers(spark, d).select(
        "customer_id", C.clean_phone(F.col("phone")).alias("phone_cleaned")
    )


def cln_prodname(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_products(spark, d).select(
        "product_id", C.clean_product_name(F.col("product_name")).alias("product_name_cleaned")
    )


def cln_category(spark: SparkSession, d: str) -> DataFrame:
    return frames.raw_products(spark, d).select(
        "product_id", C.clean_category(F.col("category")).alias("category_cleaned")
    )


# ---- table enrichment -------------------------------------------------------------
def enr_orders_raw(spark: SparkSession, d: str) -> DataFrame:
    enriched = enrich.enrich_orders(frames.raw_orders(spark, d))
    return enriched.select("order_id", "status", "order_year", "order_month", "is_completed")


def enr_orders(spark: SparkSession, d: str) -> DataFrame:
    return report(enrich.canonical_orders(enrich.clean_orders(frames.raw_orders(spark, d))))


def enr_customers(spark: SparkSession, d: str) -> DataFrame:
    return report(
        enrich.clean_customers(frames.raw_customers(spark, d), AS_OF).select(
            "customer_id",
            "name_cleaned",
            "email_cleaned",
            "join_date_cleaned",
            "segment_cleaned",
            "marketing_opt_in_cleaned",
            "phone_cleaned",
            "data_quality_score",
            "tenure_days",
            "age_valid",
        )
    )


def enr_items(spark: SparkSession, d: str) -> DataFrame:
    cleaned = enrich.clean_order_items(frames.raw_items(spark, d))
    return report(
        cleaned.select(
            "item_id",
            "product_id",
            "quantity_cleaned",
            "price_cleaned",
            "discount_percent_cleaned",
            "subtotal_calculated",
            "discount_amount_calculated",
            "line_total_calculated",
            "calculation_matches",
        )
    )


def enr_products(spark: SparkSession, d: str) -> DataFrame:
    cleaned = enrich.clean_products(frames.raw_products(spark, d))
    return report(
        cleaned.select(
            "product_id",
            "unit_price_cleaned",
            "cost_cleaned",
            "weight_kg_cleaned",
            "is_active_cleaned",
            "created_date_cleaned",
            "product_name_cleaned",
            "category_cleaned",
            "margin_percent",
            "price_cost_valid",
        )
    )


# ---- filters ---------------------------------------------------------------------
def flt_valid_ratio(spark: SparkSession, d: str) -> DataFrame:
    return report(quality.valid_ratio(frames.orders(spark, d)))


def flt_bad_date(spark: SparkSession, d: str) -> DataFrame:
    # As of a day within the data, so that later orders count as future ones.
    bad = filters.bad_dates(
        frames.raw_orders(spark, d), as_of=F.lit("2001-07-01").cast("date")
    )
    return bad.select("order_id", "order_date", "status")


def flt_bad_email(spark: SparkSession, d: str) -> DataFrame:
    return filters.bad_emails(frames.raw_customers(spark, d)).select("customer_id", "email")


def flt_neg_amount(spark: SparkSession, d: str) -> DataFrame:
    return filters.negative_amounts(frames.raw_orders(spark, d)).select(
        "order_id", "customer_id", "total_amount"
    )


def flt_dash(spark: SparkSession, d: str) -> DataFrame:
    return report(
        filters.dashboard_slice(
            frames.gold(spark, d), [1999, 2000, 2001], ["Premium", "Regular"], ["low_value"]
        )
    )


def flt_recent(spark: SparkSession, d: str) -> DataFrame:
    return report(
        filters.recent_orders(supplied.live_orders(spark, d), 100, "completed", 500.0)
    )


def flt_high_value(spark: SparkSession, d: str) -> DataFrame:
    return report(filters.high_value_customers(frames.rfm(spark, d)))


def flt_review(spark: SparkSession, d: str) -> DataFrame:
    review = filters.alerts_to_review(_alerts(spark, d))
    return report(review.withColumn("reasons", F.concat_ws("; ", "reasons")))


# ---- joins -----------------------------------------------------------------------
def join_fact_raw(spark: SparkSession, d: str) -> DataFrame:
    heads = frames.stored(
        spark,
        d,
        "raw-order_heads",
        lambda: model.raw_order_heads(
            enrich.enrich_orders(frames.raw_orders(spark, d)), frames.raw_customers(spark, d)
        ),
    )
    return model.raw_line_facts(heads, frames.raw_items(spark, d), frames.raw_products(spark, d))


def join_fact(spark: SparkSession, d: str) -> DataFrame:
    return report(frames.build_fact(spark, d))


def join_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.customer_metrics(
        frames.valid_orders(spark, d), frames.customers(spark, d), AS_OF
    ).select("customer_id", "total_orders", "join_date", "segment")


def join_rfm(spark: SparkSession, d: str) -> DataFrame:
    return report(
        model.with_value_segment(
            metrics.completed(frames.order_facts(spark, d)), frames.rfm(spark, d)
        ).select("order_id", "customer_id", "total_amount", "value_segment")
    )


def join_fraud_items(spark: SparkSession, d: str) -> DataFrame:
    return model.with_item_totals(
        frames.valid_orders(spark, d).select("order_id", "customer_id"), frames.items(spark, d)
    )


def anti_refint(spark: SparkSession, d: str) -> DataFrame:
    return integrity.referential_issues(
        frames.raw_orders(spark, d),
        frames.raw_customers(spark, d),
        frames.raw_items(spark, d),
        frames.raw_products(spark, d),
    )


def anti_refint_rows(spark: SparkSession, d: str) -> DataFrame:
    lost = integrity.orphans(frames.raw_items(spark, d), frames.raw_orders(spark, d), "order_id")
    return lost.select("item_id", "order_id", "line_total")


# ---- aggregates --------------------------------------------------------------------
def agg_overall(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.overall_revenue(frames.valid_orders(spark, d)))


def agg_cust_metrics(spark: SparkSession, d: str) -> DataFrame:
    return report(
        metrics.customer_metrics(frames.valid_orders(spark, d), frames.customers(spark, d), AS_OF)
    )


def agg_monthly(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.monthly_revenue(frames.valid_orders(spark, d)))


def agg_segment(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.segment_analysis(frames.customer_months(spark, d)))


def agg_segment_order(spark: SparkSession, d: str) -> DataFrame:
    # Every order fact is in the item-grain table once or more: its distinct order parts are
    # those of the order facts, without the lines.
    return report(metrics.segment_analysis(frames.order_facts(spark, d), grain="order"))


def agg_segment_line(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.segment_analysis(frames.fact(spark, d), grain="line"))


def agg_status(spark: SparkSession, d: str) -> DataFrame:
    return metrics.status_distribution(frames.orders(spark, d))


def agg_category(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.category_performance(frames.fact(spark, d)))


def agg_category_order_total(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.category_performance(frames.fact(spark, d), measure="order_total"))


def agg_rfm(spark: SparkSession, d: str) -> DataFrame:
    return report(frames.rfm(spark, d))


def agg_gold(spark: SparkSession, d: str) -> DataFrame:
    return report(frames.gold(spark, d))


def _refreshed(spark: SparkSession, d: str) -> str:
    """A lake that took the older orders and their lines first, then the newer ones."""
    lake = new_scratch_dir(spark, "lake")
    # Read twice and stored once, as the lake's bronze.
    orders, items = frames.incoming_orders(spark, d), frames.incoming_items(spark, d)
    known = increments.Dimensions(frames.customers(spark, d), frames.products(spark, d))
    older = F.col("last_updated") < "1998-01-01"
    # Some lines come with the newer orders, and some of those belong to older ones.
    early = F.col("item_id") % 10 < 4
    for name, came, lines in (("first", older, early), ("second", ~older, ~early)):
        increments.refresh(spark, lake, name, orders.filter(came), items.filter(lines), known, AS_OF)
    return lake


def agg_gold_refresh(spark: SparkSession, d: str) -> DataFrame:
    gold = spark.read.parquet(f"{_refreshed(spark, d)}/gold/customer_segment_monthly")
    return report(gold.drop("customer_sketch"))


def snk_fact_refresh(spark: SparkSession, d: str) -> DataFrame:
    return report(spark.read.parquet(f"{_refreshed(spark, d)}/silver/fact_orders"))


def agg_gold_line(spark: SparkSession, d: str) -> DataFrame:
    months = frames.line_months(spark, d)
    rfm = metrics.customer_rfm(months, AS_OF, grain="line")
    return report(metrics.gold_dashboard(months, rfm, grain="line", distinct_customers=False))


def agg_item_preagg(spark: SparkSession, d: str) -> DataFrame:
    return model.item_totals(frames.items(spark, d))


def agg_dash_kpi(spark: SparkSession, d: str) -> DataFrame:
    chosen = filters.dashboard_slice(
        frames.sales(spark, d), [1999, 2000, 2001], ["Premium", "Regular", "Bronze"]
    )
    return report(metrics.dashboard_kpis(chosen))


def agg_dash_kpi_sketch(spark: SparkSession, d: str) -> DataFrame:
    gold = metrics.gold_dashboard(
        frames.customer_months(spark, d), frames.rfm(spark, d), customer_sketch=True
    )
    years, segments = [1999, 2000, 2001], ["Premium", "Regular", "Bronze"]
    estimated = metrics.dashboard_kpis_from_gold(filters.dashboard_slice(gold, years, segments))
    exact = metrics.dashboard_kpis(filters.dashboard_slice(frames.sales(spark, d), years, segments))
    customers = exact.select("unique_customers").scalar()
    off = F.abs(F.col("unique_customers") - customers)
    return report(
        estimated.withColumn("customers_within_5_percent", off <= customers * 0.05 + 1).drop(
            "unique_customers"
        )
    )


def agg_dash_trend(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.dashboard_trend(frames.gold(spark, d)))


def agg_dash_seg(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.dashboard_segments(frames.gold(spark, d)))


def agg_dash_value(spark: SparkSession, d: str) -> DataFrame:
    return report(metrics.dashboard_value_segments(frames.sales(spark, d)))


def agg_live(spark: SparkSession, d: str) -> DataFrame:
    return report(live.live_kpis(supplied.live_orders(spark, d), as_of=frames.live_as_of()))


def agg_5min(spark: SparkSession, d: str) -> DataFrame:
    return report(live.order_buckets(supplied.live_orders(spark, d), as_of=frames.live_as_of()))


def agg_hist(spark: SparkSession, d: str) -> DataFrame:
    return report(distribution.histogram(frames.valid_orders(spark, d), "total_amount", 30))


def agg_hist_score(spark: SparkSession, d: str) -> DataFrame:
    scored = frames.potential_fraud(spark, d)
    return report(distribution.histogram(scored, "fraud_score", 10))


def agg_box(spark: SparkSession, d: str) -> DataFrame:
    return report(
        distribution.box_plot(frames.valid_orders(spark, d), "total_amount", "status", exact=True)
    )


def agg_box_approx(spark: SparkSession, d: str) -> DataFrame:
    """Per quartile: is the estimate's rank within the sketch's error of 1/1000?"""
    orders, quartiles = frames.valid_orders(spark, d), [0.25, 0.5, 0.75]
    box = distribution.box_plot(orders, "total_amount", "status").withColumn(
        "quantiles", F.array("q1", "median", "q3")
    )
    ranks = distribution.quantile_ranks(orders, "total_amount", box, quartiles, ["status"])
    extremes = box.select("status", "minimum", "maximum")
    return report(
        ranks.select(
            "status", "probability", "n", distribution.within_error(0.001).alias("within_error")
        ).join(extremes, "status")
    )


def agg_fraud_kpi(spark: SparkSession, d: str) -> DataFrame:
    scored = frames.potential_fraud(spark, d)
    return report(fraud.fraud_kpis(scored, "total_amount_cleaned"))


def agg_fraud_kpi_live(spark: SparkSession, d: str) -> DataFrame:
    return report(fraud.fraud_kpis(_live_fraud(spark, d)))


def agg_cust_events(spark: SparkSession, d: str) -> DataFrame:
    return live.customer_event_kpis(supplied.customer_event_rows(spark, d))


def agg_cust_events_segment(spark: SparkSession, d: str) -> DataFrame:
    return live.customer_events_by_segment(supplied.customer_events(spark, d))


def agg_item_events(spark: SparkSession, d: str) -> DataFrame:
    return report(live.item_event_kpis(supplied.item_event_rows(spark, d)))


def agg_item_events_category(spark: SparkSession, d: str) -> DataFrame:
    events, categories = supplied.item_event_rows(spark, d), supplied.product_categories(spark, d)
    return report(live.item_events_by_category(events, categories))


def _alerts(spark: SparkSession, d: str) -> DataFrame:
    return fraud.fraud_alerts(supplied.live_orders(spark, d))


def agg_alert_kpi(spark: SparkSession, d: str) -> DataFrame:
    return report(fraud.alert_kpis(_alerts(spark, d)))


def agg_alert_risk(spark: SparkSession, d: str) -> DataFrame:
    return fraud.alerts_by_risk(_alerts(spark, d))


def agg_reasons(spark: SparkSession, d: str) -> DataFrame:
    return fraud.reason_frequency(_alerts(spark, d))


# ---- windows, top-k, set operations -------------------------------------------------
def win_lag_month(spark: SparkSession, d: str) -> DataFrame:
    drops = metrics.revenue_drops(metrics.monthly_revenue(frames.valid_orders(spark, d)), 0.05)
    return report(drops.withColumn("revenue_drop_pct", F.round("revenue_drop_pct", 4)))


def win_lag_order(spark: SparkSession, d: str) -> DataFrame:
    return fraud.days_since_last_order(
        frames.valid_orders(spark, d).select("order_id", "customer_id", "order_date")
    )


def win_dedup_flag(spark: SparkSession, d: str) -> DataFrame:
    items = frames.raw_items(spark, d).select(
        "item_id", "product_id", "quantity", "price", "discount_percent", "line_total"
    )
    return dedupe.flag_duplicates(items, ["item_id"])


def win_dedup_drop(spark: SparkSession, d: str) -> DataFrame:
    items = frames.raw_items(spark, d).select(
        "item_id", "product_id", "quantity", "price", "discount_percent", "line_total"
    )
    return dedupe.drop_duplicates_by_key(items, ["item_id"])


def win_orders_1h(spark: SparkSession, d: str) -> DataFrame:
    orders = supplied.live_orders(spark, d).withColumnRenamed("event_timestamp", "order_timestamp")
    return report(
        fraud.orders_in_window(orders.select("order_id", "customer_id", "order_timestamp"))
    )


def topk_customers(spark: SparkSession, d: str) -> DataFrame:
    per_customer = metrics.customer_metrics(
        frames.valid_orders(spark, d), frames.customers(spark, d), AS_OF
    )
    return report(metrics.top_customers(per_customer, 5))


def topk_fraud(spark: SparkSession, d: str) -> DataFrame:
    scored = frames.potential_fraud(spark, d)
    return report(fraud.top_scores(scored, 10))


def topk_latest(spark: SparkSession, d: str) -> DataFrame:
    return report(filters.latest(supplied.live_orders(spark, d), 1000, "event_timestamp"))


def sort_report(spark: SparkSession, d: str) -> DataFrame:
    return metrics.status_distribution(frames.valid_orders(spark, d))


def set_union(spark: SparkSession, d: str) -> DataFrame:
    valid, quarantined = _silver_layers(spark, d)
    # The time of processing differs from run to run.
    return report(
        live.union_layers(
            valid.drop("processing_timestamp"),
            quarantined.drop("processing_timestamp", "order_date_parsed"),
        )
    )


# ---- data quality ----------------------------------------------------------------
def dq_nulls(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_counts(frames.raw_orders(spark, d))


def dq_dupkeys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(frames.raw_items(spark, d), "item_id")


def dq_range(spark: SparkSession, d: str) -> DataFrame:
    return quality.date_range(frames.orders(spark, d), "order_date")


def dq_score(spark: SparkSession, d: str) -> DataFrame:
    return quality.completeness_score(
        frames.raw_customers(spark, d), ["customer_id", "email", "join_date", "age"]
    ).select("customer_id", "data_quality_score")


def _skewed_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Line totals: a long right tail, with a bounded number of different cents."""
    return frames.raw_items(spark, d).select(
        "item_id", "product_id", money(F.col("line_total")).alias("line_total")
    )


def dq_iqr(spark: SparkSession, d: str) -> DataFrame:
    return report(distribution.flag_outliers(_skewed_amounts(spark, d), "line_total", 1.0, exact=True))


def dq_iqr_approx(spark: SparkSession, d: str) -> DataFrame:
    """Per quartile of the fences: is the estimate's rank within the error of 1/100?"""
    amounts, quartiles = _skewed_amounts(spark, d), [0.25, 0.75]
    estimates = distribution.approx_quantiles(amounts, "line_total", quartiles)
    ranks = distribution.quantile_ranks(amounts, "line_total", estimates, quartiles)
    return report(
        ranks.select("probability", "n", distribution.within_error(0.01).alias("within_error"))
    )


def dq_report(spark: SparkSession, d: str) -> DataFrame:
    return report(quality.table_report(frames.raw_items(spark, d), "order_items", "item_id"))


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_summary(
        {
            "orders": (frames.raw_orders(spark, d), "order_id"),
            "customers": (frames.raw_customers(spark, d), "customer_id"),
            "order_items": (frames.raw_items(spark, d), "item_id"),
            "products": (frames.raw_products(spark, d), "product_id"),
        }
    )


def dq_summary(spark: SparkSession, d: str) -> DataFrame:
    return report(_summary(spark, d))


def dq_dash(spark: SparkSession, d: str) -> DataFrame:
    invalid = quality.invalid_counts(
        {
            "orders": (frames.orders(spark, d), F.col("is_valid_order") == 0),
            "customers": (frames.customers(spark, d), F.col("data_quality_score") < 100),
            "order_items": (frames.items(spark, d), ~F.col("line_calc_valid")),
            "products": (
                frames.clean_products(spark, d),
                ~F.coalesce("price_cost_valid", F.lit(False)),
            ),
        }
    )
    return report(quality.quality_totals(_summary(spark, d), invalid))


def dq_impact(spark: SparkSession, d: str) -> DataFrame:
    return report(
        quality.cleaning_impact(
            frames.clean_orders(spark, d),
            frames.clean_customers(spark, d),
            frames.clean_items(spark, d),
        )
    )


def dq_quarantine(spark: SparkSession, d: str) -> DataFrame:
    cleaned = frames.clean_orders(spark, d)
    valid, quarantined = quality.split_valid(cleaned, quality.order_rules())
    return valid.select("order_id", F.lit("").alias("reasons")).unionByName(
        quarantined.select("order_id", F.concat_ws(",", "quarantine_reasons").alias("reasons"))
    )


# ---- fraud -----------------------------------------------------------------------
def frd_batch(spark: SparkSession, d: str) -> DataFrame:
    return report(fraud.potential_fraud(frames.orders(spark, d), frames.items(spark, d)))


def frd_stream(spark: SparkSession, d: str) -> DataFrame:
    """The streaming rule on a static frame; the same rows as a stream gives."""
    enriched = T.enrich_order_events(supplied.order_events(spark, d))
    return report(T.fraud_stream(enriched))


def frd_velocity(spark: SparkSession, d: str) -> DataFrame:
    """Suspicious rows with the customer's orders in the hour before."""
    enriched = T.enrich_order_events(supplied.order_events(spark, d))
    counted = fraud.orders_in_window(enriched.filter(F.col("is_valid_order") == 1))
    return report(
        fraud.suspicious_rows(counted).select(
            "order_id",
            "customer_id",
            "order_timestamp",
            "total_amount",
            "fraud_score",
            "orders_in_last_hour",
            "status",
        )
    )


def _live_fraud(spark: SparkSession, d: str) -> DataFrame:
    return fraud.suspicious_rows(supplied.live_orders(spark, d), only_valid=False)


def frd_live(spark: SparkSession, d: str) -> DataFrame:
    return report(_live_fraud(spark, d))


def frd_alert(spark: SparkSession, d: str) -> DataFrame:
    alerts = _alerts(spark, d).withColumn("reasons", F.concat_ws("; ", "reasons"))
    return report(alerts)


# ---- streaming -------------------------------------------------------------------
def str_enrich(spark: SparkSession, d: str) -> DataFrame:
    enriched = T.enrich_order_events(_order_stream(spark, d)).drop("processing_timestamp")
    return report(_run_to_parquet(spark, enriched))


def str_window(spark: SparkSession, d: str) -> DataFrame:
    """Closed one-minute windows."""
    windows = T.revenue_by_window(T.enrich_order_events(_order_stream(spark, d)))
    return report(_checked_customers(_run_to_parquet(spark, windows), _sales(spark, d), 0.15, "1 minute"))


def str_window_sliding(spark: SparkSession, d: str) -> DataFrame:
    windows = T.revenue_by_window(
        T.enrich_order_events(_order_stream(spark, d)), "1 hour", "15 minutes"
    )
    closed = _run_to_parquet(spark, windows)
    return report(_checked_customers(closed, _sales(spark, d), 0.15, "1 hour", "15 minutes"))


def str_late(spark: SparkSession, d: str) -> DataFrame:
    """The second half of the month arrives first; the first half is then too late."""
    events = supplied.order_events(spark, d)
    at = F.try_to_timestamp("event_timestamp")
    half = F.lit("2024-01-16").cast("timestamp")
    path = _staged_events(spark, events.filter(at >= half))
    out = new_scratch_dir(spark, "late")
    stream = stack.order_source(streaming_session(spark), "file", path, files_per_trigger=None)
    windows = T.revenue_by_window(T.enrich_order_events(stream), "1 hour")
    for arrivals in (None, events.filter(at < half)):
        if arrivals is not None:
            arrivals.write.mode("append").json(path)
        sinks.to_parquet(
            windows, f"{out}/data", f"{out}/checkpoint", every=None
        ).awaitTermination()
    closed = spark.read.schema(windows.schema).parquet(f"{out}/data")
    in_time = _sales(spark, d).filter(F.col("order_timestamp") >= half)
    return report(_checked_customers(closed, in_time, 0.15, "1 hour"))


def str_velocity(spark: SparkSession, d: str) -> DataFrame:
    velocity = T.customer_velocity(T.enrich_order_events(_order_stream(spark, d)))
    return report(_run_to_parquet(spark, velocity))


def _arrivals(events: DataFrame, part: Column) -> Iterator[DataFrame]:
    """The events in the parts that arrive one after the other."""
    parts = events.withColumn("_part", part)
    for n in range(6):
        yield parts.filter(F.col("_part") == n).drop("_part")


def _run_arrivals(spark: SparkSession, arrivals: Iterable[DataFrame], start) -> None:
    """Write each arrival into one folder and run the query over what is new, as one batch."""
    path = new_scratch_dir(spark, "arrivals")
    session = streaming_session(spark)
    for arrival in arrivals:
        arrival.write.mode("append").json(path)
        stream = stack.order_source(session, "file", path)
        start(T.enrich_order_events(stream)).awaitTermination()


def _day_block(days: int) -> Column:
    """The block of days of an event's time, and one more for each fifth order."""
    day = F.coalesce(F.day(F.try_to_timestamp("event_timestamp")), F.lit(1))
    return F.floor((day - 1) / days).cast("int") + (F.col("order_id") % 5 == 0).cast("int")


def _late_windows(spark: SparkSession, d: str) -> str:
    """Hourly revenue of a month whose blocks of eight days come in the order 2, 1, 4, 3."""
    out = new_scratch_dir(spark, "late")
    arrivals = _arrivals(supplied.order_events(spark, d), _day_block(8).bitwiseXOR(F.lit(1)))
    _run_arrivals(
        spark, arrivals,
        lambda orders: marked.to_windows(orders, f"{out}/gold", f"{out}/checkpoint", "1 hour", every=None),
    )
    return f"{out}/gold"


def _sales(spark: SparkSession, d: str) -> DataFrame:
    return T.enrich_order_events(supplied.order_events(spark, d)).filter(
        (F.col("is_valid_order") == 1) & (F.col("status") == "completed")
    )


def _checked_customers(
    windows: DataFrame, sales: DataFrame, bound: float, duration: str, slide: str | None = None
) -> DataFrame:
    """Whether each window's estimate of its customers is within the bound of their number."""
    exact = sales.groupBy(F.window("order_timestamp", duration, slide or duration).alias("w")).agg(
        F.count_distinct("customer_id").alias("_exact")
    )
    off = F.abs(F.col("unique_customers") - F.col("_exact"))
    return (
        windows.join(exact.select(F.col("w.start").alias("window_start"), "_exact"), "window_start")
        .withColumn("customers_within_bound", off <= F.col("_exact") * bound + 1)
        .drop("unique_customers", "_exact")
    )


def str_window_late(spark: SparkSession, d: str) -> DataFrame:
    """Hourly windows, closed and open, of orders that came in time."""
    base = _late_windows(spark, d)
    late = marked.revenue_tables(spark, base).table("revenue_late").select("order_id")
    in_time = _sales(spark, d).join(late, "order_id", "left_anti")
    return report(_checked_customers(marked.windows_now(spark, base), in_time, 0.05, "1 hour"))


def str_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders that came after their window had closed, and those without a time."""
    late = marked.revenue_tables(spark, _late_windows(spark, d)).table("revenue_late")
    return report(
        late.select("order_id", "customer_id", "order_timestamp", "window_end", "total_amount", "late_reason")
    )


def str_reconciled(spark: SparkSession, d: str) -> DataFrame:
    """A backlog of one file a trigger: whatever is late for it, windows and late rows are all."""
    out = new_scratch_dir(spark, "shuffled")
    path = new_scratch_dir(spark, "events")
    supplied.order_events(spark, d).repartition(6, "order_id").write.json(path)
    stream = stack.order_source(streaming_session(spark), "file", path, files_per_trigger=1)
    marked.to_windows(
        T.enrich_order_events(stream), f"{out}/gold", f"{out}/checkpoint", "1 hour", every=None
    ).awaitTermination()
    late = marked.revenue_tables(spark, f"{out}/gold").table("revenue_late").select(
        (F.col("window_end") - F.expr("INTERVAL 1 HOUR")).alias("window_start"),
        F.lit(1).cast("bigint").alias("order_count"),
        money(F.col("total_amount")).alias("total_revenue"),
    )
    windows = marked.window_parts_now(spark, f"{out}/gold").select("window_start", "order_count", "total_revenue")
    return report(
        windows.unionByName(late).groupBy("window_start").agg(
            F.sum("order_count").alias("orders"), F.sum("total_revenue").alias("revenue")
        )
    )


def str_window_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Minutes rolled up to hours, distinct customers merged from sketches."""
    out = new_scratch_dir(spark, "minutes")
    orders = T.enrich_order_events(_order_stream(spark, d))
    marked.to_windows(orders, f"{out}/gold", f"{out}/checkpoint", every=None).awaitTermination()
    hours = marked.window_figures(marked.rolled_up(marked.window_parts_now(spark, f"{out}/gold"), "1 hour"))
    return report(_checked_customers(hours, _sales(spark, d), 0.05, "1 hour"))


def str_velocity_orders(spark: SparkSession, d: str) -> DataFrame:
    """Each valid order with the customer's orders in the hour up to it; what waits; what is late."""
    out = new_scratch_dir(spark, "velocity")
    _run_arrivals(
        spark, _arrivals(supplied.order_events(spark, d), _day_block(7)),
        lambda orders: marked.to_order_velocity(orders, f"{out}/gold", f"{out}/checkpoint", every=None),
    )
    told, waiting, late = marked.velocity_now(spark, f"{out}/gold")
    unknown = F.lit(None).cast("bigint").alias("orders_in_last_hour")
    return report(
        told.withColumn("fate", F.lit("told"))
        .unionByName(waiting.select("*", unknown, F.lit("waits").alias("fate")))
        .unionByName(late.select(*marked.VELOCITY, unknown, F.col("late_reason").alias("fate")))
    )


def str_fraud_velocity(spark: SparkSession, d: str) -> DataFrame:
    """Suspicious orders of a stream with the customer's orders in the hour before."""
    out = new_scratch_dir(spark, "velocity")
    orders = T.enrich_order_events(_order_stream(spark, d))
    marked.to_order_velocity(orders, f"{out}/gold", f"{out}/checkpoint", every=None).awaitTermination()
    told, _, _ = marked.velocity_now(spark, f"{out}/gold")
    return report(fraud.suspicious_rows(told, only_valid=False))


def str_kafka_log(spark: SparkSession, d: str) -> DataFrame:
    """A log read in batches of offsets: messages decoded and not, and offsets that never came."""
    out, path = new_scratch_dir(spark, "log"), new_scratch_dir(spark, "messages")
    log = supplied.broken_messages(spark, d).withColumn("value", F.col("value").cast("binary"))
    session = streaming_session(spark)
    step = log.agg(F.ceil((F.max("offset") + 1) / 3)).scalar()
    for n in range(3):
        log.filter(F.floor(F.col("offset") / step) == n).write.mode("append").parquet(path)
        stream = session.readStream.schema(log.schema).parquet(path)
        kafka.to_log_tables(
            stream, f"{out}/log", f"{out}/checkpoint", MESSAGE_FIELDS, every=None
        ).awaitTermination()
    tables = kafka.log_tables(spark, f"{out}/log")
    now = tables.newest()
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    place = lambda c: F.col(f"_kafka_{c}").alias(c)
    rows = (
        tables.table("events", now).select(
            place("topic"), place("partition"), one.alias("events"), zero.alias("undecodable"),
            zero.alias("gaps"), zero.alias("missing"))
        .union(tables.table("undecodable", now).select("topic", "partition", zero, one, zero, zero))
        .union(tables.table("gaps", now).select("topic", "partition", zero, zero, one, "missing"))
    )
    return rows.groupBy("topic", "partition").agg(
        *[F.sum(c).alias(c) for c in ("events", "undecodable", "gaps", "missing")]
    )


def str_layers(spark: SparkSession, d: str) -> DataFrame:
    """All queries of the streaming job run to the end; rows per layer."""
    lake = new_scratch_dir(spark, "lake")
    queries = stack.start_order_stack(
        _order_stream(spark, d), f"{lake}/tables", f"{lake}/checkpoints", run_once=True
    )
    stack.await_all(queries)
    read = lambda folder: spark.read.schema("order_id BIGINT").parquet(f"{lake}/tables/{folder}")
    gold = f"{lake}/tables/gold"
    dated, undated = marked.silver_now(spark, f"{lake}/tables/silver")
    windows = marked.window_parts_now(spark, gold)
    told, waiting, untold = marked.velocity_now(spark, gold)
    layers = {
        "bronze": read("bronze/orders_streaming"),
        "silver": dated,
        "invalid_dates": undated,
        "fraud_alerts": read("gold/fraud_alerts"),
        "customer_velocity": spark.read.schema("customer_id BIGINT").parquet(f"{gold}/customer_velocity"),
        "revenue_closed": windows.filter("is_closed"),
        "revenue_open": windows.filter("not is_closed"),
        "revenue_late": marked.revenue_tables(spark, gold).table("revenue_late"),
        "velocity_told": told,
        "velocity_waiting": waiting,
        "velocity_late": untold,
    }
    return reduce(
        DataFrame.unionByName,
        [rows.agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("rows")) for layer, rows in layers.items()],
    )


# ---- message log -----------------------------------------------------------------
def _partition_stats(spark: SparkSession, d: str) -> DataFrame:
    return msglog.partition_stats(supplied.messages(spark, d), supplied.topics(spark, d))


def log_topic_stats(spark: SparkSession, d: str) -> DataFrame:
    return _partition_stats(spark, d)


def log_topic_totals(spark: SparkSession, d: str) -> DataFrame:
    return msglog.topic_stats(_partition_stats(spark, d))


def log_rate(spark: SparkSession, d: str) -> DataFrame:
    snapshots = msglog.message_snapshots(supplied.messages(spark, d))
    return report(msglog.message_rates(snapshots))


def log_lag(spark: SparkSession, d: str) -> DataFrame:
    return msglog.consumer_lag(_partition_stats(spark, d), supplied.committed_offsets(spark, d))


def log_read_from(spark: SparkSession, d: str) -> DataFrame:
    return report(msglog.read_from(supplied.messages(spark, d), from_offset=500, limit=100))


def log_latest(spark: SparkSession, d: str) -> DataFrame:
    return report(msglog.latest_messages(supplied.messages(spark, d), 5))


def log_flatten(spark: SparkSession, d: str) -> DataFrame:
    flat = msglog.flatten_messages(
        supplied.messages(spark, d),
        "order_id BIGINT, customer_id BIGINT, total_amount DOUBLE, quantity INT",
    )
    return report(flat)


def log_retain(spark: SparkSession, d: str) -> DataFrame:
    kept = msglog.retained(supplied.messages(spark, d), supplied.topics(spark, d), frames.live_as_of())
    path = new_scratch_dir(spark, "log")
    writers.rewrite_retained(kept, path)
    return report(spark.read.schema(kept.schema).parquet(path))


def log_retain_days(spark: SparkSession, d: str) -> DataFrame:
    """Retention in place: whole days dropped, the cutoff's day written again."""
    path, scratch = new_scratch_dir(spark, "log"), new_scratch_dir(spark, "border")
    writers.write_log(supplied.messages(spark, d), path)
    writers.retain_log(spark, path, schemas.MESSAGES, supplied.topics(spark, d), dt.datetime(2024, 1, 30, 23), scratch)
    return report(writers.read_log(spark, path, schemas.MESSAGES))


def log_read_from_far(spark: SparkSession, d: str) -> DataFrame:
    """A limit above what Spark ranks on the map side."""
    return report(msglog.read_from(supplied.messages(spark, d), from_offset=500, limit=1001))


def log_latest_far(spark: SparkSession, d: str) -> DataFrame:
    return report(msglog.latest_messages(supplied.messages(spark, d), 1001))


def registered() -> dict[str, Query]:
    """Public functions of this module, in order of definition."""
    module = sys.modules[__name__]
    return {
        name: fn
        for name, fn in vars(module).items()
        if inspect.isfunction(fn)
        and fn.__module__ == __name__
        and not name.startswith("_")
        and name != "registered"
    }
