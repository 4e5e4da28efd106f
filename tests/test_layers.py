import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import live, msglog, quality
from orderlake.plans import medallion
from orderlake.session import scratch_root, streaming_session
from orderlake.sources import readers, supplied, writers


@pytest.fixture(scope="module")
def raw_paths(spark, sf, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("raw"))
    orders = supplied.raw_orders(spark, sf)
    orders = orders.unionByName(orders.filter("order_id IS NOT NULL").limit(20))
    orders.write.option("header", True).csv(f"{base}/orders")
    supplied.raw_customers(spark, sf).write.json(f"{base}/customers")
    supplied.raw_order_items(spark, sf).write.option("header", True).csv(f"{base}/items")
    supplied.raw_products(spark, sf).write.parquet(f"{base}/products")
    return medallion.RawPaths(
        f"{base}/orders", f"{base}/customers", f"{base}/items", f"{base}/products"
    )


def test_batch_job(spark, sf, raw_paths, tmp_path):
    raw = medallion.read_raw(spark, raw_paths)
    lake, exports = str(tmp_path / "lake"), str(tmp_path / "exports")
    reports = medallion.run_batch(spark, raw, lake, exports, dt.date(2001, 9, 1))
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert spark.read.parquet(f"{lake}/bronze/orders").count() == n + 20
    assert reports["duplicate_orders"].filter("order_id IS NOT NULL").count() == 20
    ratio = reports["valid_ratio"].collect()[0]
    assert ratio.total_rows == n
    # Enriched orders and quarantined ones: nothing is lost.
    valid = spark.read.parquet(f"{lake}/silver/orders_enriched").count()
    bad = spark.read.parquet(f"{lake}/silver/quarantine/orders")
    assert valid == ratio.valid_rows
    assert bad.filter(~F.array_contains("quarantine_reasons", "unknown_status")).count() <= n - valid
    exported = spark.read.option("header", True).csv(f"{exports}/gold_customer_segment_monthly_csv")
    assert exported.count() == reports["gold"].count() > 0
    assert reports["potential_fraud"].count() > 0
    for report in reports.values():
        report.collect()
    literal = medallion.run_batch(
        spark, raw, str(tmp_path / "lake2"), None, dt.date(2001, 9, 1), dedupe_orders=False
    )
    assert literal["valid_ratio"].collect()[0].total_rows == n + 20


def test_missing_input(spark, tmp_path):
    missing = str(tmp_path / "nothing")
    paths = medallion.RawPaths(missing, missing, missing, missing)
    with pytest.raises(AnalysisException):
        medallion.read_raw(spark, paths)
    empty = medallion.read_raw(spark, paths, allow_missing=True)
    assert empty["orders"].count() == 0 and "customer_id" in empty["orders"].columns


def test_malformed_csv_is_kept_aside(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text(
        "order_id,customer_id,order_date,status,total_amount,source_system,last_updated\n"
        "1,2,2024-01-01,ok,3.5,web,x\nfive,2,2024-01-01,ok,3.5,web,x\n"
    )
    rows = readers.read_csv(spark, str(path), schemas.ORDERS, keep_corrupt=True).collect()
    assert [r[readers.CORRUPT] is None for r in rows] == [True, False]
    assert [r.order_id for r in readers.read_orders(spark, str(path)).collect()] == [1, None]


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "order_id int, order_year int, order_month int"
    writers.write_by_month(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], schema), path)
    writers.write_by_month(spark.createDataFrame([(3, 2024, 2)], schema), path)
    assert sorted(r.order_id for r in spark.read.parquet(path).collect()) == [1, 3]


def test_a_month_is_written_by_size_not_by_key(spark):
    df = spark.range(10).withColumns({"order_year": F.lit(2024), "order_month": F.lit(1)})
    plan = df.hint("rebalance", *writers.MONTH)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x", 2024)], "order_id int, status string, order_year int")
    b = spark.createDataFrame([(None, 2, "y")], "order_year int, order_id int, status string")
    rows = live.union_layers(a, b.drop("order_year")).collect()
    assert [tuple(r) for r in rows] == [(1, "x", 2024), (2, "y", None)]


def test_scratch_follows_the_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_quality_report(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "", None), (None, None, 2.0), (None, "b", 3.0)],
        "id int, name string, v double",
    )
    rows = quality.table_report(df, "t", "id").collect()
    assert {(r.total_rows, r.total_columns, r.duplicate_rows) for r in rows} == {(4, 3, 2)}
    assert {r.column_name: (r.null_count, float(r.null_percent)) for r in rows} == {
        "id": (2, 50.0),
        "name": (2, 50.0),
        "v": (1, 25.0),
    }
    assert {float(r.completeness_score) for r in rows} == {58.33}
    empty = quality.table_summary(df.limit(0), "t", "id").collect()[0]
    assert (empty.total_rows, empty.duplicate_rows, float(empty.completeness_score)) == (0, 0, 100.0)
    assert quality.null_counts(df).collect()[1].null_count == 1


def test_log_of_a_small_topic(spark):
    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [("a", 0, i, str(i), "{}", at + dt.timedelta(minutes=i)) for i in range(90)], schemas.MESSAGES
    )
    topics = spark.createDataFrame([("a", 2, 1), ("b", 1, 1)], schemas.TOPICS)
    stats = msglog.partition_stats(log, topics)
    got = {(r.topic, r.partition): (r.messages, r.earliest_offset, r.latest_offset) for r in stats.collect()}
    assert got == {("a", 0): (90, 0, 89), ("a", 1): (0, -1, -1), ("b", 0): (0, -1, -1)}
    status = {r.topic: (r.partition_count, r.total_messages, r.status) for r in msglog.topic_stats(stats).collect()}
    assert status == {"a": (2, 90, "Active"), "b": (1, 0, "Empty")}
    committed = spark.createDataFrame([("g", "a", 0, 40)], schemas.COMMITTED_OFFSETS)
    lag = {r.partition: r.lag for r in msglog.consumer_lag(stats, committed).collect()}
    assert lag == {0: 50, 1: 0}
    rates = msglog.message_rates(msglog.message_snapshots(log, "30 minutes")).orderBy("snapshot_time").collect()
    assert [r.messages_per_minute for r in rates] == [0.0, 1.0, 1.0]
    kept = msglog.retained(log, topics, at + dt.timedelta(minutes=100))
    assert kept.agg(F.min("offset")).collect()[0][0] == 40
    read = msglog.read_from(log, 10, 3, "a", 0)
    assert sorted(r.offset for r in read.collect()) == [10, 11, 12]
    assert sorted(r.offset for r in msglog.latest_messages(log, 2, "a").collect()) == [88, 89]
    assert msglog.topic_partitions(spark.createDataFrame([("c", 0, 1)], schemas.TOPICS)).count() == 0
    per_topic = msglog.latest_messages(log, 2)
    assert sorted(r.offset for r in per_topic.collect()) == [88, 89]


def test_a_vanished_layer_is_built_again(spark, sf):
    from orderlake.plans import frames

    key = (spark.sparkContext.applicationId, sf, "bronze-products")
    n = frames.raw_products(spark, sf).count()
    frames._layers[key] = frames._layers[key] + "-gone"
    assert frames.raw_products(spark, sf).count() == n


def test_streaming_session_bounds_its_partitions(spark):
    session = streaming_session(spark)
    key = "spark.sql.shuffle.partitions"
    assert int(session.conf.get(key)) <= spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == "4"
