import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as contract
from orderlake.operators import filters, metrics, model
from orderlake.plans import frames


def cents(df, *columns):
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in columns})


def test_customer_metrics(spark):
    orders = cents(
        spark.createDataFrame(
            [
                (1, 101, "2023-01-01", "completed", 100.0),
                (2, 102, "2023-01-02", "completed", 200.0),
                (3, 101, "2023-01-03", "completed", 150.0),
                (4, 103, "2023-01-04", "pending", 300.0),
            ],
            "order_id bigint, customer_id bigint, order_date string, status string, total_amount double",
        ),
        "total_amount",
    )
    customers = spark.createDataFrame(
        [(c, dt.date(2022, 12, 31), "Premium") for c in (101, 101, 102, 103)],
        "customer_id bigint, join_date date, segment string",
    )
    got = {
        r.customer_id: (r.total_orders, float(r.total_revenue), float(r.avg_order_value), r.tenure_days)
        for r in metrics.customer_metrics(orders, customers, dt.date(2023, 1, 31)).collect()
    }
    assert got == {101: (2, 250.0, 125.0, 31), 102: (1, 200.0, 200.0, 31)}


def test_revenue_drops(spark):
    monthly = spark.createDataFrame(
        [(2023, 1, 10000.0), (2023, 2, 12000.0), (2023, 3, 11500.0), (2023, 4, 80000.0), (2023, 5, 13000.0)],
        "order_year int, order_month int, monthly_revenue double",
    )
    got = metrics.revenue_drops(monthly, 0.2).collect()
    assert [(r.order_month, r.revenue_drop_pct) for r in got] == [(5, 0.8375)]
    # A month without revenue before gives no drop instead of a division error.
    zero = spark.createDataFrame(
        [(2023, 1, 0.0), (2023, 2, 5.0)], "order_year int, order_month int, monthly_revenue double"
    )
    assert metrics.revenue_drops(zero).count() == 0


def sales(spark):
    rows = [
        (1, 1, "A", "Premium", dt.date(2024, 1, 5), 300.0),
        (2, 1, "A", "Premium", dt.date(2024, 1, 9), 250.0),
        (3, 2, "B", "Regular", dt.date(2023, 10, 20), 300.0),
        (4, 3, "C", "Regular", dt.date(2024, 1, 20), 100.0),
    ]
    df = spark.createDataFrame(
        rows,
        "order_id bigint, customer_id bigint, customer_name string, customer_segment string, "
        "order_date date, total_amount double",
    )
    return cents(df, "total_amount").withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "status": F.lit("completed"),
            "is_completed": F.lit(1),
            "is_valid_order": F.lit(1),
            "customer_data_quality": F.lit(100.0),
        }
    )


def test_rfm_and_gold_agree_between_orders_and_months(spark):
    as_of = dt.date(2024, 2, 1)
    orders = sales(spark)
    people = orders.select(
        "customer_id", F.col("customer_name").alias("name"), F.col("customer_segment").alias("segment")
    )
    months = metrics.customer_months(orders, people)
    assert months.count() == 3
    rfm = metrics.customer_rfm(orders, as_of)
    assert {r.customer_id: r.value_segment for r in rfm.collect()} == {
        1: "high_value",
        2: "low_value",
        3: "low_value",
    }
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(rfm.select("customer_id", "monetary", "frequency", "recency_days")) == key(
        metrics.customer_rfm(months, as_of).select("customer_id", "monetary", "frequency", "recency_days")
    )
    assert key(metrics.gold_dashboard(orders, rfm)) == key(metrics.gold_dashboard(months, rfm))
    assert key(metrics.segment_analysis(orders)) == key(metrics.segment_analysis(months))


def test_line_grain_counts_every_line(spark):
    lines = sales(spark).unionByName(sales(spark))
    by_line = {r.customer_segment: r.order_count for r in metrics.segment_analysis(lines, "line").collect()}
    by_order = {r.customer_segment: r.order_count for r in metrics.segment_analysis(lines, "order").collect()}
    assert by_line == {"Premium": 4, "Regular": 4}
    assert by_order == {"Premium": 2, "Regular": 2}
    assert model.order_grain(lines).count() == 4


def test_kpis_of_an_empty_slice(spark):
    empty = sales(spark).filter("order_id < 0")
    row = metrics.dashboard_kpis(empty).collect()[0]
    assert (float(row.total_revenue), row.total_orders, row.unique_customers) == (0.0, 0, 0)
    assert float(row.avg_order_value) == 0.0


def test_sketched_customers_are_close(spark, sf, duckdb_con):
    gold = metrics.gold_dashboard(
        frames.customer_months(spark, sf), frames.rfm(spark, sf), customer_sketch=True
    )
    chosen = filters.dashboard_slice(gold, [1999, 2000, 2001], ["Premium", "Regular", "Bronze"])
    estimate = frames.report(metrics.dashboard_kpis_from_gold(chosen)).collect()[0]
    exact = contract.queries()["agg_dash_kpi"](spark, sf).collect()[0]
    assert estimate.total_revenue == exact.total_revenue
    assert abs(estimate.unique_customers - exact.unique_customers) <= 0.05 * exact.unique_customers + 1


def test_facts_are_joined_with_the_columns_of_their_query(spark, sf):
    for name in ("agg_category_order_total", "agg_category", "agg_segment_line"):
        plan = contract.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "customer_name" not in plan and "silver-order_items" in plan
    # Nothing stores the wide table for a query that sums a few of its columns.
    assert not any(name == "silver-fact_orders" for _, _, name in frames._layers)


def test_order_parts_of_facts_are_the_order_facts(spark, sf):
    orders = sales(spark).select(*model.ORDER_COLUMNS)
    # A record that came twice, an order without a number and one without lines.
    orders = orders.unionByName(orders.filter("order_id = 1")).unionByName(
        orders.filter("order_id = 4").withColumn("order_id", F.lit(None).cast("bigint"))
    )
    items = cents(
        spark.createDataFrame(
            [(10, 1, 5, 1, 1.0), (11, 1, 6, 2, 1.0), (20, 2, 5, None, 1.0), (30, 3, None, 1, 1.0), (90, None, 5, 1, 1.0)],
            "item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price double",
        ),
        "unit_price",
    ).withColumns({"line_total": F.col("unit_price"), "line_calc_valid": F.lit(True)})
    products = spark.createDataFrame(
        [(5, "Pen", "Books", True)], "product_id bigint, product_name string, product_category string, product_active boolean"
    )
    facts = model.line_facts(orders, items, products)
    key = lambda df: sorted(map(str, model.order_grain(df).collect()))
    assert facts.count() == 8 and key(facts) == key(orders)
    read = contract.queries()["agg_segment_order"](spark, sf).inputFiles()
    assert read and all("silver-order_facts" in f for f in read)


def test_rfm_and_gold_agree_between_lines_and_their_months(spark):
    as_of = dt.date(2024, 2, 1)
    lines = sales(spark).unionByName(sales(spark).withColumn("order_id", F.lit(None).cast("bigint")))
    lines = lines.unionByName(sales(spark).filter("customer_id = 2").withColumn("customer_segment", F.lit(None).cast("string")))
    lines = lines.unionByName(sales(spark).withColumn("status", F.lit("pending")))
    months = metrics.line_months(lines)
    assert months.count() == 4
    key = lambda df: sorted(map(str, (tuple(r) for r in frames.report(df).collect())))
    rfm, of_months = (metrics.customer_rfm(x, as_of, grain="line") for x in (lines, months))
    assert key(rfm) == key(of_months)
    gold = lambda df: metrics.gold_dashboard(df, rfm, grain="line", distinct_customers=False)
    assert key(gold(lines)) == key(gold(months)) and {r.customer_count for r in gold(months).collect()} == {1, 2, 4}
