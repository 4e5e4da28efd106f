"""Operators that must not gather a hot key, against brute force on skewed fixtures."""

import datetime as dt
import math
import random
import re
import struct
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.operators import dedupe, distribution, fraud, integrity, model, msglog

DAY = dt.date(2024, 1, 1)


def skewed_orders(n=1500, seed=3):
    """A third of the orders belong to customer 0, most of them on few days."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        customer = 0 if hot else rng.randrange(1, 60)
        day = DAY + dt.timedelta(days=rng.choice([0, 0, 1, 9, 40]) if hot else rng.randrange(90))
        rows.append((i, customer, day))
    rng.shuffle(rows)
    return rows


def test_days_since_last_order(spark):
    rows = skewed_orders()
    df = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_date date").repartition(7)
    got = {
        r.order_id: (r.prev_order_date, r.days_since_last_order)
        for r in fraud.days_since_last_order(df).collect()
    }
    expected, last = {}, {}
    for order, customer, day in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        before = last.get(customer)
        expected[order] = (before, (day - before).days if before else None)
        last[customer] = day
    assert got == expected


def test_days_since_last_order_without_numbers(spark):
    df = spark.createDataFrame(
        [(None, 1, DAY), (4, 1, DAY), (5, 1, DAY + dt.timedelta(days=2))],
        "order_id bigint, customer_id bigint, order_date date",
    )
    got = {r.order_id: r.days_since_last_order for r in fraud.days_since_last_order(df).collect()}
    assert got == {None: None, 4: 0, 5: 2}


def test_orders_in_window(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1200):
        customer = 0 if rng.random() < 0.34 else rng.randrange(1, 20)
        # Whole minutes make ties and distances of exactly one hour common.
        rows.append((i, customer, start + dt.timedelta(minutes=rng.randrange(600))))
    rows += [(5000, None, start), (5001, 3, None)]
    df = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_timestamp timestamp")
    got = {
        r.order_id: r.orders_in_last_hour
        for r in fraud.orders_in_window(df.repartition(5)).collect()
    }
    times = defaultdict(list)
    for _, customer, at in rows:
        if customer is not None and at is not None:
            times[customer].append(at)
    for t in times.values():
        t.sort()
    for order, customer, at in rows:
        if customer is None or at is None:
            assert got[order] is None
        else:
            t = times[customer]
            assert got[order] == bisect_right(t, at) - bisect_left(t, at - dt.timedelta(hours=1))


@pytest.mark.parametrize("partitions", [1, 6])
def test_duplicates_of_a_hot_key(spark, partitions):
    rng = random.Random(11)
    rows = []
    for _ in range(900):
        key = None if rng.random() < 0.2 else (0 if rng.random() < 0.34 else rng.randrange(1, 200))
        rows.append((key, rng.choice(["a", "b", None]), rng.randrange(3)))
    df = spark.createDataFrame(rows, "k bigint, v string, w int").repartition(partitions)
    flagged = [tuple(r) for r in dedupe.flag_duplicates(df, ["k"]).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    expected, seen = [], set()
    for row in sorted(rows, key=order):
        expected.append((*row, row[0] in seen))
        seen.add(row[0])
    assert Counter(flagged) == Counter(expected)
    kept = [tuple(r) for r in dedupe.drop_duplicates_by_key(df, ["k"]).collect()]
    assert Counter(kept) == Counter(r[:3] for r in expected if not r[3])
    whole = [tuple(r) for r in dedupe.drop_duplicates_by_key(df, ["k"], keep_unkeyed=True).collect()]
    assert Counter(whole) == Counter(r[:3] for r in expected if r[0] is None or not r[3])


def test_fact_keeps_every_line_of_a_hot_order(spark):
    orders = spark.createDataFrame(
        [(i, "n", "s", 1.0) for i in range(30)] + [(None, "n", "s", 1.0)],
        "order_id bigint, customer_name string, customer_segment string, customer_data_quality double",
    )
    for c, kind in {
        "customer_id": "bigint", "order_date": "date", "order_year": "int", "order_month": "int",
        "status": "string", "total_amount": "decimal(18,2)", "is_completed": "int",
    }.items():
        orders = orders.withColumn(c, F.lit(None).cast(kind))
    rows = [(i, 0 if i < 100 else i % 25, None if i % 5 == 0 else i % 4, 1, 1.0, 1.0, True) for i in range(300)]
    rows += [(900, 29, 1, None, 1.0, 1.0, True), (901, None, 1, 1, 1.0, 1.0, True)]
    items = spark.createDataFrame(
        rows,
        "item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price double, "
        "line_total double, line_calc_valid boolean",
    )
    products = spark.createDataFrame(
        [(1, "one", "c", True), (1, "uno", "c", True), (2, "two", "c", False), (None, "x", "c", True)],
        "product_id bigint, product_name string, product_category string, product_active boolean",
    )
    got = Counter(
        (r.order_id, r.product_id, r.product_name)
        for r in model.line_facts(orders, items, products).collect()
    )
    names = {1: "one", 2: "two"}
    expected = Counter((r[1], r[2], names.get(r[2])) for r in rows[:300])
    expected.update((i, None, None) for i in [25, 26, 27, 28, 29, None])
    assert got == expected


def test_orphans(spark):
    children = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k bigint")
    parents = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k bigint")
    assert sorted(r.k for r in integrity.orphans(children, parents, "k").collect()) == [2, 9, 9]
    assert integrity.orphan_count(children, parents, "k", "x").collect()[0].orphan_count == 3
    none = integrity.orphan_count(children.limit(0), parents, "k", "x").collect()[0]
    assert none.orphan_count == 0


def test_exact_quantiles(spark):
    rng = random.Random(2)
    rows = [("a", 5.0)] * 400 + [("a", rng.uniform(-50, 900)) for _ in range(333)]
    rows += [("b", rng.lognormvariate(3, 2)) for _ in range(101)] + [("c", 1.5), ("b", None)]
    rows += [(None, v) for v in (7.0, 3.0, 9.5)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]

    def lower(values, p):
        ordered = sorted(values)
        return ordered[max(1, -int(-p * len(ordered) // 1)) - 1]

    got = {
        r.g: r.quantiles
        for r in distribution.exact_quantiles(df, "v", probabilities, ["g"]).collect()
    }
    for g in ("a", "b", "c", None):
        values = [v for k, v in rows if k == g and v is not None]
        assert got[g] == [lower(values, p) for p in probabilities]
    everything = [v for _, v in rows if v is not None]
    overall = distribution.exact_quantiles(df, "v", probabilities).collect()[0].quantiles
    assert overall == [lower(everything, p) for p in probabilities]


def test_exact_quantiles_of_any_range(spark):
    rng = random.Random(5)
    values = [rng.choice((-1, 1)) * 10.0 ** rng.uniform(-320, 308) for _ in range(500)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308, float("inf"), float("-inf"), 1.0, 2.0]
    values += [math.nextafter(2.0**e, d) for e in (-1000, -3, 0, 1, 10, 1000) for d in (0.0, math.inf)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    bits = df.select("v", distribution.ordered_bits(df, "v").alias("b")).collect()
    assert all(r.b == (struct.unpack("<q", struct.pack("<d", abs(r.v)))[0] * (-1 if r.v < 0 else 1)) for r in bits)
    probabilities = [i / 20 for i in range(21)]
    ordered = sorted(values)
    want = [ordered[max(1, math.ceil(len(ordered) * p)) - 1] for p in probabilities]
    assert distribution.exact_quantiles(df, "v", probabilities).first().quantiles == want
    for kind in ("decimal(18,2)", "decimal(30,4)", "bigint", "int"):
        numbers = [rng.randrange(-(10**6), 10**6) for _ in range(300)]
        frame = spark.createDataFrame([(n,) for n in numbers], "n bigint").selectExpr(f"cast(n as {kind}) AS v")
        got = distribution.exact_quantiles(frame, "v", [0.5, 0.9]).first().quantiles
        assert [int(q) for q in got] == [sorted(numbers)[149], sorted(numbers)[269]]


def test_one_key_with_most_rows_of_an_hour_is_split(spark):
    # All rows of one key in one hour: no task may put more than a part of them in order.
    n = 20_000
    df = spark.range(n).selectExpr(
        "1L AS customer_id", "timestamp_micros(3600000000 * 5 + cast(id * 3600000000 / {n} as long)) AS order_timestamp".format(n=n)
    )
    counted = fraud.orders_in_window(df)
    assert counted.agg(F.sum("orders_in_last_hour"), F.max("orders_in_last_hour")).first()[:] == (n * (n + 1) // 2, n)
    instants = df.groupBy(F.col("customer_id").alias("_key"), F.unix_micros("order_timestamp").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    spread = fraud.counts_in_window(instants, 3600, "c").withColumn("task", F.spark_partition_id())
    # Four partitions here, if Spark does not join them; the key's hour is dealt over them.
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        assert spread.groupBy("task").count().agg(F.max("count")).first()[0] < 0.6 * n
    finally:
        spark.conf.unset(coalesce)


def test_outliers(spark):
    values = [float(v) for v in range(1, 101)] + [1000.0, -900.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for exact in (True, False):
        flagged = distribution.flag_outliers(df, "v", exact=exact)
        assert sorted(r.v for r in flagged.filter("v_is_outlier").collect()) == [-900.0, 1000.0]
    empty = distribution.flag_outliers(df.filter("v IS NULL"), "v")
    assert [r.v_is_outlier for r in empty.collect()] == [False]


def test_approximate_quartiles_are_close(spark):
    df = spark.range(10_000).withColumn("v", F.col("id").cast("double")).withColumn("g", F.lit("x"))
    box = distribution.box_plot(df, "v", "g").collect()[0]
    for got, want in ((box.q1, 2500), (box.median, 5000), (box.q3, 7500)):
        assert abs(got - want) <= 100


def test_ranks_of_estimates(spark):
    rows = [("x", float(i)) for i in range(100)] + [(None, 7.0)] * 10 + [("x", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    guesses = spark.createDataFrame([("x", [24.0, 59.0]), (None, [7.0, 7.5])], "g string, quantiles array<double>")
    got = distribution.quantile_ranks(df, "v", guesses, [0.25, 0.5], ["g"])
    got = got.withColumn("close", distribution.within_error(0.05)).collect()
    assert {tuple(r) for r in got} == {
        ("x", 0.25, 100, 25, 25, True),
        ("x", 0.5, 100, 60, 60, False),
        (None, 0.25, 10, 1, 10, True),
        (None, 0.5, 10, 11, 10, False),
    }
    alone = guesses.filter("g = 'x'")
    assert [r.n for r in distribution.quantile_ranks(df, "v", alone, [0.25]).collect()] == [110]
    assert distribution.quantile_ranks(df.limit(0), "v", alone, [0.25]).collect() == []


def test_box_plot_keeps_a_group_without_a_name(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("x", 5.0)], "g string, v double")
    exact = distribution.box_plot(df, "v", "g", exact=True)
    assert {r.g: (r.n, r.q1, r.median, r.maximum) for r in exact.collect()} == {
        None: (2, 1.0, 1.0, 2.0),
        "x": (1, 5.0, 5.0, 5.0),
    }


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [(r.bin, r["count"]) for r in distribution.histogram(df, "v", 10).collect()] == [(0, 2)]


def test_long_topic_is_limited_before_the_shuffle(spark, sf):
    from orderlake.sources import supplied

    def nodes(n):
        top = msglog.latest_messages(supplied.messages(spark, sf), n)
        plan = top._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"[A-Z][A-Za-z]+(?= |\()", re.sub(r"\[.*?\]|\(.*?\)|Filter.*|Project.*", " ", plan))

    # One plan whatever the limit: the window sees rows of a topic's last bin only.
    assert nodes(5) == nodes(1000) == nodes(1001) and "WindowGroupLimit" not in nodes(5)
    log = spark.createDataFrame(
        [("a", i % 3, i, dt.datetime(2024, 1, 1 + i // 500)) for i in range(3000)]
        + [(None, 0, 1, dt.datetime(2024, 1, 1)), ("b", 0, 1, None)],
        "topic string, partition int, offset long, timestamp timestamp",
    )
    for n in (1, 499, 500, 501, 1499, 5000):
        got = msglog.latest_messages(log, n).collect()
        assert sorted(r.offset for r in got if r.topic == "a") == list(range(max(0, 3000 - n), 3000))
        assert len([r for r in got if r.topic != "a"]) == 2
        got = msglog.read_from(log, 700, n).filter("topic = 'a' and partition = 1").collect()
        assert sorted(r.offset for r in got) == [i for i in range(700, 3000) if i % 3 == 1][:n]
