"""A refreshed lake equals a full run and leaves other months' files alone."""

import datetime as dt
import os

import pytest

import __spark_entry__ as contract
from orderlake import schemas
from orderlake.operators import enrich, model
from orderlake.plans import frames, increments

AS_OF = dt.date(2024, 6, 1)


def order(i, day, customer=1, amount=100.0, status="completed"):
    return (i, customer, day, status, amount, "web", "x")


def item(i, order_id, quantity=1):
    return (i, order_id, 5, quantity, 10.0, 0.0, 0.0, 10.0 * quantity)


@pytest.fixture(scope="module")
def known(spark):
    customers = spark.createDataFrame(
        [(c, f"Name {c}", f"u{c}@shop.com", "2023-01-01", "VIP", None, None, 30, "yes", None) for c in (1, 2, 3)],
        schemas.CUSTOMERS,
    )
    products = spark.createDataFrame([(5, "Pen", "Books", "B", 3.0, 1.0, 1, "yes", "2024-01-01", 1.0)], schemas.PRODUCTS)
    return increments.Dimensions(
        enrich.canonical_customers(enrich.clean_customers(customers, AS_OF)),
        enrich.canonical_products(enrich.clean_products(products)),
    )


def take(spark, lake, name, orders, items, known):
    return increments.refresh(
        spark, lake, name, spark.createDataFrame(orders, schemas.ORDERS),
        spark.createDataFrame(items, schemas.ORDER_ITEMS), known, AS_OF,
    )


def tables(spark, lake):
    read = lambda p: sorted(map(str, spark.read.parquet(f"{lake}/{p}").collect()))
    return {p: read(p) for p in ("silver/orders", "silver/fact_orders", "silver/customer_months", "gold/customer_segment_monthly")}


def files(lake, table):
    return {
        os.path.join(folder, f)
        for folder, _, names in os.walk(f"{lake}/silver/{table}")
        for f in names
        if f.endswith(".parquet")
    }


FIRST = (
    [order(1, "2024-01-05"), order(2, "2024-02-05", 2), order(3, "2024-03-05", 3), order(None, "2024-02-09", 2), order(7, "2024-04-01", 1)],
    [item(10, 1), item(20, 2, 2), item(30, 3)],
)
SECOND = (
    # A new order, one without a number, and an earlier record of order 7 that wins over the old.
    [order(4, "2024-03-20", 1), order(None, "2024-03-21", 3), order(7, "01/15/2024", 1, 50.0)],
    # A line for an order that came before.
    [item(40, 4), item(21, 2, 3)],
)


def test_refresh_equals_a_full_run(spark, tmp_path, known):
    lake, whole = str(tmp_path / "lake"), str(tmp_path / "whole")
    assert take(spark, lake, "a", *FIRST, known) == [(2024, 1), (2024, 2), (2024, 3), (2024, 4)]
    before = files(lake, "fact_orders")
    touched = take(spark, lake, "b", *SECOND, known)
    take(spark, whole, "all", FIRST[0] + SECOND[0], FIRST[1] + SECOND[1], known)
    assert tables(spark, lake) == tables(spark, whole)
    after = files(lake, "fact_orders")
    kept = {f for f in before if not any(f"order_month={m}/" in f for _, m in touched)}
    assert kept <= after
    # The same arrival again changes nothing; replaced by nothing, it is gone.
    take(spark, lake, "b", *SECOND, known)
    assert tables(spark, lake) == tables(spark, whole)
    take(spark, lake, "b", [], [], known)
    first = str(tmp_path / "first")
    take(spark, first, "a", *FIRST, known)
    assert tables(spark, lake) == tables(spark, first)


def test_untouched_months_keep_their_files(spark, tmp_path, known):
    lake = str(tmp_path / "lake")
    take(spark, lake, "a", *FIRST, known)
    before = {t: files(lake, t) for t in ("orders", "fact_orders", "customer_months")}
    assert take(spark, lake, "b", [order(9, "2024-02-20", 3)], [], known) == [(2024, 2)]
    for table, old in before.items():
        new = files(lake, table)
        assert {f for f in old if "order_month=2/" not in f} == {f for f in new if "order_month=2/" not in f}
    assert take(spark, lake, "c", [], [], known) == []


def test_many_months_are_one_expression(spark):
    months = [(y, m) for y in range(1990, 2010) for m in range(1, 13) if m != 7]
    rows = spark.createDataFrame(
        [(1995, 6), (1995, 7), (1994, 18), (1989, 12), (2009, 12), (None, 6), (1995, None)], "order_year int, order_month int"
    )
    kept = rows.filter(increments._within(months))
    assert sorted(tuple(r) for r in kept.collect()) == [(1995, 6), (2009, 12)]
    # A filter that repeats the columns repeats what they are made of, here two hundred times.
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("order_month") < 10
    assert rows.filter(increments._within([])).count() == 0


def test_facts_in_parts_are_the_same_facts(spark, tmp_path, known, monkeypatch):
    whole, parted = str(tmp_path / "whole"), str(tmp_path / "parted")
    joined, line_facts = [], increments.model.line_facts
    monkeypatch.setattr(increments.model, "line_facts", lambda *a: joined.append(1) or line_facts(*a))
    for arrival in (("a", *FIRST), ("b", *SECOND)):
        take(spark, whole, *arrival, known)
    assert len(joined) == 2
    # Stored lines of several times what is joined at once.
    monkeypatch.setattr(increments.Files, "size", lambda *_: 3 * increments.LINE_BYTES - 1)
    for arrival in (("a", *FIRST), ("b", *SECOND)):
        take(spark, parted, *arrival, known)
    assert len(joined) == 8
    assert tables(spark, parted) == tables(spark, whole)
    assert not [name for name in os.listdir(f"{parted}/silver") if name.endswith("-staged")]


def test_orders_of_facts_are_shuffled_once(spark, known):
    rows = spark.createDataFrame(FIRST[0], schemas.ORDERS)
    heads = model.order_facts(enrich.canonical_orders(enrich.clean_orders(rows)), known.customers)
    lines = enrich.canonical_items(enrich.clean_order_items(spark.createDataFrame(FIRST[1], schemas.ORDER_ITEMS)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = model.line_facts(heads, lines, known.products)
        assert sorted(str(r.order_id) for r in facts.collect()) == ["1", "2", "3", "7", "None"]
        plan = facts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_refresh_leaves_nothing_but_the_lake(spark, tmp_path, known):
    scratch = spark.conf.get("spark.checkpoint.dir")
    settings = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters")
    before = set(os.listdir(scratch)), [spark.conf.get(s, None) for s in settings]
    take(spark, str(tmp_path / "lake"), "a", *FIRST, known)
    assert (set(os.listdir(scratch)), [spark.conf.get(s, None) for s in settings]) == before


def test_raw_rows_of_a_refresh_are_stored_once(spark, sf, monkeypatch):
    monkeypatch.setattr(frames, "_layers", {})
    gold = {tuple(r) for r in contract.queries()["agg_gold_refresh"](spark, sf).collect()}
    stored = {name for _, _, name in frames._layers}
    assert stored and not {"bronze-orders", "bronze-order_items"} & stored
    assert gold == {tuple(r) for r in contract.queries()["agg_gold"](spark, sf).collect()}


def test_only_columns_that_choose_a_record_are_compared(spark):
    columns = [f.split()[0] for f in schemas.ORDERS.split(", ")]
    copies = [(1, 1, d, s, 9.0, w, x) for d in ("2024-01-05", "20240104") for s in ("completed", "pending") for w in "ab" for x in "yx"]
    raw = spark.createDataFrame([*copies, order(None, "2024-02-09"), order(None, "2024-02-09")], schemas.ORDERS)
    for ordered, read in ((columns, False), (["order_id", "last_updated", *columns[1:6]], True)):
        cleaned = increments._clean_orders(raw.select(*ordered))
        assert [(r.order_id, str(r.order_date), r.status) for r in cleaned.orderBy("order_id").collect()] == [
            (None, "2024-02-09", "completed"), (None, "2024-02-09", "completed"), (1, "2024-01-05", "completed")
        ]
        chosen = [x for x in cleaned._jdf.queryExecution().sparkPlan().toString().splitlines() if "min(struct" in x]
        assert chosen and all(("last_updated" in x) == read for x in chosen)
