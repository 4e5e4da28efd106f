import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.functions import cleaners as C
from orderlake.operators import enrich, quality

JAN_15 = dt.date(2024, 1, 15)


def cleaned(spark, clean, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", clean(F.col("v")).alias("c")).orderBy("i").collect()
    return [r.c for r in rows]


CASES = {
    "date": (
        C.clean_date,
        {
            "2024-01-15": JAN_15,
            "01/15/2024": JAN_15,
            "15-01-2024": JAN_15,
            "20240115": JAN_15,
            "January 15, 2024": JAN_15,
            "2024-13-45": None,
            "": None,
            None: None,
            "2024-01-15 10:00:00": None,
            "1/5/2024": None,
            "2023-02-29": None,
            "Smarch 15, 2024": None,
            "2024/01/15": None,
            "0000-01-01": None,
        },
    ),
    "phone": (
        C.clean_phone,
        {
            "+1-555-123-4567": "+1-555-123-4567",
            "555.123.4567": "+1-555-123-4567",
            "(555) 123-4567": "+1-555-123-4567",
            "5551234567": "+1-555-123-4567",
            "123-456-7890": None,
            "12345": None,
            "N/A": None,
            "": None,
            None: None,
        },
    ),
    "email": (
        C.clean_email,
        {
            " A@B.com ": "a@b.com",
            "user@domain": None,
            "notanemail": None,
            "": None,
            "user..name@domain.com": "user..name@domain.com",
            "@domain.com": None,
            None: None,
        },
    ),
    "status": (
        C.clean_status,
        {
            "Complete": "completed",
            "unknwon": "unknown",
            None: "unknown",
            "": "unknown",
            "Delivered": "shipped",
            "processing": "pending",
            "canceled": "cancelled",
            "RETURNED": "refunded",
            "error": "failed",
            "foo ": "foo",
        },
    ),
    "segment": (
        C.clean_segment,
        {
            "vip": "Premium",
            "Silver": "Regular",
            "NEW": "Bronze",
            "tbd": "Unknown",
            None: "Unknown",
            " Churned ": "Churned",
        },
    ),
    "boolean": (
        C.clean_boolean,
        {
            "Yes": True,
            "T": True,
            "1": True,
            "Active": True,
            "no": False,
            "0": False,
            "Inactive": False,
            "": None,
            "maybe": None,
            None: None,
        },
    ),
    "name": (
        C.clean_name,
        {
            "  Dr. Ann   Lee ": "Ann Lee",
            "Mr.Bob": "Bob",
            "test user": None,
            "N/A": None,
            "  ": None,
            None: None,
            "lee, ann": "lee, ann",
        },
    ),
    "product": (
        C.clean_product_name,
        {"": "Unknown Product", "tbd": "Unknown Product", None: "Unknown Product", " Cup ": "Cup"},
    ),
    "category": (
        C.clean_category,
        {
            "ELECTRONICS": "Electronics",
            "Electronic": "Electronics",
            "HOME_KITCHEN": "Home & Kitchen",
            "kitchen": "Home & Kitchen",
            "SPORTS": "Sports & Outdoors",
            "Book & Media": "Books",
            "TBD": "Other",
            None: "Other",
            " Toys ": "Toys",
            "Tech": "Tech",
        },
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_truth_table(spark, name):
    clean, expected = CASES[name]
    assert cleaned(spark, clean, list(expected)) == list(expected.values())


def test_name_in_title_case(spark):
    assert cleaned(spark, lambda c: C.clean_name(c, title_case=True), ["ms. ANN lee"]) == ["Ms. Ann Lee"]
    assert cleaned(spark, lambda c: C.clean_name(c, title_case=True), ["Ms. ANN lee"]) == ["Ann Lee"]


def test_number_bounds(spark):
    values = [-1.0, 0.0, 50000.0, 50000.01, None, float("nan")]
    got = cleaned(spark, lambda c: C.clean_number(c, 0, 50000), values, "double")
    assert got == [None, 0.0, 50000.0, None, None, None]
    assert cleaned(spark, C.clean_number, [-5.0, None], "double") == [-5.0, None]


def test_completeness_counts_typed_columns(spark):
    df = spark.createDataFrame(
        [(1, "A", None, JAN_15), (None, "", "x", None)],
        "customer_id int, name string, email string, day date",
    )
    rows = quality.completeness_score(df, df.columns).collect()
    assert [r.data_quality_score for r in rows] == [75.0, 25.0]


def test_items_recalculate_totals(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 1, 2, 10.0, 10.0, 1.5, 19.5),
            (2, 1, 1, 2, 10.0, 10.0, None, 18.02),
            (3, 1, 1, 0, 10.0, None, None, 0.0),
            (4, 1, 1, 1, 10.0, 150.0, None, 10.0),
            (5, 1, 1, 1, 10.0, None, None, None),
        ],
        "item_id bigint, order_id bigint, product_id bigint, quantity int, price double, "
        "discount_percent double, tax_amount double, line_total double",
    )
    rows = enrich.clean_order_items(df).orderBy("item_id").collect()
    assert [None if r.line_total_calculated is None else float(r.line_total_calculated) for r in rows] == [
        19.5, 18.0, None, 10.0, 10.0,
    ]
    assert [r.calculation_matches for r in rows] == [True, False, False, True, False]


def test_products_margin_and_cost_check(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 60.0), (2, 50.0, 60.0), (3, 0.0, 0.0), (4, None, 5.0), (5, 9e9, 5.0)],
        "product_id bigint, unit_price double, cost double",
    )
    for c in ("product_name", "category", "is_active", "created_date"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("weight_kg", F.lit(-1.0))
    rows = enrich.clean_products(df).orderBy("product_id").collect()
    margins = [None if r.margin_percent is None else float(r.margin_percent) for r in rows]
    assert margins == [40.0, -20.0, None, None, None]
    assert [r.price_cost_valid for r in rows] == [True, False, True, None, None]
    assert {r.weight_kg_cleaned for r in rows} == {None}


def test_orders_flags(spark):
    df = spark.createDataFrame(
        [
            (1, 7, "2024-01-15", "Complete", 10.0),
            (2, None, "2024-01-15", "complete", 10.0),
            (3, 7, "nope", "pending", 10.0),
            (4, 7, "20240115", "pending", 0.0),
            (5, 7, "20240115", "pending", 60000.0),
        ],
        "order_id bigint, customer_id bigint, order_date string, status string, total_amount double",
    )
    rows = enrich.clean_orders(df).orderBy("order_id").collect()
    assert [r.is_valid_order for r in rows] == [1, 0, 0, 0, 0]
    assert [r.is_completed for r in rows] == [1, 1, 0, 0, 0]
    assert (rows[0].order_year, rows[0].order_month) == (2024, 1)
