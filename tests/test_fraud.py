import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.functions import scores as S
from orderlake.operators import fraud

# order, customer, date, amount, item quantities
ORDERS = [
    (200, 101, "2024-01-15", 2500, [15, 8]),
    (203, 101, "2024-01-15", 1200, [6]),
    (204, 101, "2024-01-15", 3100, [20]),
    (206, 108, "2024-09-20", 6500, [30]),
    (207, 103, "2024-07-10", 1800, [12]),
    (208, 103, "2024-07-10", 2200, [14]),
    (209, 103, "2024-07-10", 1950, [16]),
    (212, 110, "2024-11-12", 2900, [35]),
    (214, 115, "2024-12-01", 2100, [18]),
    (300, 120, "2024-12-01", 900, []),
    (301, 120, "2024-12-03", 900, [2, None]),
]
# order: score, type, risk level; by the scoring rules, ties on a day ordered by number
EXPECTED = {
    200: (5, "Bulk Purchase Fraud", "Medium"),
    203: (5, "Velocity Fraud", "Medium"),
    204: (10, "Velocity + High Value", "Critical"),
    206: (9, "High Value Fraud", "Critical"),
    208: (7, "Velocity + High Value", "High"),
    209: (8, "Velocity Fraud", "Critical"),
    212: (8, "Bulk Purchase Fraud", "Critical"),
    214: (5, "Suspicious Quantity", "Medium"),
}


@pytest.fixture(scope="module")
def frames(spark):
    orders = spark.createDataFrame(
        [(o, c, dt.date.fromisoformat(d), float(a), 1) for o, c, d, a, _ in ORDERS]
        + [(400, 101, dt.date(2024, 1, 14), 9000.0, 0)],
        "order_id bigint, customer_id bigint, order_date date, total_amount double, is_valid_order int",
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))
    items = spark.createDataFrame(
        [(o * 10 + i, o, q) for o, _, _, _, qs in ORDERS for i, q in enumerate(qs)],
        "item_id bigint, order_id bigint, quantity int",
    )
    return orders, items


def test_worked_cases(frames):
    found = {
        r.order_id: (r.fraud_score, r.fraud_type, r.risk_level)
        for r in fraud.potential_fraud(*frames).collect()
    }
    assert found == EXPECTED


def test_totals_and_kpis(frames):
    scored = fraud.potential_fraud(*frames)
    row = {r.order_id: r for r in scored.collect()}[200]
    assert (row.total_quantity, row.max_item_quantity) == (23, 15)
    kpis = fraud.fraud_kpis(scored, "total_amount_cleaned").collect()[0]
    assert (kpis.alerts, kpis.high_risk, kpis.max_score) == (8, 8, 10)
    assert float(kpis.avg_score) == 7.13
    assert [r.order_id for r in fraud.top_scores(scored, 3).collect()] == [204, 206, 209]


def test_kpis_of_nothing(frames):
    none = fraud.fraud_kpis(fraud.potential_fraud(*frames).limit(0), "total_amount_cleaned")
    row = none.collect()[0]
    assert (row.alerts, row.high_risk, float(row.fraud_amount)) == (0, 0, 0.0)
    assert row.avg_amount is None and row.max_score is None


def test_tiers_exclude_their_threshold(spark):
    df = spark.createDataFrame([(5000.0,), (5000.01,), (None,)], "a double")
    points = df.select(S.points_above(F.col("a"), S.BATCH_AMOUNT_TIERS).alias("p")).collect()
    assert [r.p for r in points] == [3, 4, 0]


def test_row_rule_and_alerts(spark):
    at = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame(
        [
            (1, 1, 5001.0, "cancelled"),
            (2, 1, 3001.0, "completed"),
            (3, 1, 2001.0, "refunded"),
            (4, 1, 2001.0, "completed"),
            (5, 1, 2500.0, None),
            (6, 1, None, "cancelled"),
        ],
        "order_id bigint, customer_id bigint, total_amount double, status string",
    ).withColumns({"event_timestamp": F.lit(at), "is_valid_order": F.lit(1)})
    scores = {r.order_id: r.fraud_score for r in fraud.suspicious_rows(df).collect()}
    assert scores == {1: 5, 2: 3, 3: 3}
    alerts = {r.order_id: r for r in fraud.fraud_alerts(df).collect()}
    assert set(alerts) == {1, 3}
    assert alerts[1].reasons == ["High transaction amount", "Suspicious order status"]
    assert (alerts[1].risk_level, alerts[1].requires_review) == ("HIGH", True)
    assert alerts[3].reasons == ["Elevated transaction amount", "Suspicious order status"]
    assert (alerts[3].risk_level, alerts[3].requires_review) == ("MEDIUM", False)
    assert alerts[1].alert_id == f"FRAUD_1_{int(at.replace(tzinfo=dt.timezone.utc).timestamp())}"
    kpis = fraud.alert_kpis(fraud.fraud_alerts(df)).collect()[0]
    assert (kpis.total_alerts, kpis.high_risk, float(kpis.avg_fraud_score)) == (2, 1, 4.0)
    reasons = {r.reason: r.frequency for r in fraud.reason_frequency(fraud.fraud_alerts(df)).collect()}
    assert reasons["Suspicious order status"] == 2


def test_copies_and_unnumbered_orders_follow_one_another(spark):
    from orderlake.operators.fraud import days_since_last_order

    rows = [
        (1, 7, "2024-01-01"), (2, 7, "2024-01-10"), (2, 7, "2024-01-10"), (3, 7, "2024-01-10"),
        (1, 8, "2024-01-01"), (None, 8, "2024-01-05"), (None, 8, "2024-01-05"), (4, 8, "2024-01-05"),
        (5, 9, "2024-01-03"),
    ]
    orders = spark.createDataFrame(rows, "order_id long, customer_id long, order_date string")
    orders = orders.withColumn("order_date", orders.order_date.cast("date")).repartition(3)
    found = days_since_last_order(orders).collect()
    gaps = {}
    for r in found:
        gaps.setdefault((r.customer_id, r.order_id), []).append(r.days_since_last_order)
    assert len(found) == len(rows)
    assert {k: sorted(v, key=lambda x: x or 0) for k, v in gaps.items()} == {
        (7, 1): [None], (7, 2): [0, 9], (7, 3): [0],
        (8, 1): [None], (8, None): [0, 4], (8, 4): [0], (9, 5): [None],
    }
