"""Fraud and value scores as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
# (threshold, points): points for a value above the threshold, highest first.
BATCH_AMOUNT_TIERS = ((5000, 4), (3000, 3), (2000, 2), (1000, 1))
STREAM_AMOUNT_TIERS = ((5000, 4), (3000, 3), (2000, 2))
ALERT_AMOUNT_TIERS = ((5000, 4), (2000, 2))
QUANTITY_TIERS = ((30, 3), (20, 2), (15, 1))
ITEM_TIERS = ((25, 3), (15, 2), (10, 1))
# (days, points): points for fewer days since the customer's last order.
VELOCITY_TIERS = ((1, 4), (3, 2), (7, 1))
FRAUD_THRESHOLD = 3
REVIEW_THRESHOLD = 5
RISKY_STATUSES = ("cancelled", "refunded")
# (type, least points per score): the first line that is met decides.
FRAUD_TYPES = (
    ("Velocity + High Value", {"velocity": 2, "amount": 2}),
    ("Velocity Fraud", {"velocity": 3}),
    ("High Value Fraud", {"amount": 3}),
    ("Bulk Purchase Fraud", {"quantity": 2}),
    ("Suspicious Quantity", {"item": 2}),
)
BATCH_RISK_LEVELS = ((8, "Critical"), (6, "High"), (4, "Medium"))
HIGH_AMOUNT_REASON = "High transaction amount"
ELEVATED_AMOUNT_REASON = "Elevated transaction amount"
STATUS_REASON = "Suspicious order status"
# (label, least monetary value, most days since the last order)
VALUE_SEGMENTS = (("high_value", 500, 60), ("medium_value", 250, 90))
# -----------------------------------------------------------------------------


def points_above(c: Column, tiers: Sequence[tuple[float, int]]) -> Column:
    score = F
    for threshold, points in tiers:
        score = score.when(c > threshold, points)
    return score.otherwise(0)


def points_below(c: Column, tiers: Sequence[tuple[float, int]]) -> Column:
    score = F
    for threshold, points in tiers:
        score = score.when(c < threshold, points)
    return score.otherwise(0)


def status_points(status: Column) -> Column:
    return F.when(status.isin(*RISKY_STATUSES), 1).otherwise(0)


def fraud_type(points: Mapping[str, Column]) -> Column:
    """First type whose least points are all reached; ``points`` by score name."""
    label = F
    for name, least in FRAUD_TYPES:
        reached = [points[score] >= floor for score, floor in least.items()]
        label = label.when(reduce(and_, reached), name)
    return label.otherwise("Mixed Pattern")


def batch_risk_level(score: Column) -> Column:
    level = F
    for floor, label in BATCH_RISK_LEVELS:
        level = level.when(score >= floor, label)
    return level.otherwise("Low")


def value_segment(monetary: Column, recency_days: Column, rules=VALUE_SEGMENTS) -> Column:
    segment = F
    for label, least, most_days in rules:
        segment = segment.when((monetary >= least) & (recency_days <= most_days), label)
    return segment.otherwise("low_value")
