"""Row filters over raw, modelled and live frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import cleaners as C
from orderlake.operators.enrich import AsOf, as_of_date


def bad_dates(df: DataFrame, column: str = "order_date", as_of: AsOf = None) -> DataFrame:
    """Rows whose raw date is missing, unreadable, or later than ``as_of``."""
    day = C.clean_date(F.col(column))
    return df.filter(F.coalesce(day > as_of_date(as_of), F.lit(True)))


def bad_emails(df: DataFrame, column: str = "email") -> DataFrame:
    """Rows whose raw email is missing or malformed, before any tidying."""
    return df.filter(F.col(column).isNull() | ~F.col(column).rlike(C.EMAIL_PATTERN))


def negative_amounts(df: DataFrame, column: str = "total_amount") -> DataFrame:
    return df.filter(F.col(column) < 0)


def dashboard_slice(
    df: DataFrame,
    years: Sequence[int] | None = None,
    segments: Sequence[str] | None = None,
    value_segments: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the chosen years and segments; ``None`` leaves a dimension open."""
    chosen = {
        "order_year": years,
        "customer_segment": segments,
        "value_segment": value_segments,
    }
    for column, values in chosen.items():
        if values is not None:
            df = df.filter(F.col(column).isin(*values))
    return df


def recent_orders(
    df: DataFrame,
    n: int = 100,
    status: str | None = None,
    min_amount: float = 0.0,
    order_by: str = "event_timestamp",
    tie_break: str = "order_id",
) -> DataFrame:
    """The latest ``n`` orders of a status with at least ``min_amount``."""
    if status is not None:
        df = df.filter(F.col("status") == status)
    return latest(df.filter(F.col("total_amount") >= min_amount), n, order_by, tie_break)


def latest(df: DataFrame, n: int, order_by: str, tie_break: str = "order_id") -> DataFrame:
    """Top ``n`` by time: every task keeps its own best ``n`` before they are merged."""
    return df.orderBy(F.col(order_by).desc(), F.col(tie_break).desc()).limit(n)


def high_value_customers(rfm: DataFrame) -> DataFrame:
    return rfm.filter(F.col("value_segment") == "high_value").orderBy(
        F.col("monetary").desc(), "customer_id"
    )


def alerts_to_review(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("requires_review"))
