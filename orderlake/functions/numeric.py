"""Exact money and ratio arithmetic.

Sums of doubles depend on the order in which shuffle blocks arrive; decimals do
not, so a retried or re-planned stage gives the same cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
_COUNT = "decimal(20,0)"


def money(c: Column) -> Column:
    """Amount in cents precision; null where the value cannot be held (NaN, overflow)."""
    return c.try_cast(MONEY)


def sum_money(c: Column) -> Column:
    return F.round(F.sum(c), 2)


def avg_money(total: Column, n: Column) -> Column:
    """``total / n`` rounded half-up to cents, null for no rows."""
    return F.round(F.try_divide(total, n.cast(_COUNT)), 2)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals, null for an empty whole."""
    return F.round(F.try_divide(part.cast(_COUNT) * 100, whole.cast(_COUNT)), 2)


def count_when(condition: Column) -> Column:
    """Rows for which ``condition`` holds (0, never null, on no rows)."""
    return F.count(F.when(condition, F.lit(1)))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double, for reports and exports."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
