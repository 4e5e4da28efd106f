"""Quantiles, outliers, histograms and box plots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def approx_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.01
) -> DataFrame:
    """One row with the array ``quantiles``; small sketches are merged, values are not gathered."""
    return df.agg(
        F.percentile_approx(
            F.col(column), list(probabilities), max(1, round(1 / relative_error))
        ).alias("quantiles")
    )


DIGIT_BITS, DIGITS = 16, 4


def ordered_bits(df: DataFrame, column: str) -> Column:
    """A 64-bit integer that rises with the column's value: the bits of its double, negated for
    a negative one. Whole numbers and decimals of up to 18 digits are their own integer."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (value * F.lit(10**kind.scale).cast("decimal(20,0)")).cast("bigint")
    # Longer decimals round to doubles, which keeps their order.
    value = value.cast("double")
    size = F.abs(value)
    # The exponent, mended where the logarithm is off by one; powers of two are exact.
    near = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022))
    scaled = size / F.pow(F.lit(2.0), near)
    exponent = F.when(scaled >= 2, near + 1).when((scaled < 1) & (near > -1022), near - 1).otherwise(near)
    mantissa = size / F.pow(F.lit(2.0), exponent)
    normal = F.shiftleft((exponent + 1023).cast("bigint"), 52) + ((mantissa - 1) * float(1 << 52)).cast("bigint")
    subnormal = (size * float(2.0**537) * float(2.0**537)).cast("bigint")
    infinite, undefined = F.lit(0x7FF0000000000000), F.lit(0x7FF8000000000000)
    bits = (
        F.when(F.isnan(value), undefined)
        .when(size == float("inf"), infinite)
        .when(size < 2.0**-1022, subnormal)
        .otherwise(normal)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact lower quantiles: the value at rank ``ceil(p * n)``, per group. NaN is the largest.

    A radix selection over the order-preserving bits of the values, sixteen at a time. A pass
    counts the next digit of the rows that share the digits found so far; the running sums
    over at most 65,536 counts tell the digit that holds the wanted rank. So no task sees more
    than that, whatever the values' range and number. Counts and equal values of a group are
    combined before the shuffle.
    """
    keys = list(by)
    rows = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).alias("_value"))
    if keys:
        rows = rows.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    else:
        rows = rows.withColumn("_n", F.lit(1).cast("bigint"))
    rows = rows.withColumn("_bits", ordered_bits(rows, "_value"))
    found, asked = None, ["_which", "_rank", "_before"]
    for digit in reversed(range(DIGITS)):
        prefix = F.shiftright("_bits", digit * DIGIT_BITS)
        if found is None:
            counts = rows.groupBy(*keys, prefix.alias("_prefix")).agg(F.sum("_n").alias("_size"))
            counts = counts.withColumn("_total", F.sum("_size").over(Window.partitionBy(*keys)))
            each = F.posexplode(F.array(*[F.lit(float(p)) for p in probabilities]))
            counts = counts.select(*keys, "_prefix", "_size", "_total", each.alias("_which", "_p")).select(
                *keys,
                "_which",
                F.greatest(F.ceil(F.col("_total") * F.col("_p")), F.lit(1)).alias("_rank"),
                F.lit(0).cast("bigint").alias("_before"),
                "_prefix",
                "_size",
            )
        else:
            above = F.shiftright("_bits", (digit + 1) * DIGIT_BITS)
            counts = (
                _with_found(rows.withColumn("_above", above), found.withColumnRenamed("_prefix", "_above"), keys, "_above")
                .groupBy(*keys, *asked, prefix.alias("_prefix"))
                .agg(F.sum("_n").alias("_size"))
            )
        upto = F.col("_before") + F.sum("_size").over(Window.partitionBy(*keys, "_which").orderBy("_prefix"))
        found = (
            counts.withColumn("_upto", upto)
            .filter(F.col("_rank").between(F.col("_upto") - F.col("_size") + 1, F.col("_upto")))
            .select(*keys, "_which", "_rank", (F.col("_upto") - F.col("_size")).alias("_before"), "_prefix")
        )
    # Values of equal bits: one, unless decimals were rounded to doubles.
    last = (
        _with_found(rows, found.withColumnRenamed("_prefix", "_bits"), keys, "_bits")
        .groupBy(*keys, *asked, "_value").agg(F.sum("_n").alias("_n"))
    )
    within = Window.partitionBy(*keys, "_which").orderBy("_value")
    reached = F.col("_before") + F.sum("_n").over(within) >= F.col("_rank")
    picks = [
        F.min(F.when((F.col("_which") == i) & F.col("_reached"), F.col("_value")))
        for i in range(len(probabilities))
    ]
    return (
        last.withColumn("_reached", reached)
        .groupBy(*keys)
        .agg(F.array(*picks).alias("quantiles"))
    )


def _with_found(rows: DataFrame, found: DataFrame, keys: list[str], digits: str) -> DataFrame:
    """Rows that share the digits found so far, once for each probability that has them."""
    # Without groups there is one row per probability, so the filter is part of the scan.
    return _join_groups(rows, found if keys else F.broadcast(found), [*keys, digits])


def quantile_ranks(
    df: DataFrame,
    column: str,
    estimates: DataFrame,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Where estimated quantiles stand: (by, probability, n, lowest_rank, highest_rank).

    ``estimates`` has the array ``quantiles`` per group, or one row without groups. The
    ranks from lowest to highest hold the estimate's value; a value that no row has gives
    a highest rank below the lowest. Counted on the map side; groups without values give
    no row.
    """
    keys = list(by)
    rows = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).alias("_value"))
    if keys:
        rows = _join_groups(rows, estimates.select(*keys, "quantiles"), keys)
    else:
        rows = rows.withColumn("quantiles", estimates.select("quantiles").scalar())
    places = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.count_if(F.col("_value") < F.col("quantiles")[i]).alias("_below"),
            F.count_if(F.col("_value") <= F.col("quantiles")[i]).alias("_upto"),
        )
        for i, p in enumerate(probabilities)
    ]
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.array(*places).alias("_places"))
        .filter("n > 0")
        .select(*keys, "n", F.inline("_places"))
        .select(
            *keys,
            "probability",
            "n",
            (F.col("_below") + 1).alias("lowest_rank"),
            F.col("_upto").alias("highest_rank"),
        )
    )


def within_error(relative_error: float) -> Column:
    """Is a row of ``quantile_ranks`` within Spark's documented bound for its sketches,
    ``floor((p - error) * n) <= rank <= ceil((p + error) * n)``?"""
    p, n = F.col("probability"), F.col("n")
    return (F.col("highest_rank") >= F.floor((p - relative_error) * n)) & (
        F.col("lowest_rank") <= F.ceil((p + relative_error) * n)
    )


def flag_outliers(
    df: DataFrame,
    column: str,
    multiplier: float = 1.5,
    flag: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Flag values outside ``[Q1 - k*IQR, Q3 + k*IQR]``; an empty column has no outliers.

    The fences are a scalar subquery: one value sent to the tasks, no join and no
    round trip through the driver program.
    """
    quartiles = (exact_quantiles if exact else approx_quantiles)(df, column, [0.25, 0.75])
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    reach = (q3 - q1) * F.lit(str(multiplier)).cast("decimal(10,4)")
    fences = quartiles.select(F.struct((q1 - reach).alias("low"), (q3 + reach).alias("high")))
    fence = fences.scalar()
    outside = (F.col(column) < fence["low"]) | (F.col(column) > fence["high"])
    return df.withColumn(flag or f"{column}_is_outlier", F.coalesce(outside, F.lit(False)))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the column's extremes; empty bins are left out."""
    present = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    extremes = present.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    edge = extremes.select(F.struct("low", "high")).scalar()
    placed = present.select("v", edge.alias("edge")).withColumn(
        "width", (F.col("edge.high") - F.col("edge.low")) / bins
    )
    position = F.floor(F.try_divide(F.col("v") - F.col("edge.low"), F.col("width")))
    number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        placed.groupBy(number.alias("bin"), "edge", "width")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (F.col("edge.low") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("edge.low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "count",
        )
        .orderBy("bin")
    )


def box_plot(df: DataFrame, column: str, by: str, exact: bool = False) -> DataFrame:
    """Five-number summary of ``column`` per ``by``."""
    quartiles = [0.25, 0.5, 0.75]
    values = df.filter(F.col(column).isNotNull())
    if not exact:
        summary = values.groupBy(by).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(column).alias("minimum"),
            F.max(column).alias("maximum"),
            F.percentile_approx(column, quartiles, 1000).alias("quantiles"),
        )
    else:
        extremes = values.groupBy(by).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(column).alias("minimum"),
            F.max(column).alias("maximum"),
        )
        summary = _join_groups(extremes, exact_quantiles(values, column, quartiles, [by]), [by])
    return summary.select(
        by, "n", "minimum", *_named("quantiles", ("q1", "median", "q3")), "maximum"
    )


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on grouping keys, where null is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same).drop(*[f"_right_{k}" for k in keys])


def _named(array: str, names: Sequence[str]) -> list[Column]:
    return [F.col(array)[i].alias(name) for i, name in enumerate(names)]
