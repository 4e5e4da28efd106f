"""Data-quality measures. Every table is measured in one aggregation pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.cleaners import EMAIL_PATTERN
from orderlake.functions.numeric import count_when, percent


def is_empty(df: DataFrame, name: str) -> Column:
    """Null, or an empty text. Other types are compared with null only."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def completeness_score(
    df: DataFrame, required: Sequence[str], score: str = "data_quality_score"
) -> DataFrame:
    """Share of the required fields that are filled, 0 to 100, per row."""
    filled = reduce(Column.__add__, [(~is_empty(df, c)).cast("int") for c in required])
    return df.withColumn(score, F.round(filled * 100 / len(required), 2))


def null_counts(df: DataFrame, empty_text: bool = False) -> DataFrame:
    """(column_name, null_count), from one pass over the table."""
    counts = df.agg(
        *[
            count_when(is_empty(df, c) if empty_text else F.col(f"`{c}`").isNull()).alias(c)
            for c in df.columns
        ]
    )
    return counts.unpivot([], df.columns, "column_name", "null_count")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row. Partial counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def date_range(df: DataFrame, column: str) -> DataFrame:
    """Earliest and latest value of a parsed date column."""
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def valid_ratio(df: DataFrame, column: str = "is_valid_order") -> DataFrame:
    """Rows, rows passing a 0/1 flag, and their share in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_when(F.col(column) == 1).alias("valid_rows"),
    ).withColumn("valid_percent", percent(F.col("valid_rows"), F.col("total_rows")))


def table_report(df: DataFrame, table: str, key: str, exact_keys: bool = True) -> DataFrame:
    """Column-wise nulls of a table, with its size, duplicates and completeness.

    One row per column, all from a single aggregation. The exact distinct count of
    ``key`` collapses copies on the map side but still shuffles each key once;
    ``exact_keys=False`` estimates it from sketches instead.
    """
    return _measured(df, table, key, exact_keys).select(*TABLE_COLUMNS, F.inline("_details"))


def _measured(df: DataFrame, table: str, key: str, exact_keys: bool) -> DataFrame:
    """The table's line, with an array of its columns' figures."""
    count_keys = F.count_distinct if exact_keys else F.approx_count_distinct
    n = F.col("total_rows")
    names = df.columns
    measured = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_keys(F.col(key)).alias("_distinct"),
        count_when(F.col(key).isNull()).alias("_null_keys"),
        *[count_when(is_empty(df, c)).alias(f"_empty_{i}") for i, c in enumerate(names)],
    )
    null_percent = [
        F.coalesce(percent(F.col(f"_empty_{i}"), n), F.lit(0)) for i in range(len(names))
    ]
    complete = reduce(Column.__add__, [100 - p for p in null_percent]) / len(names)
    # Null counts as one more key.
    distinct_keys = F.col("_distinct") + (F.col("_null_keys") > 0).cast("bigint")
    details = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_empty_{i}").alias("null_count"),
                null_percent[i].alias("null_percent"),
            )
            for i, c in enumerate(names)
        ]
    )
    return measured.select(
        F.lit(table).alias("table_name"),
        "total_rows",
        F.lit(len(names)).alias("total_columns"),
        (n - distinct_keys).alias("duplicate_rows"),
        F.round(complete, 2).alias("completeness_score"),
        details.alias("_details"),
    )


TABLE_COLUMNS = (
    "table_name",
    "total_rows",
    "total_columns",
    "duplicate_rows",
    "completeness_score",
)


def table_summary(df: DataFrame, table: str, key: str, exact_keys: bool = True) -> DataFrame:
    """The table's line of the quality report, without the column details."""
    return _measured(df, table, key, exact_keys).select(*TABLE_COLUMNS)


def quality_summary(
    tables: Mapping[str, tuple[DataFrame, str]], exact_keys: bool = True
) -> DataFrame:
    """One line per table; ``tables`` maps a name to (frame, key column)."""
    return reduce(
        DataFrame.unionByName,
        [table_summary(df, name, key, exact_keys) for name, (df, key) in tables.items()],
    )


def quality_totals(summary: DataFrame, invalid_rows: DataFrame) -> DataFrame:
    """Headline figures over the summary; ``invalid_rows`` is (table_name, invalid_records)."""
    scored = summary.join(invalid_rows, "table_name", "left")
    return scored.agg(
        F.sum("total_rows").alias("total_records"),
        F.round(F.avg("completeness_score"), 2).alias("avg_completeness"),
        F.sum("duplicate_rows").alias("total_duplicates"),
        F.sum(F.coalesce("invalid_records", F.lit(0))).alias("total_invalid"),
    )


def invalid_counts(rules: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(table_name, invalid_records); ``rules`` maps a table to (frame, invalid condition)."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(count_when(bad).alias("invalid_records")).select(
                F.lit(name).alias("table_name"), "invalid_records"
            )
            for name, (df, bad) in rules.items()
        ],
    )


def cleaning_impact(
    orders: DataFrame, customers: DataFrame, items: DataFrame
) -> DataFrame:
    """Figures before and after cleaning, computed from the cleaned frames.

    The frames still hold the raw columns, so both sides come from one pass each.
    """
    iso_date = F.col("order_date").rlike(r"^\d{4}-\d{2}-\d{2}$") & F.col(
        "order_date"
    ).try_cast("date").isNotNull()
    by_order = orders.agg(
        F.count(F.lit(1)).alias("b_orders"),
        F.count(F.lit(1)).alias("a_orders"),
        count_when(
            iso_date & F.col("customer_id").isNotNull() & (F.col("total_amount") > 0)
        ).alias("b_valid"),
        count_when(F.col("is_valid_order") == 1).alias("a_valid"),
        count_when(iso_date).alias("b_dates"),
        count_when(F.col("order_date_cleaned").isNotNull()).alias("a_dates"),
    )
    by_customer = customers.agg(
        count_when(F.col("email").rlike(EMAIL_PATTERN)).alias("b_emails"),
        count_when(F.col("email_cleaned").isNotNull()).alias("a_emails"),
        count_when(F.col("name").isNotNull() & F.col("segment").isNotNull()).alias("b_complete"),
        count_when(F.col("data_quality_score") == 100).alias("a_complete"),
    )
    by_item = items.agg(
        count_when(~F.col("calculation_matches")).alias("b_calc"),
        count_when(F.col("line_total_calculated").isNull()).alias("a_calc"),
    )

    def long(measured: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
        rows = [
            F.struct(
                F.lit(label).alias("metric"),
                F.col(f"b_{m}").alias("before_cleaning"),
                F.col(f"a_{m}").alias("after_cleaning"),
            )
            for m, label in metrics.items()
        ]
        return measured.select(F.inline(F.array(*rows)))

    return (
        long(
            by_order,
            {"orders": "Total Orders", "valid": "Valid Orders", "dates": "Consistent Date Formats"},
        )
        .unionByName(
            long(
                by_customer,
                {"complete": "Complete Customer Records", "emails": "Valid Email Addresses"},
            )
        )
        .unionByName(long(by_item, {"calc": "Price Calculation Errors"}))
        .withColumn(
            "improvement_percent",
            percent(F.col("after_cleaning") - F.col("before_cleaning"), F.col("before_cleaning")),
        )
    )


def split_malformed(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """(rows that were read whole, the texts of lines that were not).

    A frame without the corrupt-record column has no malformed lines.
    """
    if corrupt not in df.columns:
        return df, df.select(F.lit(None).cast("string").alias("line")).filter(F.lit(False))
    return (
        df.filter(F.col(corrupt).isNull()).drop(corrupt),
        df.filter(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line")),
    )


def line_reconciliation(
    tables: Mapping[str, tuple[DataFrame, DataFrame]], corrupt: str
) -> DataFrame:
    """One line per table: records in the source, rows in bronze, and how many were malformed.

    ``tables`` maps a name to (one row with ``lines`` of the source, the bronze table).
    """

    def line(name: str, lines: DataFrame, bronze: DataFrame) -> DataFrame:
        bad = F.col(corrupt).isNotNull() if corrupt in bronze.columns else F.lit(False)
        return bronze.agg(
            F.count(F.lit(1)).alias("bronze_rows"), count_when(bad).alias("malformed_rows")
        ).select(
            F.lit(name).alias("table_name"),
            lines.select("lines").scalar().alias("source_lines"),
            "bronze_rows",
            "malformed_rows",
        )

    counted = reduce(
        DataFrame.unionByName, [line(n, lines, bronze) for n, (lines, bronze) in tables.items()]
    )
    return counted.withColumns(
        {
            "loaded_rows": F.col("bronze_rows") - F.col("malformed_rows"),
            "is_complete": F.col("source_lines") == F.col("bronze_rows"),
        }
    )


def split_valid(
    df: DataFrame, rules: Mapping[str, Column], reasons: str = "quarantine_reasons"
) -> tuple[DataFrame, DataFrame]:
    """(rows meeting every rule, other rows with the names of the rules they break)."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()])
    )
    judged = df.withColumn(reasons, broken)
    return (
        judged.filter(F.size(reasons) == 0).drop(reasons),
        judged.filter(F.size(reasons) > 0),
    )


def order_rules() -> dict[str, Column]:
    """Rules an order from ``clean_orders`` must meet to be loaded."""
    return {
        "missing_order_id": F.col("order_id").isNotNull(),
        "missing_customer_id": F.col("customer_id").isNotNull(),
        "bad_order_date": F.col("order_date_cleaned").isNotNull(),
        "bad_total_amount": F.col("total_amount_cleaned") > 0,
        "unknown_status": F.col("status_cleaned") != "unknown",
    }
