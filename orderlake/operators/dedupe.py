"""Duplicate handling that does not gather a key's copies in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], flag: str = "is_duplicate"
) -> DataFrame:
    """Mark every row but the first of its key, "first" in the order of all columns.

    A key may hold a large share of the table, so rows are first ranked among
    those of the same key *and the same input split*; only each split's first row
    can be the overall first. The second ranking compares just those, at most one
    per key and split, while the other rows stay in their small groups.
    """
    columns = df.columns
    by_split = Window.partitionBy(*keys, "_split").orderBy(*columns)
    heats = Window.partitionBy(*keys, "_heat").orderBy(*columns, "_split")
    return (
        df.withColumn("_split", F.spark_partition_id())
        .withColumn("_first_here", F.row_number().over(by_split) == 1)
        .withColumn("_heat", F.when(F.col("_first_here"), F.lit(-1)).otherwise(F.col("_split")))
        .withColumn(flag, ~(F.col("_first_here") & (F.row_number().over(heats) == 1)))
        .drop("_split", "_first_here", "_heat")
    )


def drop_duplicates_by_key(
    df: DataFrame, keys: Sequence[str], keep_unkeyed: bool = False
) -> DataFrame:
    """Keep the row ``flag_duplicates`` leaves unmarked.

    The least row per key is an aggregate: each map task sends one row per key. A null
    in the key is a value like any other, so all rows without a key become one;
    ``keep_unkeyed`` keeps each row that has a null in its key, without a shuffle.
    """
    if keep_unkeyed:
        keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
        return drop_duplicates_by_key(df.filter(keyed), keys).unionByName(df.filter(~keyed))
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])
    )
