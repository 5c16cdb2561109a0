"""Data-quality checks: each returns the violating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once, with their count; NULL keys are ignored."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    counted = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > 1)


def outside_values(column: str, values: Sequence) -> Column:
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is not in the list; NULL passes."""
    return df.filter(outside_values(column, values))


def outside_range(column: str, low=None, high=None) -> Column:
    value = F.col(column)
    below = value < low if low is not None else F.lit(False)
    above = value > high if high is not None else F.lit(False)
    return F.coalesce(below | above, F.lit(False))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside the inclusive bounds; NULL passes and either bound may be left out."""
    return df.filter(outside_range(column, low, high))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, with the number of child rows.

    Child keys are counted before the join, so a hot key travels as one row.
    """
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return keys.join(parents, F.col(key) == F.col("_parent"), "left_anti")


def same_row_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both counts where they differ, none where they agree."""
    rows = F.count(F.lit(1))
    a = left.agg(rows.alias("left_rows"), F.lit(None).cast("long").alias("right_rows"))
    b = right.agg(F.lit(None).cast("long").alias("left_rows"), rows.alias("right_rows"))
    both = a.unionByName(b).agg(F.max("left_rows").alias("left_rows"), F.max("right_rows").alias("right_rows"))
    return both.filter(F.col("left_rows") != F.col("right_rows"))


def summary(df: DataFrame, violation: Column) -> DataFrame:
    """Rows looked at and rows in violation, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(violation, F.lit(False))).alias("violations"),
    )
