"""Window shapes over aggregated results, and top-k.

The windows here are for marts and other grouped results, whose partitions are
bounded by the number of groups. Raw facts go through ``latest_by`` only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.numbers import rounded


def rank_desc(value: str, within: Sequence[str]) -> Column:
    """Rank with gaps, largest first."""
    return F.rank().over(Window.partitionBy(*within).orderBy(F.desc_nulls_last(value))).cast("long")


def share_of_total(value: str, within: Sequence[str]) -> Column:
    """Percent of the partition's total; NULL where the total is zero."""
    total = F.sum(value).over(Window.partitionBy(*within))
    return rounded(F.col(value) * 100 / F.nullif(total, F.lit(0.0)), 2)


def uplift_over(value: str, baseline: Column, within: Sequence[str]) -> Column:
    """Difference to the partition's baseline row; NULL where there is none."""
    base = F.max(F.when(baseline, F.col(value))).over(Window.partitionBy(*within))
    return rounded(F.col(value) - base, 2)


def change_from_previous(value: str, order: str) -> Column:
    """Change from the previous available row (one row per period, few periods)."""
    window = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last(order))
    return F.col(value) - F.lag(value).over(window)


def at_least_median(df: DataFrame, value: str, within: Sequence[str]) -> DataFrame:
    """Rows at or above the exact, interpolated median of their partition.

    The median is an aggregate, combined by value before the shuffle, and joined back as a row
    per partition; no partition is sorted in one task.
    """
    medians = df.groupBy(*[F.col(c).alias(f"_{c}") for c in within]).agg(
        F.percentile(value, F.lit(0.5)).alias("_median"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in within])
    return df.join(medians, same & (F.col(value) >= F.col("_median")), "left_semi")


def top_k(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(tie)).limit(k)


def bottom_k(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(value), F.asc_nulls_last(tie)).limit(k)


def in_order(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Rows sorted by a fixed category order; other categories are left out."""
    position = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column))
    return df.filter(F.col(column).isin(list(order))).orderBy(position)
