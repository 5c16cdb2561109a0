"""Aggregate shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_total_level(
    partials: DataFrame, over: str, by: Sequence[str], label: str, aggregates: Sequence[Column]
) -> DataFrame:
    """Aggregate per (``over``, ``by``) and once more over all of ``over``.

    The total rows carry ``label``; they are told apart by the grouping bit, so a
    NULL in ``over`` stays a group of its own. Meant for mergeable partial
    aggregates: the doubling of rows then happens on a few groups, not on facts.
    """
    rolled = partials.groupingSets(
        [[F.col(over), *map(F.col, by)], [F.col(c) for c in by]], F.col(over), *map(F.col, by)
    ).agg(F.grouping(over).alias("_total"), *aggregates)
    return rolled.withColumn(
        over, F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(over))
    ).drop("_total")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: mean of ``value`` weighted by ``weight``.

    Missing values leave the numerator only, and an empty numerator is 0.
    """
    return F.coalesce(F.sum(value * weight), F.lit(0.0)) / F.sum(weight)
