"""Rounding and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, places: int) -> Column:
    """Half-away-from-zero rounding of the scaled binary value.

    ``F.round(x, places)`` rounds the shortest decimal text of the double, which
    lifts 1.005 to 1.01; scaling first gives 1.0.
    """
    if places == 0:
        return F.round(x, 0)
    scale = F.lit(10.0**places)
    return F.round(x * scale, 0) / scale


def rounded_even(x: Column, places: int) -> Column:
    """Half-to-even rounding of the scaled binary value (the dashboard tables use it)."""
    scale = F.lit(10.0**places)
    return F.rint(x * scale) / scale


def half_even_int(x: Column) -> Column:
    """Double to int, rounding halves to even where a plain cast would truncate."""
    return F.rint(x).cast("int")


def percent(flag_or_share: Column) -> Column:
    """Aggregate: share of true (or of 1) among non-null values, in percent, two decimals."""
    return rounded(F.avg(flag_or_share.cast("int")) * 100, 2)


def hours(minutes: Column) -> Column:
    """Aggregate: total minutes as whole hours."""
    return rounded(F.sum(minutes) / 60, 0)
