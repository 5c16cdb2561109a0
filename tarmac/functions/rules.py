"""Domain rules: keys, outcome flags, cancellation reasons, weather classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schemas import CANCELLATION_REASONS

LATE_MINUTES = 15
HEAVY_RAIN_MM = 2.5
STRONG_GUST_KMH = 50


def natural_key(*parts: Column) -> Column:
    """Parts joined by '|'; NULL parts are left out rather than kept as blanks."""
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def flag(number: Column) -> Column:
    """0/1 number to boolean; NULL counts as false."""
    return F.coalesce(number.cast("double"), F.lit(0.0)) == 1


def is_late(delay: Column, not_flown: Column) -> Column:
    """15 minutes or more behind schedule; NULL where the leg was not flown."""
    return F.when(~not_flown, delay >= LATE_MINUTES)


def cancellation_reason(code: Column) -> Column:
    return reduce(
        lambda case, item: case.when(code == item[0], item[1]), CANCELLATION_REASONS.items(), F
    )


def route_label(origin: Column, dest: Column) -> Column:
    """'AAA-BBB'; NULL when either end is unknown."""
    return F.concat(origin, F.lit("-"), dest)


def weather_class(snow: Column, rain: Column, gust: Column) -> Column:
    """First matching class: snow beats rain beats wind; unmeasured counts as calm."""
    return (
        F.when(snow > 0, "Snow")
        .when(rain >= HEAVY_RAIN_MM, "Heavy rain")
        .when(rain > 0, "Light rain")
        .when(gust >= STRONG_GUST_KMH, "Strong wind")
        .otherwise("Dry & calm")
    )
