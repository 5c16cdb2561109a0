"""Serving queries: what the dashboard computes from the marts.

Each takes marts (and the selected month, ``yyyy-MM``) and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import rounded_even
from tarmac.operators import (
    at_least_median, bottom_k, change_from_previous, in_order, pivot_fixed, top_k, weighted_mean,
)
from tarmac.schemas import ALL_HUBS, WEATHER_CLASSES

KPI_CARDS = ["flights", "on_time_pct", "avg_arr_delay_min", "cancellation_pct", "total_delay_hours"]


def of_month(mart: DataFrame, month: str) -> DataFrame:
    return mart.filter(F.col("year_month") == month)


def facts_of_month(facts: DataFrame, month: str) -> DataFrame:
    """Facts of one month as a date range, which reaches the scan.

    A month-keyed mart of these facts equals that month of the whole mart.
    """
    first = F.to_date(F.lit(f"{month}-01"))
    return facts.filter((F.col("flight_date") >= first) & (F.col("flight_date") < F.add_months(first, 1)))


def header(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.sum("flights").alias("total_flights"),
        F.min("year_month").alias("first_month"),
        F.max("year_month").alias("last_month"),
    )


def kpi_cards(kpis: DataFrame, month: str) -> DataFrame:
    """One row per card: value and change from the previous available month."""
    cards = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("value"),
            F.col(f"_{name}").cast("double").alias("delta"),
        )
        for name in KPI_CARDS
    ]
    changes = {f"_{name}": change_from_previous(name, "year_month") for name in KPI_CARDS}
    return of_month(kpis.withColumns(changes), month).select(F.inline(F.array(*cards)))


def monthly_punctuality(kpis: DataFrame) -> DataFrame:
    return kpis.select("year_month", "flights", "on_time_pct").orderBy("year_month")


def delay_cause_shares(causes: DataFrame) -> DataFrame:
    return causes.select("year_month", "cause", "share_pct").orderBy("year_month", "cause")


def hourly_delays(profile: DataFrame) -> DataFrame:
    return profile.select("scheduled_dep_hour", "dep_delay_pct").orderBy(
        F.asc_nulls_last("scheduled_dep_hour")
    )


def airline_ranking(carriers: DataFrame, month: str) -> DataFrame:
    return of_month(carriers, month).select(
        "on_time_rank", "carrier_name", "carrier_type", "flights", "on_time_pct",
        "avg_arr_delay_min", "cancellation_pct",
    ).orderBy("on_time_rank", "carrier_name")


def hub_month(airport_daily: DataFrame, month: str) -> DataFrame:
    """Daily hub rows of a month rolled up, daily rates weighted by departures."""
    days = facts_of_month(airport_daily, month).filter("is_hub")
    return days.groupBy("airport_code", "airport_name", "city_name", "latitude", "longitude", "is_hub").agg(
        F.sum("departures").alias("departures"),
        weighted_mean(F.col("dep_delay_pct"), F.col("departures")).alias("dep_delay_pct"),
        weighted_mean(F.col("cancellation_pct"), F.col("departures")).alias("cancellation_pct"),
    )


def _hub_table(hubs: DataFrame) -> DataFrame:
    return hubs.select(
        "airport_code", "city_name", "departures", rounded_even(F.col("dep_delay_pct"), 1).alias("dep_delay_pct")
    )


def most_delayed_hubs(hubs: DataFrame, k: int = 10) -> DataFrame:
    return _hub_table(top_k(hubs, "dep_delay_pct", "airport_code", k))


def most_punctual_hubs(hubs: DataFrame, k: int = 10) -> DataFrame:
    return _hub_table(bottom_k(hubs, "dep_delay_pct", "airport_code", k))


def _all_hubs(impact: DataFrame) -> DataFrame:
    return impact.filter(F.col("airport_code") == ALL_HUBS)


def all_hubs_by_weather(impact: DataFrame) -> DataFrame:
    return in_order(_all_hubs(impact), "weather_condition", WEATHER_CLASSES)


def weather_headline(impact: DataFrame) -> DataFrame:
    """Calm baseline next to the worst class; no row without a baseline.

    Of equally bad classes the later one in the fixed order is taken.
    """
    calm = F.col("weather_condition") == WEATHER_CLASSES[0]
    place = F.array_position(F.array(*[F.lit(c) for c in WEATHER_CLASSES]), F.col("weather_condition"))
    row = F.struct("weather_condition", "dep_delay_pct", "delay_uplift_pp", "cancellation_pct")
    best = _all_hubs(impact).filter(F.col("weather_condition").isin(WEATHER_CLASSES)).agg(
        F.count_if(calm).alias("_baselines"),
        F.max(F.when(calm, F.col("dep_delay_pct"))).alias("baseline_pct"),
        F.max_by(row, F.struct("dep_delay_pct", place)).alias("worst"),
    )
    return best.filter(F.col("_baselines") > 0).select(
        "baseline_pct",
        F.col("worst.weather_condition").alias("worst_condition"),
        F.col("worst.dep_delay_pct").alias("worst_pct"),
        F.col("worst.delay_uplift_pp").alias("worst_uplift_pp"),
        F.col("worst.cancellation_pct").alias("worst_cancellation_pct"),
    )


def uplift_matrix(impact: DataFrame) -> DataFrame:
    """Hub by weather class, calm left out; worst first in the first class that occurs."""
    classes = WEATHER_CLASSES[1:]
    cells = impact.filter(
        (F.col("airport_code") != ALL_HUBS)
        & F.col("weather_condition").isin(classes)
        & F.col("delay_uplift_pp").isNotNull()
    )
    matrix = pivot_fixed(cells, "airport_code", "weather_condition", classes, F.avg("delay_uplift_pp"))
    return matrix.orderBy(*[F.desc_nulls_last(f"`{c}`") for c in classes], "airport_code")


def busiest_routes(routes: DataFrame, month: str, k: int = 15) -> DataFrame:
    return top_k(
        of_month(routes, month).select("route", "flights", "on_time_pct"), "flights", "route", k
    )


def least_punctual_busy_routes(routes: DataFrame, month: str, k: int = 15) -> DataFrame:
    """Among the routes of the month with at least the median number of flights."""
    busy = at_least_median(of_month(routes, month), "flights", ["year_month"])
    return bottom_k(busy.select("route", "flights", "on_time_pct"), "on_time_pct", "route", k)
