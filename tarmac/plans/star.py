"""Flights matched to weather, the fact table and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import (
    cancellation_reason, date_key, hour_bucket, is_late, month_label, route_label, weather_class,
)
from tarmac.operators import both_ends, fits_broadcast, join_lookup
from tarmac.schemas import DELAY_CAUSES


def int_flights_weather(
    flights: DataFrame, weather: DataFrame, small_weather: bool | None = None
) -> DataFrame:
    """Every flight with the weather at its origin in the scheduled departure hour.

    ``small_weather`` is the measured answer to whether the hours fit a broadcast;
    left out, it is measured here.
    """
    if small_weather is None:
        small_weather = fits_broadcast(weather.select("airport_code", "weather_hour"))
    hours = weather.drop("wmo_weather_code").withColumnRenamed("airport_code", "_airport")
    matched = join_lookup(
        flights,
        hours,
        (F.col("origin") == F.col("_airport"))
        & (hour_bucket(F.col("scheduled_departure_at")) == F.col("weather_hour")),
        "left",
        small_weather,
    )
    found = F.col("weather_hour").isNotNull()
    label = weather_class(F.col("snowfall_cm"), F.col("precipitation_mm"), F.col("wind_gusts_kmh"))
    return matched.select(
        *flights.columns,
        "temperature_c",
        "precipitation_mm",
        "snowfall_cm",
        "wind_speed_kmh",
        "wind_gusts_kmh",
        "cloud_cover_pct",
        found.alias("has_weather"),
        F.when(found, label).alias("weather_condition"),
    )


def fct_flights(flights: DataFrame) -> DataFrame:
    """The fact table: outcomes, delay causes and origin weather per scheduled flight."""
    cancelled, diverted = F.col("is_cancelled"), F.col("is_diverted")
    return flights.select(
        "flight_id",
        "flight_date",
        date_key(F.col("flight_date")).alias("date_key"),
        "carrier_code",
        "flight_number",
        "tail_number",
        F.col("origin").alias("origin_code"),
        F.col("dest").alias("dest_code"),
        route_label(F.col("origin"), F.col("dest")).alias("route"),
        "scheduled_departure_at",
        "scheduled_dep_hour",
        "distance_miles",
        "is_cancelled",
        "is_diverted",
        cancellation_reason(F.col("cancellation_code")).alias("cancellation_reason"),
        (~cancelled & ~diverted).alias("is_completed"),
        is_late(F.col("arr_delay_min"), cancelled | diverted).alias("is_arr_delayed"),
        is_late(F.col("dep_delay_min"), cancelled).alias("is_dep_delayed"),
        "dep_delay_min",
        "arr_delay_min",
        "taxi_out_min",
        "taxi_in_min",
        "air_time_min",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in DELAY_CAUSES.values()],
        "has_weather",
        "weather_condition",
        "temperature_c",
        "precipitation_mm",
        "snowfall_cm",
        "wind_gusts_kmh",
    )


def describe_carriers(df: DataFrame, carriers: DataFrame) -> DataFrame:
    """Add name and type to rows with a ``carrier_code``; unknown codes describe themselves."""
    known = carriers.select(
        "carrier_code", F.col("carrier_name").alias("_name"), F.col("carrier_type").alias("_type")
    )
    return df.join(known, "carrier_code", "left").select(
        *df.columns,
        F.coalesce("_name", "carrier_code").alias("carrier_name"),
        F.coalesce("_type", F.lit("Other")).alias("carrier_type"),
    )


def dim_carrier(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """Every carrier code seen, a missing one included."""
    return describe_carriers(flights.select("carrier_code").distinct(), carriers)


def airports_seen(flights: DataFrame, *by: str) -> DataFrame:
    """One row per airport code at either end of a flight (and per ``by``), city and state."""
    kept = {c: c for c in by}
    ends = both_ends(
        flights,
        {**kept, "airport_code": "origin", "city_name": "origin_city", "state": "origin_state"},
        {**kept, "airport_code": "dest", "city_name": "dest_city", "state": "dest_state"},
    )
    return _one_per_airport(ends.distinct(), *by)


def _one_per_airport(ends: DataFrame, *by: str) -> DataFrame:
    """The smallest city and state: stable, and mergeable over months.

    Minima of text are aggregated by sorting, so flights are made distinct first: that
    hashes, and leaves a handful of rows per task to sort.
    """
    return ends.groupBy(*by, "airport_code").agg(
        F.min("city_name").alias("city_name"), F.min("state").alias("state")
    )


def finish_airports(seen: DataFrame, hubs: DataFrame) -> DataFrame:
    """Sightings of airports as the dimension; hubs get name and coordinates from the seed."""
    known = hubs.select(F.col("airport_code").alias("_hub"), "airport_name", "latitude", "longitude")
    one = _one_per_airport(seen)
    return one.join(known, F.col("airport_code") == F.col("_hub"), "left").select(
        "airport_code",
        F.coalesce("airport_name", "airport_code").alias("airport_name"),
        "city_name",
        "state",
        "latitude",
        "longitude",
        F.col("_hub").isNotNull().alias("is_hub"),
    )


def dim_airport(flights: DataFrame, hubs: DataFrame) -> DataFrame:
    """Every airport seen at either end of a flight."""
    return finish_airports(airports_seen(flights), hubs)


def dates_seen(flights: DataFrame, *by: str) -> DataFrame:
    return flights.groupBy(*by).agg(F.min("flight_date").alias("first"), F.max("flight_date").alias("last"))


def finish_dates(seen: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last day seen."""
    bounds = seen.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date"))
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_short"),
        month_label(day).alias("year_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def dim_date(flights: DataFrame) -> DataFrame:
    return finish_dates(dates_seen(flights))
