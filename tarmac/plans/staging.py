"""Silver: typed, de-duplicated flights and hourly weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import (
    blank_to_null, flag, half_even_int, hhmm_hour, hhmm_minute, natural_key, normal_code, wall_clock,
)
from tarmac.operators import fingerprint, latest_by, latest_where_repeated

_CLOCK = ["crs_dep_time", "dep_time", "crs_arr_time", "arr_time"]
_MEASURES = {
    "dep_delay": "dep_delay_min",
    "arr_delay": "arr_delay_min",
    "taxi_out": "taxi_out_min",
    "taxi_in": "taxi_in_min",
    "crs_elapsed_time": "scheduled_duration_min",
    "actual_elapsed_time": "actual_duration_min",
    "air_time": "air_time_min",
    "distance": "distance_miles",
}
_CAUSES = [f"{cause}_delay" for cause in ("carrier", "weather", "nas", "security", "late_aircraft")]


def typed_flights(bronze: DataFrame) -> DataFrame:
    """Bronze columns under their silver names, types and units, dated rows only."""
    return bronze.select(
        F.col("flight_date").cast("date").alias("flight_date"),
        normal_code(F.col("carrier_code")).alias("carrier_code"),
        F.trim("flight_number").alias("flight_number"),
        blank_to_null(F.col("tail_number")).alias("tail_number"),
        normal_code(F.col("origin")).alias("origin"),
        "origin_city",
        "origin_state",
        normal_code(F.col("dest")).alias("dest"),
        "dest_city",
        "dest_state",
        *[F.col(c).cast("int").alias(c) for c in _CLOCK],
        *[F.col(c).cast("double").alias(out) for c, out in _MEASURES.items()],
        flag(F.col("cancelled")).alias("is_cancelled"),
        flag(F.col("diverted")).alias("is_diverted"),
        blank_to_null(F.col("cancellation_code")).alias("cancellation_code"),
        *[F.col(c).cast("double").alias(f"{c}_min") for c in _CAUSES],
        "_ingested_at",
    ).filter(F.col("flight_date").isNotNull())


def stg_flights(bronze: DataFrame) -> DataFrame:
    """One row per flight: of rows with the same natural key the latest ingested stays.

    The key is partitioned on as text, next to the flight date it starts with: equal
    texts are equal ids, date filters reach the scan, and the digest is computed for
    the surviving rows only. Few flights come twice, so only those are brought together.
    """
    typed = typed_flights(bronze)
    key = natural_key(
        *[F.col(c) for c in ("flight_date", "carrier_code", "flight_number", "origin", "dest", "crs_dep_time")]
    )
    keyed = typed.withColumn("_tie", fingerprint(typed)).withColumn("_key", key)
    kept = latest_where_repeated(
        keyed, ["flight_date", "_key"], [F.desc_nulls_last("_ingested_at"), F.desc("_tie")]
    )
    hour, minute = hhmm_hour(F.col("crs_dep_time")), hhmm_minute(F.col("crs_dep_time"))
    return kept.select(
        *typed.columns,
        hour.alias("scheduled_dep_hour"),
        wall_clock(F.col("flight_date"), hour, minute).alias("scheduled_departure_at"),
        F.md5(F.col("_key")).alias("flight_id"),
    )


def stg_weather(bronze: DataFrame, ties: Sequence[Column] = ()) -> DataFrame:
    """One row per airport and local hour, the latest ingested.

    Duplicates are found on the raw code; the output code is upper-cased.
    """
    keyed = bronze.withColumn("_tie_hash", fingerprint(bronze))
    kept = latest_by(
        keyed,
        ["airport_code", "weather_time"],
        [F.desc_nulls_last("_ingested_at"), *ties, F.desc("_tie_hash")],
    )
    return kept.select(
        F.upper("airport_code").alias("airport_code"),
        F.col("weather_time").cast("timestamp_ntz").alias("weather_hour"),
        F.col("temperature_2m").cast("double").alias("temperature_c"),
        F.col("precipitation").cast("double").alias("precipitation_mm"),
        F.col("snowfall").cast("double").alias("snowfall_cm"),
        F.col("wind_speed_10m").cast("double").alias("wind_speed_kmh"),
        F.col("wind_gusts_10m").cast("double").alias("wind_gusts_kmh"),
        F.col("cloud_cover").cast("double").alias("cloud_cover_pct"),
        half_even_int(F.col("weather_code")).alias("wmo_weather_code"),
    )
