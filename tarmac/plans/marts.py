"""Gold: the seven analytics marts.

Every mart is one partial aggregation, one shuffle of groups and small work after
it. Months are grouped as dates and labelled once per group. Dimensions join the
groups, never the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import hours, month_label, month_start, percent, rounded
from tarmac.operators import rank_desc, share_of_total, unpivot_named, uplift_over, with_total_level
from tarmac.plans.star import describe_carriers
from tarmac.schemas import ALL_HUBS, DELAY_CAUSES, WEATHER_CLASSES

MIN_ROUTE_FLIGHTS = 30


def _rows() -> Column:
    return F.count(F.lit(1))


def _on_time() -> Column:
    """Completed flights with an unknown arrival delay stay out of the share."""
    return percent(F.when(F.col("is_completed"), 1 - F.col("is_arr_delayed").cast("int")))


def _mean_arrival() -> Column:
    return rounded(F.avg(F.when(F.col("is_completed"), F.col("arr_delay_min"))), 2)


def _cancelled() -> Column:
    return percent(F.col("is_cancelled"))


def _by_month(facts: DataFrame) -> DataFrame:
    return facts.withColumn("_month", month_start(F.col("flight_date")))


def _label() -> Column:
    return month_label(F.col("_month")).alias("year_month")


def labelled(months: DataFrame) -> DataFrame:
    """Groups keyed by the first of the month under their 'yyyy-MM' label."""
    return months.select(_label(), *[c for c in months.columns if c != "_month"])


def kpi_months(facts: DataFrame) -> DataFrame:
    causes = sum((F.col(c) for c in list(DELAY_CAUSES.values())[1:]), F.col("carrier_delay_min"))
    return _by_month(facts).groupBy("_month").agg(
        _rows().alias("flights"),
        _on_time().alias("on_time_pct"),
        _mean_arrival().alias("avg_arr_delay_min"),
        _cancelled().alias("cancellation_pct"),
        percent(F.col("is_diverted")).alias("diversion_pct"),
        hours(causes).alias("total_delay_hours"),
    )


def mart_kpis_monthly(facts: DataFrame) -> DataFrame:
    return labelled(kpi_months(facts))


def carrier_months(facts: DataFrame) -> DataFrame:
    """Measures per month and carrier code; rows without a code are left out."""
    return _by_month(facts).filter(F.col("carrier_code").isNotNull()).groupBy("_month", "carrier_code").agg(
        _rows().alias("flights"),
        _on_time().alias("on_time_pct"),
        _mean_arrival().alias("avg_arr_delay_min"),
        _cancelled().alias("cancellation_pct"),
        hours(F.col("carrier_delay_min")).alias("carrier_delay_hours"),
        hours(F.col("late_aircraft_delay_min")).alias("late_aircraft_delay_hours"),
    )


def finish_carriers(months: DataFrame, carriers: DataFrame) -> DataFrame:
    """Names, types and the ranking within each month.

    The carrier dimension holds every code of the same flights, so joining it is
    the same as describing the groups from the seed.
    """
    return describe_carriers(months, carriers).select(
        _label(),
        "carrier_code",
        "carrier_name",
        "carrier_type",
        *months.columns[2:],
        rank_desc("on_time_pct", ["_month"]).alias("on_time_rank"),
    )


def mart_carrier_monthly(facts: DataFrame, carriers: DataFrame) -> DataFrame:
    return finish_carriers(carrier_months(facts), carriers)


def airport_days(facts: DataFrame) -> DataFrame:
    """Departures per day and origin; the weather maxima run over the hours flown."""
    return facts.filter(F.col("origin_code").isNotNull()).groupBy(
        "flight_date", F.col("origin_code").alias("airport_code")
    ).agg(
        _rows().alias("departures"),
        percent(F.col("is_dep_delayed")).alias("dep_delay_pct"),
        rounded(F.avg("dep_delay_min"), 2).alias("avg_dep_delay_min"),
        _cancelled().alias("cancellation_pct"),
        rounded(F.avg("taxi_out_min"), 2).alias("avg_taxi_out_min"),
        rounded(F.max("precipitation_mm"), 2).alias("max_hourly_precip_mm"),
        rounded(F.max("snowfall_cm"), 2).alias("max_hourly_snow_cm"),
        rounded(F.max("wind_gusts_kmh"), 1).alias("max_wind_gust_kmh"),
    )


def finish_airport_days(days: DataFrame, airports: DataFrame) -> DataFrame:
    return days.join(airports, "airport_code").select(
        "flight_date", "airport_code", *airports.columns[1:], *days.columns[2:]
    )


def mart_airport_daily(facts: DataFrame, airports: DataFrame) -> DataFrame:
    return finish_airport_days(airport_days(facts), airports)


def route_months(facts: DataFrame) -> DataFrame:
    return _by_month(facts).groupBy("_month", "route", "origin_code", "dest_code").agg(
        rounded(F.avg("distance_miles"), 0).alias("distance_miles"),
        _rows().alias("flights"),
        F.count_distinct("carrier_code").alias("carriers"),
        _on_time().alias("on_time_pct"),
        _mean_arrival().alias("avg_arr_delay_min"),
        _cancelled().alias("cancellation_pct"),
    )


def finish_routes(months: DataFrame) -> DataFrame:
    """Routes flown often enough in the month for their rates to mean something."""
    return labelled(months.filter(F.col("flights") >= MIN_ROUTE_FLIGHTS))


def mart_route_monthly(facts: DataFrame) -> DataFrame:
    return finish_routes(route_months(facts))


def cause_months(facts: DataFrame) -> DataFrame:
    return _by_month(facts).groupBy("_month").agg(*[F.sum(c).alias(c) for c in DELAY_CAUSES.values()])


def finish_causes(months: DataFrame) -> DataFrame:
    """Whole hours per cause, and its share of the month's unrounded minutes."""
    long = unpivot_named(months, ["_month"], DELAY_CAUSES, "cause", "_minutes")
    return long.select(
        _label(),
        "cause",
        rounded(F.col("_minutes") / 60, 0).alias("delay_hours"),
        share_of_total("_minutes", ["_month"]).alias("share_pct"),
    )


def mart_delay_causes_monthly(facts: DataFrame) -> DataFrame:
    return finish_causes(cause_months(facts))


def weather_impact_partials(facts: DataFrame) -> DataFrame:
    """Mergeable sums per month, hub and weather class.

    The two whole-period marts are finished from such sums, so a refresh adds one
    month without reading the others.
    """
    delayed = F.col("is_dep_delayed").cast("int")
    return _by_month(facts).filter("has_weather").groupBy(
        "_month", F.col("origin_code").alias("airport_code"), "weather_condition"
    ).agg(
        _rows().alias("departures"),
        F.sum(delayed).alias("late"),
        F.count(delayed).alias("late_known"),
        F.sum("dep_delay_min").alias("delay_sum"),
        F.count("dep_delay_min").alias("delay_known"),
        F.sum(F.col("is_cancelled").cast("int")).alias("cancelled"),
    )


def _ratio(part: str, whole: str) -> Column:
    """Mean from its sum and count; NULL where nothing was counted."""
    return F.sum(part).cast("double") / F.nullif(F.sum(whole), F.lit(0).cast("long"))


def finish_weather_impact(partials: DataFrame) -> DataFrame:
    by_condition = with_total_level(
        partials,
        over="airport_code",
        by=["weather_condition"],
        label=ALL_HUBS,
        aggregates=[
            F.sum("departures").alias("departures"),
            rounded(_ratio("late", "late_known") * 100, 2).alias("dep_delay_pct"),
            rounded(_ratio("delay_sum", "delay_known"), 2).alias("avg_dep_delay_min"),
            rounded(_ratio("cancelled", "departures") * 100, 2).alias("cancellation_pct"),
        ],
    )
    calm = F.col("weather_condition") == WEATHER_CLASSES[0]
    return by_condition.select(
        "*", uplift_over("dep_delay_pct", calm, ["airport_code"]).alias("delay_uplift_pp")
    )


def mart_weather_impact(facts: DataFrame) -> DataFrame:
    return finish_weather_impact(weather_impact_partials(facts))


def hourly_profile_partials(facts: DataFrame) -> DataFrame:
    """Mergeable sums per month and scheduled hour of the flights not cancelled."""
    delayed = F.col("is_dep_delayed").cast("int")
    return _by_month(facts).filter(~F.col("is_cancelled")).groupBy("_month", "scheduled_dep_hour").agg(
        _rows().alias("departures"),
        F.sum(delayed).alias("late"),
        F.count(delayed).alias("late_known"),
        F.sum("dep_delay_min").alias("delay_sum"),
        F.count("dep_delay_min").alias("delay_known"),
        F.count_if(F.col("late_aircraft_delay_min") > 0).alias("late_aircraft"),
    )


def finish_hourly_profile(partials: DataFrame) -> DataFrame:
    return partials.groupBy("scheduled_dep_hour").agg(
        F.sum("departures").alias("departures"),
        rounded(_ratio("late", "late_known") * 100, 2).alias("dep_delay_pct"),
        rounded(_ratio("delay_sum", "delay_known"), 2).alias("avg_dep_delay_min"),
        rounded(_ratio("late_aircraft", "departures") * 100, 2).alias("late_aircraft_pct"),
    )


def mart_hourly_profile(facts: DataFrame) -> DataFrame:
    return finish_hourly_profile(hourly_profile_partials(facts))
