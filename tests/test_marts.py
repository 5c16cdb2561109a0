from datetime import datetime

import pytest
from pyspark.sql import functions as F

from builders import flights, weather
from tarmac import functions as fn
from tarmac.plans import marts, serving, star
from tarmac.plans.staging import stg_flights, stg_weather
from tarmac.sources import seeds


def silver_of(spark, *changes, hours=()):
    numbered = [{"flight_number": str(i), **c} for i, c in enumerate(changes)]
    return star.int_flights_weather(
        stg_flights(flights(spark, *numbered)), stg_weather(weather(spark, *(hours or [{"airport_code": "NONE"}]))), True)


def facts_of(spark, *changes, hours=()):
    return star.fct_flights(silver_of(spark, *changes, hours=hours))


def test_rounding_follows_the_scaled_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.001,), (0.125,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(fn.rounded(F.col("x"), 2)).collect()]
    assert got == [1.0, 2.68, 0.0, 0.13, 2.5, None]
    assert [r[0] for r in df.select(fn.rounded_even(F.col("x") * 10, 0)).collect()][4] == 25.0


def test_on_time_share_leaves_out_what_did_not_arrive(spark):
    kpis = marts.mart_kpis_monthly(facts_of(
        spark,
        {"arr_delay": 0.0}, {"arr_delay": 20.0, "late_aircraft_delay": 90.0}, {"arr_delay": None},
        {"cancelled": 1.0, "arr_delay": None, "dep_delay": None}, {"diverted": 1.0, "arr_delay": None},
    )).first()
    assert (kpis.year_month, kpis.flights, kpis.on_time_pct) == ("2025-03", 5, 50.0)
    assert (kpis.avg_arr_delay_min, kpis.cancellation_pct, kpis.diversion_pct) == (10.0, 20.0, 20.0)
    assert kpis.total_delay_hours == 2.0


def test_unknown_and_missing_carriers(spark):
    facts = facts_of(spark, {"carrier_code": "AA"}, {"carrier_code": "X1"}, {"carrier_code": None})
    mart = {r.carrier_code: r for r in marts.mart_carrier_monthly(facts, seeds.carriers(spark)).collect()}
    assert set(mart) == {"AA", "X1"}
    assert (mart["AA"].carrier_name, mart["AA"].carrier_type) == ("American Airlines", "Network")
    assert (mart["X1"].carrier_name, mart["X1"].carrier_type) == ("X1", "Other")
    assert facts.count() == 3


def test_ranking_uses_rounded_rates_and_leaves_gaps(spark):
    codes = ["AA", "DL", "UA"]
    late = [{"carrier_code": c, "arr_delay": 60.0 if c == "UA" else 0.0} for c in codes]
    ranks = {r.carrier_code: r.on_time_rank
             for r in marts.mart_carrier_monthly(facts_of(spark, *late), seeds.carriers(spark)).collect()}
    assert ranks == {"AA": 1, "DL": 1, "UA": 3}


def test_routes_need_thirty_flights(spark):
    flown = [{"dest": "DFW", "carrier_code": "AA" if i % 2 else "DL"} for i in range(30)] + [{"dest": "BZN"}] * 29
    routes = marts.mart_route_monthly(facts_of(spark, *flown)).collect()
    assert [(r.route, r.flights, r.carriers) for r in routes] == [("ATL-DFW", 30, 2)]


def test_delay_causes_always_have_five_rows_and_no_share_without_minutes(spark):
    causes = marts.mart_delay_causes_monthly(facts_of(spark, {}, {"flight_date": "2025-04-01", "nas_delay": 90.0}))
    got = {(r.year_month, r.cause): (r.delay_hours, r.share_pct) for r in causes.collect()}
    assert len(got) == 10
    assert got["2025-03", "Security"] == (0.0, None)
    assert got["2025-04", "National Air System"] == (2.0, 100.0) and got["2025-04", "Carrier"] == (0.0, 0.0)


def test_weather_uplift_and_total_level(spark):
    hours = [
        {"weather_time": datetime(2025, 3, 1, 9)},
        {"weather_time": datetime(2025, 3, 1, 10), "snowfall": 1.0},
        {"airport_code": "JFK", "weather_time": datetime(2025, 3, 1, 9), "precipitation": 5.0},
    ]
    calm = [{"crs_dep_time": 900, "dep_delay": d} for d in (0.0, 0.0, 20.0)]
    snow = [{"crs_dep_time": 1000, "dep_delay": 20.0}, {"crs_dep_time": 1000, "cancelled": 1.0, "dep_delay": None}]
    rain = [{"origin": "JFK", "crs_dep_time": 900, "dep_delay": 20.0}]
    impact = marts.mart_weather_impact(facts_of(spark, *calm, *snow, *rain, {"origin": "BZN"}, hours=hours))
    got = {(r.airport_code, r.weather_condition): (r.departures, r.dep_delay_pct, r.cancellation_pct, r.delay_uplift_pp)
           for r in impact.collect()}
    assert got == {
        ("ATL", "Dry & calm"): (3, 33.33, 0.0, 0.0), ("ATL", "Snow"): (2, 100.0, 50.0, 66.67),
        ("JFK", "Heavy rain"): (1, 100.0, 0.0, None),
        ("ALL HUBS", "Dry & calm"): (3, 33.33, 0.0, 0.0), ("ALL HUBS", "Snow"): (2, 100.0, 50.0, 66.67),
        ("ALL HUBS", "Heavy rain"): (1, 100.0, 0.0, 66.67),
    }
    headline = serving.weather_headline(impact).first()
    # rain and snow tie: the later class of the fixed order is named
    assert (headline.baseline_pct, headline.worst_condition, headline.worst_uplift_pp) == (33.33, "Snow", 66.67)
    assert [r.weather_condition for r in serving.all_hubs_by_weather(impact).collect()] == ["Dry & calm", "Heavy rain", "Snow"]
    assert [r.airport_code for r in serving.uplift_matrix(impact).collect()] == ["ATL"]


def test_hourly_profile_leaves_cancelled_flights_out(spark):
    facts = facts_of(spark, {"dep_delay": 30.0, "late_aircraft_delay": 5.0}, {}, {"cancelled": 1.0, "dep_delay": None})
    row = marts.mart_hourly_profile(facts).first()
    assert (row.scheduled_dep_hour, row.departures, row.dep_delay_pct, row.late_aircraft_pct) == (9, 2, 50.0, 50.0)


def test_airport_daily_maxima_run_over_flown_hours(spark):
    hours = [{"weather_time": datetime(2025, 3, 1, h), "wind_gusts_10m": g} for h, g in ((9, 10.04), (15, 99.0))]
    silver = silver_of(spark, {"crs_dep_time": 905}, {"cancelled": 1.0, "dep_delay": None, "taxi_out": None}, hours=hours)
    airports = star.dim_airport(silver, seeds.hub_airports(spark))
    row = marts.mart_airport_daily(star.fct_flights(silver), airports).first()
    assert (row.airport_code, row.departures, row.max_wind_gust_kmh) == ("ATL", 2, 10.0)
    assert row.airport_name.startswith("Hartsfield") and row.is_hub and row.cancellation_pct == 50.0


def test_dimensions(spark):
    silver = silver_of(spark, {"dest": "BZN", "dest_city": "Bozeman, MT", "dest_state": "MT"},
                       {"flight_date": "2025-03-04", "carrier_code": None})
    airports = {r.airport_code: r for r in star.dim_airport(silver, seeds.hub_airports(spark)).collect()}
    assert (airports["BZN"].airport_name, airports["BZN"].is_hub, airports["BZN"].latitude) == ("BZN", False, None)
    assert airports["DFW"].latitude == 32.8998
    assert {r.carrier_code for r in star.dim_carrier(silver, seeds.carriers(spark)).collect()} == {"AA", None}
    days = star.dim_date(silver).orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20250301, 20250302, 20250303, 20250304]
    assert (days[0].day_name, days[0].day_of_week, days[0].is_weekend, days[0].month_short) == ("Sat", 6, True, "Mar")


def test_change_is_from_the_previous_available_month(spark):
    kpis = spark.createDataFrame(
        [("2025-01", 10, 80.0, 1.0, 2.0, 5.0), ("2025-04", 16, 70.0, 1.5, 2.5, 6.0)],
        "year_month string, flights long, on_time_pct double, avg_arr_delay_min double, cancellation_pct double, total_delay_hours double")
    cards = {r.metric: (r.value, r.delta) for r in serving.kpi_cards(kpis, "2025-04").collect()}
    assert cards["flights"] == (16.0, 6.0) and cards["on_time_pct"] == (70.0, -10.0)
    assert all(r.delta is None for r in serving.kpi_cards(kpis, "2025-01").collect())


def test_hub_month_weighs_daily_rates_and_skips_missing_ones(spark):
    daily = spark.createDataFrame(
        [("2025-03-01", 10, 50.0), ("2025-03-02", 30, 10.0), ("2025-03-03", 10, None), ("2025-04-01", 99, 99.0)],
        "d string, departures long, dep_delay_pct double").select(
        F.col("d").cast("date").alias("flight_date"), F.lit("ATL").alias("airport_code"), F.lit("A").alias("airport_name"),
        F.lit("C").alias("city_name"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
        F.lit(True).alias("is_hub"), "departures", "dep_delay_pct", F.col("dep_delay_pct").alias("cancellation_pct"))
    row = serving.hub_month(daily, "2025-03").first()
    assert (row.departures, row.dep_delay_pct) == (50, 16.0)
    assert serving.most_delayed_hubs(serving.hub_month(daily, "2025-03")).count() == 1


def test_least_punctual_routes_are_taken_from_the_busy_half(spark):
    routes = spark.createDataFrame(
        [("2025-03", "a", 1, 10.0), ("2025-03", "b", 2, 30.0), ("2025-03", "c", 3, 20.0), ("2025-03", "d", 10, 90.0), ("2025-02", "e", 99, 1.0)],
        "year_month string, route string, flights long, on_time_pct double")
    assert [r.route for r in serving.least_punctual_busy_routes(routes, "2025-03").collect()] == ["c", "d"]
    assert [r.route for r in serving.busiest_routes(routes, "2025-03", 2).collect()] == ["d", "c"]


@pytest.mark.parametrize("small", [True, False])
def test_a_month_of_facts_gives_that_month_of_the_mart(spark, small, rows):
    facts = facts_of(spark, {}, {"flight_date": "2025-04-30"}, {"flight_date": "2025-04-01", "arr_delay": 50.0})
    whole = serving.of_month(marts.mart_kpis_monthly(facts), "2025-04")
    assert rows(whole) == rows(marts.mart_kpis_monthly(serving.facts_of_month(facts, "2025-04")))
