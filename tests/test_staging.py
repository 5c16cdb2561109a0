from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from builders import flights, weather
from tarmac import functions as fn
from tarmac.plans.staging import stg_flights, stg_weather
from tarmac.plans.star import fct_flights, int_flights_weather


@pytest.mark.parametrize("hhmm, hour, minute", [
    (0, 0, 0), (5, 0, 5), (59, 0, 59), (1905, 19, 5), (2359, 23, 59), (2400, 0, 0), (2430, 0, 0), (None, None, None),
])
def test_hhmm_parts(spark, hhmm, hour, minute):
    df = spark.createDataFrame([(hhmm,)], "c int")
    assert df.select(fn.hhmm_hour(F.col("c")), fn.hhmm_minute(F.col("c"))).first() == (hour, minute)


@pytest.mark.parametrize("text, number", [
    ("0005", 5), ("1932", 1932), ("1932.0", 1932), ("2400", 2400), ("12.5", 12), ("13.5", 14), ("noon", None), (None, None),
])
def test_hhmm_number_coerces_and_rounds_half_even(spark, text, number):
    assert spark.createDataFrame([(text,)], "c string").select(fn.hhmm_number(F.col("c"))).first()[0] == number


def test_midnight_as_2400_stays_on_its_date(spark):
    row = stg_flights(flights(spark, {"crs_dep_time": 2400})).first()
    assert row.scheduled_departure_at == datetime(2025, 3, 1) and row.scheduled_dep_hour == 0


def test_wall_clock_survives_a_skipped_local_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        bronze = flights(spark, {"flight_date": "2025-03-09", "crs_dep_time": 230})
        hours = stg_flights(bronze).select(
            F.col("scheduled_departure_at").cast("string"),
            fn.hour_bucket(F.col("scheduled_departure_at")).cast("string"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert hours == ("2025-03-09 02:30:00", "2025-03-09 02:00:00")


def test_impossible_minute_is_an_error(spark):
    with pytest.raises(Exception, match="65|INVALID"):
        stg_flights(flights(spark, {"crs_dep_time": 1065})).collect()


def test_codes_blanks_and_flags_are_normalised(spark):
    row = stg_flights(flights(spark, {
        "carrier_code": " aa ", "tail_number": "  ", "cancellation_code": "", "cancelled": None, "diverted": 1.0,
    })).first()
    assert (row.carrier_code, row.tail_number, row.cancellation_code) == ("AA", None, None)
    assert (row.is_cancelled, row.is_diverted) == (False, True)


def test_latest_ingested_copy_wins(spark):
    bronze = flights(
        spark,
        {"dep_delay": 1.0, "_ingested_at": datetime(2025, 6, 1)},
        {"dep_delay": 3.0, "_ingested_at": datetime(2025, 6, 3)},
        {"dep_delay": 2.0, "_ingested_at": datetime(2025, 6, 2)},
        {"dep_delay": 9.0, "_ingested_at": None},
    )
    assert [r.dep_delay_min for r in stg_flights(bronze).collect()] == [3.0]


def test_ties_do_not_depend_on_row_order_or_partitions(spark):
    copies = [{"dep_delay": float(i)} for i in range(40)]
    one = stg_flights(flights(spark, *copies).coalesce(1)).first().dep_delay_min
    two = stg_flights(flights(spark, *reversed(copies)).repartition(7)).first().dep_delay_min
    assert one == two


def test_null_key_parts_are_skipped_not_blank(spark):
    import hashlib

    row = stg_flights(flights(spark, {"carrier_code": None, "crs_dep_time": None})).first()
    assert row.flight_id == hashlib.md5(b"2025-03-01|1|ATL|DFW").hexdigest()
    assert row.scheduled_departure_at is None


def test_rows_without_a_date_are_dropped_and_a_new_schedule_is_a_new_flight(spark):
    bronze = flights(spark, {"flight_date": None}, {"crs_dep_time": 905}, {"crs_dep_time": 910})
    assert stg_flights(bronze).count() == 2


def test_a_hot_key_leaves_each_map_task_as_one_row(spark):
    plan = stg_flights(flights(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_weather_duplicates_are_found_on_the_raw_code(spark):
    bronze = weather(
        spark,
        {"airport_code": "jfk", "temperature_2m": 1.0},
        {"airport_code": "JFK", "temperature_2m": 2.0},
        {"airport_code": "JFK", "temperature_2m": 3.0, "_ingested_at": datetime(2025, 7, 1)},
    )
    assert sorted((r.airport_code, r.temperature_c) for r in stg_weather(bronze).collect()) == [("JFK", 1.0), ("JFK", 3.0)]


def test_weather_code_rounds_half_even(spark):
    codes = [2.5, 3.5, 2.7, None]
    bronze = weather(spark, *[{"weather_time": datetime(2025, 3, 1, h), "weather_code": c} for h, c in enumerate(codes)])
    assert [r.wmo_weather_code for r in stg_weather(bronze).orderBy("weather_hour").collect()] == [2, 4, 3, None]


@pytest.mark.parametrize("snow, rain, gust, label", [
    (0.1, 9.0, 90.0, "Snow"), (0.0, 2.5, 90.0, "Heavy rain"), (0.0, 2.49, 90.0, "Light rain"),
    (0.0, 0.0, 50.0, "Strong wind"), (0.0, 0.0, 49.9, "Dry & calm"), (None, None, None, "Dry & calm"),
])
@pytest.mark.parametrize("small", [True, False])
def test_weather_class_and_match(spark, snow, rain, gust, label, small):
    hours = stg_weather(weather(spark, {"snowfall": snow, "precipitation": rain, "wind_gusts_10m": gust}))
    bronze = flights(spark, {"crs_dep_time": 959}, {"crs_dep_time": 1000}, {"origin": "BZN"}, {"crs_dep_time": None})
    matched = int_flights_weather(stg_flights(bronze), hours, small).collect()
    assert sorted((r.has_weather, r.weather_condition) for r in matched if r.has_weather) == [(True, label)]
    assert [r.weather_condition for r in matched if not r.has_weather] == [None] * 3


def test_outcome_flags_are_three_valued(spark):
    bronze = flights(
        spark,
        {"flight_number": "1", "arr_delay": 14.0, "dep_delay": 15.0},
        {"flight_number": "2", "arr_delay": 15.0, "dep_delay": 14.0},
        {"flight_number": "3", "cancelled": 1.0, "cancellation_code": "B", "arr_delay": None, "dep_delay": None},
        {"flight_number": "4", "diverted": 1.0, "arr_delay": None, "dep_delay": 30.0},
        {"flight_number": "5", "arr_delay": None},
    )
    hours = stg_weather(weather(spark, {}))
    facts = {r.flight_number: r for r in fct_flights(int_flights_weather(stg_flights(bronze), hours, True)).collect()}
    flags = {n: (r.is_completed, r.is_arr_delayed, r.is_dep_delayed, r.cancellation_reason) for n, r in facts.items()}
    assert flags == {
        "1": (True, False, True, None), "2": (True, True, False, None), "3": (False, None, None, "Weather"),
        "4": (False, None, True, None), "5": (True, None, False, None),
    }
    assert facts["1"].date_key == 20250301 and facts["1"].route == "ATL-DFW"
    assert facts["1"].carrier_delay_min == 0.0 and facts["1"].flight_date == date(2025, 3, 1)
