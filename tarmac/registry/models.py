"""Models (m), serving queries (d) and checks (q) over the bound flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import rounded
from tarmac.operators import (
    accepted_range, accepted_values, not_null, orphans, same_row_count, summary, unique,
)
from tarmac.plans import marts, quality, serving
from tarmac.registry.binding import Tables
from tarmac.registry.book import query

MONTH = "2024-02"  # the later of the two months the bound flights fall into
FLIGHT = """flight_date, carrier_code, flight_number, tail_number, origin, origin_city, origin_state, dest, dest_city, dest_state,
    crs_dep_time, dep_time, crs_arr_time, arr_time, dep_delay_min, arr_delay_min, taxi_out_min, taxi_in_min,
    scheduled_duration_min, actual_duration_min, air_time_min, distance_miles, is_cancelled, is_diverted, cancellation_code,
    carrier_delay_min, weather_delay_min, nas_delay_min, security_delay_min, late_aircraft_delay_min, _ingested_at,
    scheduled_dep_hour, scheduled_departure_at, flight_id"""


# --- models ---------------------------------------------------------------------------------


@query(f"select {FLIGHT} from flights")
def m01_stg_flights(t: Tables) -> DataFrame:
    return t.stg_flights()


@query("select * from weather")
def m02_stg_weather(t: Tables) -> DataFrame:
    return t.stg_weather()


@query(f"""select {FLIGHT}, temperature_c, precipitation_mm, snowfall_cm, wind_speed_kmh, wind_gusts_kmh, cloud_cover_pct,
    has_weather, weather_condition from silver""")
def m03_int_flights_weather(t: Tables) -> DataFrame:
    return t.int_flights_weather()


@query("select * exclude (ym, on_time) from facts")
def m04_fct_flights(t: Tables) -> DataFrame:
    return t.facts()


@query("select * from airports")
def m05_dim_airport(t: Tables) -> DataFrame:
    return t.derive_dim_airport()


@query("select * from carriers_seen")
def m06_dim_carrier(t: Tables) -> DataFrame:
    return t.derive_dim_carrier()


@query("""select strftime(d, '%Y%m%d')::int as date_key, d as full_date, year(d)::int as year, quarter(d)::int as quarter, month(d)::int as month,
    strftime(d, '%b') as month_short, strftime(d, '%Y-%m') as year_month, isodow(d)::int as day_of_week, strftime(d, '%a') as day_name,
    isodow(d) > 5 as is_weekend
    from (select unnest(range(min(flight_date), max(flight_date) + interval 1 day, interval 1 day))::date as d from flights)""")
def m07_dim_date(t: Tables) -> DataFrame:
    return t.derive_dim_date()


@query("select * from kpis")
def m08_mart_kpis_monthly(t: Tables) -> DataFrame:
    return marts.mart_kpis_monthly(t.facts())


@query("select * from carrier_month")
def m09_mart_carrier_monthly(t: Tables) -> DataFrame:
    return marts.mart_carrier_monthly(t.facts(), t.carriers())


@query("select * from airport_day")
def m10_mart_airport_daily(t: Tables) -> DataFrame:
    return marts.mart_airport_daily(t.facts(), t.dim_airport())


@query("select * from route_month")
def m11_mart_route_monthly(t: Tables) -> DataFrame:
    return marts.mart_route_monthly(t.facts())


@query("select * from cause_month")
def m12_mart_delay_causes_monthly(t: Tables) -> DataFrame:
    return marts.mart_delay_causes_monthly(t.facts())


@query("select * from impact")
def m13_mart_weather_impact(t: Tables) -> DataFrame:
    return marts.mart_weather_impact(t.facts())


@query("select * from hour_profile")
def m14_mart_hourly_profile(t: Tables) -> DataFrame:
    return marts.mart_hourly_profile(t.facts())


# --- serving --------------------------------------------------------------------------------


def _month_facts(t: Tables) -> DataFrame:
    return serving.facts_of_month(t.facts_of_month(MONTH), MONTH)


@query("""select sum(flights)::bigint as total_flights, min(year_month) as first_month, max(year_month) as last_month from kpis""")
def d01_header(t: Tables) -> DataFrame:
    return serving.header(t.mart("mart_kpis_monthly"))


_CARDS = ["flights", "on_time_pct", "avg_arr_delay_min", "cancellation_pct", "total_delay_hours"]


@query(" union all ".join(
    f"""(select '{c}' as metric, cur.{c}::double as value,
         (cur.{c} - (select p.{c} from kpis p where p.year_month < cur.year_month order by p.year_month desc limit 1))::double as delta
         from kpis cur where cur.year_month = '{MONTH}')""" for c in _CARDS))
def d02_kpi_cards(t: Tables) -> DataFrame:
    return serving.kpi_cards(t.mart("mart_kpis_monthly"), MONTH)


@query("select year_month, flights, on_time_pct from kpis")
def d03_monthly_punctuality(t: Tables) -> DataFrame:
    return serving.monthly_punctuality(t.mart("mart_kpis_monthly"))


@query("select year_month, cause, share_pct from cause_month")
def d04_delay_cause_shares(t: Tables) -> DataFrame:
    return serving.delay_cause_shares(t.mart("mart_delay_causes_monthly"))


@query("select scheduled_dep_hour, dep_delay_pct from hour_profile")
def d05_hourly_delays(t: Tables) -> DataFrame:
    return serving.hourly_delays(t.mart("mart_hourly_profile"))


@query(f"""select on_time_rank, carrier_name, carrier_type, flights, on_time_pct, avg_arr_delay_min, cancellation_pct
    from carrier_month where year_month = '{MONTH}'""")
def d06_airline_ranking(t: Tables) -> DataFrame:
    return serving.airline_ranking(marts.mart_carrier_monthly(_month_facts(t), t.carriers()), MONTH)


_HUBS = f"""with hub as (
    select airport_code, airport_name, city_name, latitude, longitude, is_hub, sum(departures)::bigint as departures,
           ifnull(sum(dep_delay_pct * departures), 0) / sum(departures) as dep_delay_pct,
           ifnull(sum(cancellation_pct * departures), 0) / sum(departures) as cancellation_pct
    from airport_day where strftime(flight_date, '%Y-%m') = '{MONTH}' and is_hub group by all)"""
_ONE_PLACE = """case when abs(dep_delay_pct * 10 - trunc(dep_delay_pct * 10)) = 0.5 then 2 * round(dep_delay_pct * 5)
    else round(dep_delay_pct * 10) end / 10 + 0.0"""


@query(f"""{_HUBS} select airport_code, airport_name, city_name, latitude, longitude, is_hub, departures,
    round(dep_delay_pct, 6) + 0.0 as dep_delay_pct, round(cancellation_pct, 6) + 0.0 as cancellation_pct from hub""")
def d07_hub_month(t: Tables) -> DataFrame:
    """Six decimals: the order of a floating-point sum shows beyond them."""
    rates = {c: rounded(F.col(c), 6) for c in ("dep_delay_pct", "cancellation_pct")}
    return serving.hub_month(marts.mart_airport_daily(_month_facts(t), t.dim_airport()), MONTH).withColumns(rates)


@query(f"""{_HUBS} select airport_code, city_name, departures, {_ONE_PLACE} as dep_delay_pct
    from (from hub order by hub.dep_delay_pct desc nulls last, airport_code limit 10)""")
def d08_most_delayed_hubs(t: Tables) -> DataFrame:
    return serving.most_delayed_hubs(serving.hub_month(marts.mart_airport_daily(_month_facts(t), t.dim_airport()), MONTH))


@query(f"""{_HUBS} select airport_code, city_name, departures, {_ONE_PLACE} as dep_delay_pct
    from (from hub order by hub.dep_delay_pct nulls last, airport_code limit 10)""")
def d09_most_punctual_hubs(t: Tables) -> DataFrame:
    return serving.most_punctual_hubs(serving.hub_month(marts.mart_airport_daily(_month_facts(t), t.dim_airport()), MONTH))


@query("select * from impact where airport_code = 'ALL HUBS'")
def d10_all_hubs_by_weather(t: Tables) -> DataFrame:
    return serving.all_hubs_by_weather(t.mart("mart_weather_impact"))


@query("""select calm.dep_delay_pct as baseline_pct, w.weather_condition as worst_condition, w.dep_delay_pct as worst_pct,
    w.delay_uplift_pp as worst_uplift_pp, w.cancellation_pct as worst_cancellation_pct
    from (from impact where airport_code = 'ALL HUBS' and weather_condition = 'Dry & calm') calm,
         (from impact where airport_code = 'ALL HUBS' order by impact.dep_delay_pct desc nulls last,
          list_position(['Snow', 'Strong wind', 'Heavy rain', 'Light rain', 'Dry & calm'], weather_condition) limit 1) w""")
def d11_weather_headline(t: Tables) -> DataFrame:
    return serving.weather_headline(t.mart("mart_weather_impact"))


@query("""select airport_code, avg(delay_uplift_pp) filter (where weather_condition = 'Light rain') as "Light rain",
    avg(delay_uplift_pp) filter (where weather_condition = 'Heavy rain') as "Heavy rain",
    avg(delay_uplift_pp) filter (where weather_condition = 'Strong wind') as "Strong wind",
    avg(delay_uplift_pp) filter (where weather_condition = 'Snow') as "Snow"
    from impact where airport_code <> 'ALL HUBS' and weather_condition <> 'Dry & calm' and delay_uplift_pp is not null
    group by airport_code""")
def d12_uplift_matrix(t: Tables) -> DataFrame:
    return serving.uplift_matrix(t.mart("mart_weather_impact"))


@query(f"""select route, flights, on_time_pct from route_month where year_month = '{MONTH}'
    order by route_month.flights desc, route limit 15""")
def d13_busiest_routes(t: Tables) -> DataFrame:
    return serving.busiest_routes(marts.mart_route_monthly(_month_facts(t)), MONTH)


@query(f"""with rm as (from route_month where year_month = '{MONTH}')
    select route, flights, on_time_pct from rm where rm.flights >= (select quantile_cont(r.flights, 0.5) from rm r)
    order by rm.on_time_pct nulls last, route limit 15""")
def d14_least_punctual_busy_routes(t: Tables) -> DataFrame:
    return serving.least_punctual_busy_routes(marts.mart_route_monthly(_month_facts(t)), MONTH)


# --- checks ---------------------------------------------------------------------------------


@query("select flight_id, origin, dest from flights where tail_number is null")
def q01_not_null(t: Tables) -> DataFrame:
    return not_null(t.silver(), "tail_number").select("flight_id", "origin", "dest")


@query("""select flight_date, flight_number, carrier_code, origin, dest, crs_dep_time, count(*) as rows from b_flights
    group by all having count(*) > 1""")
def q02_unique(t: Tables) -> DataFrame:
    """Natural keys that bronze holds more than once: what silver has to de-duplicate."""
    return unique(
        t.bronze_flights(), "flight_date", "flight_number", "carrier_code", "origin", "dest", "crs_dep_time"
    )


@query("select flight_id, carrier_code from flights where carrier_code not in (select carrier_code from seed_carriers where carrier_type <> 'Regional')")
def q03_accepted_values(t: Tables) -> DataFrame:
    main = ["AA", "DL", "UA", "WN", "AS", "B6", "NK", "F9", "G4", "HA", "SY", "MX"]
    return accepted_values(t.silver(), "carrier_code", main).select("flight_id", "carrier_code")


@query("select flight_id, arr_delay_min from flights where arr_delay_min < -60 or arr_delay_min > 45")
def q04_accepted_range(t: Tables) -> DataFrame:
    return accepted_range(t.silver(), "arr_delay_min", -60, 45).select("flight_id", "arr_delay_min")


@query("""select carrier_code, count(*) as rows from facts where carrier_code not in (select carrier_code from seed_carriers) group by 1""")
def q05_relationships(t: Tables) -> DataFrame:
    return orphans(t.facts(), "carrier_code", t.carriers(), "carrier_code")


@query("""select count(*) as rows, count(*) filter (where is_cancelled and (arr_delay_min is not null or is_arr_delayed is not null)) as violations from facts""")
def q06_cancelled_without_arrival(t: Tables) -> DataFrame:
    return summary(t.facts(), quality.arrival_after_cancellation())


@query("""select count(*) as rows, count(*) filter (where least(carrier_delay_min, weather_delay_min, nas_delay_min,
    security_delay_min, late_aircraft_delay_min) < 0) as violations from facts""")
def q07_non_negative_causes(t: Tables) -> DataFrame:
    return summary(t.facts(), quality.negative_cause())


@query("""select (select count(*) from b_flights) as left_rows, (select count(*) from facts) as right_rows""")
def q08_same_row_count(t: Tables) -> DataFrame:
    """Bronze against the fact table: they differ by the re-ingested copies."""
    return same_row_count(t.bronze_flights(), t.facts())


@query("""select count(*) as rows, count(*) filter (where not (crs_dep_time between 0 and 2400) or not (dep_time between 0 and 2400)
    or not (crs_arr_time between 0 and 2400) or not (arr_time between 0 and 2400)) as violations from b_flights""")
def q09_hhmm_range(t: Tables) -> DataFrame:
    return quality.hhmm_summary(t.bronze_flights())


@query("""select count(*) as rows, count(distinct airport_code) as codes,
    count(*) filter (where latitude not between 18 and 72 or longitude not between -170 and -60) as violations from seed_hubs""")
def q10_seed_coordinates(t: Tables) -> DataFrame:
    return quality.seed_summary(t.hubs())


@query("""select *, day(last_day(month_start)) * 24 as expected from
    (select airport_code, date_trunc('month', weather_hour)::date as month_start, count(*) as rows, count(distinct weather_hour) as hours
     from weather where airport_code in (select airport_code from seed_hubs) group by 1, 2)
    where rows <> day(last_day(month_start)) * 24 or hours <> rows""")
def q11_incomplete_weather(t: Tables) -> DataFrame:
    return quality.incomplete_weather(t.stg_weather(), t.hubs())


@query("""with e as (select airport_code, unnest(range(m::timestamp, (m + interval 1 month)::timestamp, interval 1 hour)) as weather_hour
    from (select distinct date_trunc('month', weather_hour)::date as m from weather), seed_hubs)
    select * from e where not exists (select 1 from weather w where w.airport_code = e.airport_code and w.weather_hour = e.weather_hour)""")
def q11_missing_hours(t: Tables) -> DataFrame:
    return quality.missing_hours(t.stg_weather(), t.hubs())


def _checked_tables(t: Tables) -> dict[str, DataFrame]:
    """Written bronze, staged flights, dimensions and marts; the facts are a light plan over written silver.

    The staged flights are those that have not met the weather, so that a flight the matching lost or doubled shows.
    They are written first, and silver is made of them unless it is there.
    """
    staged = t.staged()
    marts_read = ["mart_kpis_monthly", "mart_carrier_monthly", "mart_delay_causes_monthly", "mart_hourly_profile"]
    return {
        "bronze_flights": t.bronze_flights(),
        "stg_flights": staged,
        "stg_weather": t.stg_weather(),
        "fct_flights": t.facts(),
        "dim_carrier": t.dim_carrier(),
        "dim_airport": t.dim_airport(),
        "dim_date": t.dim_date(),
        **{name: t.mart(name) for name in marts_read},
    }


def _null(column: str) -> str:
    return f"{column} is null"


# The suite as the SQL knows it: check, table, its source, column, rows in violation (or, with "=", their number).
_SUITE = [
    ("not_null", "bronze_flights", "b_flights", "flight_date", _null("flight_date")),
    ("not_null", "bronze_flights", "b_flights", "carrier_code", _null("carrier_code")),
    ("not_null", "stg_flights", "flights", "flight_id", _null("flight_id")),
    ("not_null", "stg_flights", "flights", "flight_date", _null("flight_date")),
    ("not_null", "stg_flights", "flights", "origin", _null("origin")),
    ("not_null", "stg_flights", "flights", "dest", _null("dest")),
    ("unique", "stg_flights", "flights", "flight_id", "="),
    ("accepted_range", "stg_flights", "flights", "scheduled_dep_hour", "scheduled_dep_hour not between 0 and 23"),
    ("accepted_values", "stg_flights", "flights", "cancellation_code", "cancellation_code not in ('A', 'B', 'C', 'D')"),
    ("accepted_range", "stg_flights", "flights", "distance_miles", "distance_miles not between 0 and 6000"),
    ("not_null", "stg_weather", "weather", "airport_code", _null("airport_code")),
    ("accepted_range", "stg_weather", "weather", "precipitation_mm", "precipitation_mm not between 0 and 200"),
    ("not_null", "fct_flights", "facts", "flight_id", _null("flight_id")),
    ("unique", "fct_flights", "facts", "flight_id", "="),
    ("accepted_values", "fct_flights", "facts", "cancellation_reason",
     "cancellation_reason not in ('Carrier', 'Weather', 'National Air System', 'Security')"),
    ("accepted_values", "fct_flights", "facts", "weather_condition",
     "weather_condition not in ('Snow', 'Heavy rain', 'Light rain', 'Strong wind', 'Dry & calm')"),
    ("relationships", "fct_flights", "facts", "carrier_code", "carrier_code not in (select carrier_code from carriers_seen)"),
    ("relationships", "fct_flights", "facts", "origin_code", "origin_code not in (select airport_code from airports)"),
    ("relationships", "fct_flights", "facts", "dest_code", "dest_code not in (select airport_code from airports)"),
    ("relationships", "fct_flights", "facts", "date_key", "date_key not in (select date_key from facts)"),
    ("cancelled_without_arrival", "fct_flights", "facts", "arr_delay_min",
     "is_cancelled and (arr_delay_min is not null or is_arr_delayed is not null)"),
    ("non_negative", "fct_flights", "facts", "delay_causes",
     "least(carrier_delay_min, weather_delay_min, nas_delay_min, security_delay_min, late_aircraft_delay_min) < 0"),
    ("same_row_count", "fct_flights", "", "*", "select if((select count(*) from flights) = (select count(*) from facts), 0, 1)"),
    ("not_null", "dim_carrier", "carriers_seen", "carrier_code", _null("carrier_code")),
    ("unique", "dim_carrier", "carriers_seen", "carrier_code", "="),
    ("not_null", "dim_airport", "airports", "airport_code", _null("airport_code")),
    ("unique", "dim_airport", "airports", "airport_code", "="),
    ("not_null", "dim_date", "(select distinct date_key from facts)", "date_key", _null("date_key")),
    ("unique", "dim_date", "(select distinct date_key from facts)", "date_key", "="),
    ("not_null", "mart_kpis_monthly", "kpis", "year_month", _null("year_month")),
    ("unique", "mart_kpis_monthly", "kpis", "year_month", "="),
    ("accepted_range", "mart_kpis_monthly", "kpis", "on_time_pct", "on_time_pct not between 0 and 100"),
    ("accepted_range", "mart_carrier_monthly", "carrier_month", "on_time_pct", "on_time_pct not between 0 and 100"),
    ("accepted_values", "mart_delay_causes_monthly", "cause_month", "cause",
     "cause not in ('Carrier', 'Weather', 'National Air System', 'Security', 'Late aircraft')"),
    ("unique", "mart_hourly_profile", "hour_profile", "scheduled_dep_hour", "="),
]


def _suite_sql() -> str:
    lines = []
    for check, table, source, column, what in _SUITE:
        if check == "same_row_count":
            count = what
        elif what == "=":
            count = f"select count(*) from (select {column} from {source} where {column} is not null group by 1 having count(*) > 1)"
        else:
            count = f"select count(*) from {source} where {what}"
        lines.append(f"select '{check}' as check_name, '{table}' as table_name, '{column}' as column_name, ({count})::bigint as violations")
    return " union all ".join(lines)


@query(_suite_sql())
def q12_quality_report(t: Tables) -> DataFrame:
    return quality.report(_checked_tables(t))


# --- checks that fire: violations planted in rows derived from the bound flights ---------------


@query("""select (select count(*) from (select left(flight_id, 5) as k from flights group by 1 having count(*) > 1))::bigint as flights,
    (select count(*) from (select left(flight_id, 4) as k from facts group by 1 having count(*) > 1))::bigint as facts""")
def q02_planted_keys(t: Tables) -> DataFrame:
    """Ids cut short, so that many repeat, and differently in the facts."""
    flights, mark = quality.repeated_keys(t.silver().withColumn("flight_id", F.left("flight_id", F.lit(5))), "flight_id")
    facts = quality.repeated_elsewhere(t.facts().withColumn("flight_id", F.left("flight_id", F.lit(4))), "flight_id", flights, mark)
    return t.spark.range(1).select(F.lit(flights).cast("long").alias("flights"), F.lit(facts).cast("long").alias("facts"))


@query("""select count(*) as rows, count(*) filter (where is_cancelled and (arr_delay is not null)) as violations
    from (select is_cancelled or distance_miles > 900 as is_cancelled, arr_delay_min as arr_delay from facts)""")
def q06_planted_arrivals(t: Tables) -> DataFrame:
    """Long flights are called cancelled although they arrived."""
    planted = t.facts().withColumn("is_cancelled", F.col("is_cancelled") | (F.col("distance_miles") > 900))
    return summary(planted, quality.arrival_after_cancellation())


@query("""select count(*) as rows, count(*) filter (where least(carrier_delay_min - 5, weather_delay_min, nas_delay_min,
    security_delay_min, late_aircraft_delay_min) < 0) as violations from facts""")
def q07_planted_causes(t: Tables) -> DataFrame:
    """The first cause is lowered below zero for short delays."""
    planted = t.facts().withColumn("carrier_delay_min", F.col("carrier_delay_min") - 5)
    return summary(planted, quality.negative_cause())


@query("""select count(*) as rows, count(*) filter (where not (crs_dep_time + 500 between 0 and 2400) or not (dep_time between 0 and 2400)
    or not (crs_arr_time between 0 and 2400) or not (arr_time between 0 and 2400)) as violations from b_flights""")
def q09_planted_clock(t: Tables) -> DataFrame:
    """Planned departures five hours on, beyond the end of the day."""
    return quality.hhmm_summary(t.bronze_flights().withColumn("crs_dep_time", F.col("crs_dep_time").cast("int") + 500))


@query("""select count(*) as rows, count(distinct airport_code) as codes,
    count(*) filter (where not (latitude + 38 between 18 and 72) or not (longitude between -170 and -60)) as violations from seed_hubs""")
def q10_planted_coordinates(t: Tables) -> DataFrame:
    """Hubs moved north, some of them out of the covered area."""
    return quality.seed_summary(t.hubs().withColumn("latitude", F.col("latitude") + 38))
