"""DuckDB SQL that the registered queries are checked against.

``with_tables`` prefixes a query with the common tables it names. They are written
from the models' definitions, independently of the Spark plans: one binding of the
driver's tables to bronze, then silver and the fact table.
"""

from __future__ import annotations

import re

from tarmac.sources import seeds


def _values(text: str, numbers: int = 0) -> str:
    rows = []
    for cells in seeds.seed_rows(text):
        split = len(cells) - numbers
        quoted = ["'" + c.replace("'", "''") + "'" for c in cells[:split]]
        rows.append("(" + ", ".join(quoted + [f"{c}::double" for c in cells[split:]]) + ")")
    return ", ".join(rows)


_CODES = ", ".join(
    f"({i}, '{code}')"
    for i, code in enumerate([r[0] for r in seeds.seed_rows(seeds.CARRIER_ROWS)] + ["X1", "X2"])
)

TABLES = {
    "seed_carriers": f"select * from (values {_values(seeds.CARRIER_ROWS)}) t(carrier_code, carrier_name, carrier_type)",
    "seed_hubs": """
        select 'A' || lpad(n_nationkey::varchar, 2, '0') as airport_code, n_name || ' Intl' as airport_name, n_name as city,
               'R' || n_regionkey as state, 25.0::double + n_nationkey as latitude, -70.0::double - 2 * n_nationkey as longitude
        from nation where n_nationkey < 15""",
    "b_flights": f"""
        with c as (
          select (date '2024-01-01' + cast(date_diff('day', date '1995-01-01', cast(l.l_shipdate as date)) % 60 as int)) as fd,
                 l.*, s.s_nationkey as sn, cu.c_nationkey as cn,
                 (cast(floor(l.l_extendedprice) as bigint) % 37) = 0 as canc,
                 (cast(floor(l.l_extendedprice) as bigint) % 101) = 1 as divr0,
                 cast(floor(l.l_quantity) as int) * 3 - 90 as dd, l.l_linenumber - 4 as adj,
                 case when (l.l_orderkey * 7 + l.l_linenumber) % 25 = 24 then 2400
                      else cast(((l.l_orderkey * 7 + l.l_linenumber) % 25) * 100 + (l.l_partkey % 12) * 5 as int) end as crs
          from lineitem l join orders o on o.o_orderkey = l.l_orderkey
          join customer cu on cu.c_custkey = o.o_custkey join supplier s on s.s_suppkey = l.l_suppkey),
        e as (select c.*, divr0 and not canc as divr, not canc and not divr0 as comp, dd + adj as ad,
                     60 + (sn * 25 + cn) % 300 as el,
                     (timestamp '2024-03-01 00:00:00' + to_seconds(l_partkey)) as ing from c),
        r as (select * from e union all
              select * replace (dd + 6 as dd, ad + 6 as ad, ing + interval 1 day as ing) from e where l_orderkey % 50 = 0)
        select cast(fd as varchar) as flight_date, k.code as carrier_code, cast(l_orderkey as varchar) as flight_number,
          case when l_partkey % 29 = 0 then '' else concat('N', cast(l_suppkey as varchar)) end as tail_number,
          concat('A', lpad(cast(sn as varchar), 2, '0')) as origin, no.n_name as origin_city, concat('R', cast(no.n_regionkey as varchar)) as origin_state,
          concat('A', lpad(cast(cn as varchar), 2, '0')) as dest, nd.n_name as dest_city, concat('R', cast(nd.n_regionkey as varchar)) as dest_state,
          cast(crs as smallint) as crs_dep_time, cast(case when not canc then crs end as smallint) as dep_time,
          cast(case when not canc then dd end as double) as dep_delay,
          cast(case when not canc then case when dd >= 15 then 1 else 0 end end as double) as dep_del15,
          cast(case when not canc then 10 + l_partkey % 25 end as double) as taxi_out, cast(case when comp then 3 + l_suppkey % 12 end as double) as taxi_in,
          cast((crs % 2400 + 200) % 2400 as smallint) as crs_arr_time, cast(case when comp then (crs % 2400 + 200) % 2400 end as smallint) as arr_time,
          cast(case when comp then ad end as double) as arr_delay, cast(case when comp then case when ad >= 15 then 1 else 0 end end as double) as arr_del15,
          cast(case when canc then 1 else 0 end as double) as cancelled,
          case when canc then substr('ABCD', cast(l_orderkey % 4 as int) + 1, 1) else '' end as cancellation_code,
          cast(case when divr then 1 else 0 end as double) as diverted,
          cast(el as double) as crs_elapsed_time, cast(case when comp then el + adj end as double) as actual_elapsed_time, cast(case when comp then el - 25 end as double) as air_time,
          cast(100 + 40 * abs(sn - cn) as double) as distance,
          cast(case when comp and ad >= 15 then ad // 3 end as double) as carrier_delay, cast(case when comp and ad >= 15 then ad % 5 end as double) as weather_delay,
          cast(case when comp and ad >= 15 then ad % 4 end as double) as nas_delay, cast(case when comp and ad >= 15 then case when ad % 11 = 0 then 1 else 0 end end as double) as security_delay,
          cast(case when comp and ad >= 15 then ad - (ad // 3) - ad % 5 - ad % 4 - case when ad % 11 = 0 then 1 else 0 end end as double) as late_aircraft_delay,
          ing as _ingested_at
        from r join (values {_CODES}) k(idx, code) on k.idx = l_partkey % 26
        join nation no on no.n_nationkey = sn join nation nd on nd.n_nationkey = cn""",
    "b_weather": """
        select concat('A', lpad(cast(user_id % 15 as varchar), 2, '0')) as airport_code, date_trunc('hour', ts) as weather_time,
          cast(event_id % 40 - 5 as double) as temperature_2m,
          cast(case when event_type = 'purchase' then cast(floor(value) as int) % 7 else 0 end as double) * cast(0.5 as double) as precipitation,
          cast(case when event_type = 'error' then 1 else 0 end as double) as snowfall,
          cast(cast(floor(value) as int) % 40 as double) as wind_speed_10m, cast(cast(floor(value) as int) % 70 as double) as wind_gusts_10m,
          cast(event_id % 101 as double) as cloud_cover, cast(event_id % 100 as int) as weather_code, 'UTC' as timezone,
          ts as _ingested_at, event_id as _tie
        from events""",
    "flights": """
        select distinct on (flight_id) *
        from (select cast(flight_date as date) as flight_date, upper(trim(carrier_code)) as carrier_code, trim(flight_number) as flight_number,
                     nullif(trim(tail_number), '') as tail_number, upper(trim(origin)) as origin, origin_city, origin_state,
                     upper(trim(dest)) as dest, dest_city, dest_state, crs_dep_time::int as crs_dep_time, dep_time::int as dep_time,
                     crs_arr_time::int as crs_arr_time, arr_time::int as arr_time, dep_delay as dep_delay_min, arr_delay as arr_delay_min,
                     taxi_out as taxi_out_min, taxi_in as taxi_in_min, crs_elapsed_time as scheduled_duration_min,
                     actual_elapsed_time as actual_duration_min, air_time as air_time_min, distance as distance_miles,
                     ifnull(cancelled, 0) = 1 as is_cancelled, ifnull(diverted, 0) = 1 as is_diverted,
                     nullif(trim(cancellation_code), '') as cancellation_code,
                     carrier_delay as carrier_delay_min, weather_delay as weather_delay_min, nas_delay as nas_delay_min,
                     security_delay as security_delay_min, late_aircraft_delay as late_aircraft_delay_min, _ingested_at,
                     case when crs_dep_time < 2400 then (crs_dep_time // 100)::int when crs_dep_time >= 2400 then 0 end as scheduled_dep_hour,
                     cast(flight_date as timestamp)
                       + to_minutes(case when crs_dep_time < 2400 then (crs_dep_time // 100) * 60 + crs_dep_time % 100
                                         when crs_dep_time >= 2400 then 0 end) as scheduled_departure_at,
                     md5(concat_ws('|', flight_date, upper(trim(carrier_code)), trim(flight_number), upper(trim(origin)),
                                   upper(trim(dest)), crs_dep_time)) as flight_id
              from b_flights where flight_date is not null)
        order by flight_id, _ingested_at desc""",
    "weather": """
        select distinct on (b.airport_code, b.weather_time)
               upper(b.airport_code) as airport_code, weather_time as weather_hour, temperature_2m as temperature_c,
               precipitation as precipitation_mm, snowfall as snowfall_cm, wind_speed_10m as wind_speed_kmh,
               wind_gusts_10m as wind_gusts_kmh, cloud_cover as cloud_cover_pct, weather_code::int as wmo_weather_code
        from b_weather b
        order by b.airport_code, b.weather_time, _ingested_at desc, _tie desc""",
    "silver": """
        select f.*, temperature_c, precipitation_mm, snowfall_cm, wind_speed_kmh, wind_gusts_kmh, cloud_cover_pct,
               w.airport_code is not null as has_weather,
               case when w.airport_code is not null then
                 case when snowfall_cm > 0 then 'Snow' when precipitation_mm >= 2.5 then 'Heavy rain'
                      when precipitation_mm > 0 then 'Light rain' when wind_gusts_kmh >= 50 then 'Strong wind'
                      else 'Dry & calm' end end as weather_condition
        from flights f left join weather w
          on (w.airport_code, w.weather_hour) = (f.origin, date_trunc('hour', f.scheduled_departure_at))""",
    "facts": """
        select flight_id, flight_date, strftime(flight_date, '%Y-%m') as ym, strftime(flight_date, '%Y%m%d')::int as date_key,
               carrier_code, flight_number, tail_number, origin as origin_code, dest as dest_code, origin || '-' || dest as route,
               scheduled_departure_at, scheduled_dep_hour, distance_miles, is_cancelled, is_diverted,
               map {'A': 'Carrier', 'B': 'Weather', 'C': 'National Air System', 'D': 'Security'}[cancellation_code] as cancellation_reason,
               not (is_cancelled or is_diverted) as is_completed,
               if(is_cancelled or is_diverted, null, arr_delay_min >= 15) as is_arr_delayed,
               if(is_cancelled, null, dep_delay_min >= 15) as is_dep_delayed,
               dep_delay_min, arr_delay_min, taxi_out_min, taxi_in_min, air_time_min,
               ifnull(carrier_delay_min, 0) as carrier_delay_min, ifnull(weather_delay_min, 0) as weather_delay_min,
               ifnull(nas_delay_min, 0) as nas_delay_min, ifnull(security_delay_min, 0) as security_delay_min,
               ifnull(late_aircraft_delay_min, 0) as late_aircraft_delay_min,
               has_weather, weather_condition, temperature_c, precipitation_mm, snowfall_cm, wind_gusts_kmh,
               case when not (is_cancelled or is_diverted) then if(arr_delay_min < 15, 1, if(arr_delay_min is null, null, 0)) end as on_time
        from silver""",
    "airports": """
        select s.airport_code, ifnull(h.airport_name, s.airport_code) as airport_name, s.city_name, s.state,
               h.latitude, h.longitude, h.airport_code is not null as is_hub
        from (select airport_code, min(city_name) as city_name, min(state) as state
              from (select unnest([{'a': origin, 'c': origin_city, 's': origin_state}, {'a': dest, 'c': dest_city, 's': dest_state}]) as x from flights)
                   t(x), lateral (select x.a as airport_code, x.c as city_name, x.s as state)
              group by airport_code) s
        left join seed_hubs h on h.airport_code = s.airport_code""",
    "carriers_seen": """
        select f.carrier_code, ifnull(c.carrier_name, f.carrier_code) as carrier_name, ifnull(c.carrier_type, 'Other') as carrier_type
        from (select carrier_code from flights group by carrier_code) f left join seed_carriers c on c.carrier_code = f.carrier_code""",
    "kpis": """
        select ym as year_month, count(*) as flights, round(100 * avg(on_time), 2) + 0.0 as on_time_pct,
               round(avg(arr_delay_min) filter (where is_completed), 2) + 0.0 as avg_arr_delay_min,
               round(100 * avg(is_cancelled::int), 2) + 0.0 as cancellation_pct, round(100 * avg(is_diverted::int), 2) + 0.0 as diversion_pct,
               round((sum(carrier_delay_min) + sum(weather_delay_min) + sum(nas_delay_min) + sum(security_delay_min)
                      + sum(late_aircraft_delay_min)) / 60, 0) + 0.0 as total_delay_hours
        from facts group by ym""",
    "carrier_month": """
        select a.ym as year_month, a.carrier_code, c.carrier_name, c.carrier_type, flights, on_time_pct, avg_arr_delay_min, cancellation_pct,
               carrier_delay_hours, late_aircraft_delay_hours,
               1 + (select count(*) from carrier_group b where b.ym = a.ym and b.on_time_pct > a.on_time_pct) as on_time_rank
        from carrier_group a join carriers_seen c on c.carrier_code = a.carrier_code""",
    "carrier_group": """
        select ym, carrier_code, count(*) as flights, round(100 * avg(on_time), 2) + 0.0 as on_time_pct,
               round(avg(arr_delay_min) filter (where is_completed), 2) + 0.0 as avg_arr_delay_min,
               round(100 * avg(is_cancelled::int), 2) + 0.0 as cancellation_pct,
               round(sum(carrier_delay_min) / 60, 0) + 0.0 as carrier_delay_hours,
               round(sum(late_aircraft_delay_min) / 60, 0) + 0.0 as late_aircraft_delay_hours
        from facts group by ym, carrier_code""",
    "airport_day": """
        select flight_date, a.airport_code, a.airport_name, a.city_name, a.state, a.latitude, a.longitude, a.is_hub,
               departures, dep_delay_pct, avg_dep_delay_min, cancellation_pct, avg_taxi_out_min,
               max_hourly_precip_mm, max_hourly_snow_cm, max_wind_gust_kmh
        from (select flight_date, origin_code, count(*) as departures, round(100 * avg(is_dep_delayed::int), 2) + 0.0 as dep_delay_pct,
                     round(avg(dep_delay_min), 2) + 0.0 as avg_dep_delay_min, round(100 * avg(is_cancelled::int), 2) + 0.0 as cancellation_pct,
                     round(avg(taxi_out_min), 2) + 0.0 as avg_taxi_out_min, round(max(precipitation_mm), 2) + 0.0 as max_hourly_precip_mm,
                     round(max(snowfall_cm), 2) + 0.0 as max_hourly_snow_cm, round(max(wind_gusts_kmh), 1) + 0.0 as max_wind_gust_kmh
              from facts group by flight_date, origin_code) d
        join airports a on a.airport_code = d.origin_code""",
    "route_month": """
        select * from (
          select ym as year_month, route, origin_code, dest_code, round(avg(distance_miles), 0) + 0.0 as distance_miles, count(*) as flights,
                 count(distinct carrier_code) as carriers, round(100 * avg(on_time), 2) + 0.0 as on_time_pct,
                 round(avg(arr_delay_min) filter (where is_completed), 2) + 0.0 as avg_arr_delay_min,
                 round(100 * avg(is_cancelled::int), 2) + 0.0 as cancellation_pct
          from facts group by ym, route, origin_code, dest_code)
        where flights >= 30""",
    "cause_month": """
        select year_month, cause, round(minutes / 60, 0) + 0.0 as delay_hours,
               round(100 * minutes / nullif(sum(minutes) over (partition by year_month), 0), 2) + 0.0 as share_pct
        from (select ym as year_month, 'Carrier' as cause, sum(carrier_delay_min) as minutes from facts group by ym
              union all select ym, 'Weather', sum(weather_delay_min) from facts group by ym
              union all select ym, 'National Air System', sum(nas_delay_min) from facts group by ym
              union all select ym, 'Security', sum(security_delay_min) from facts group by ym
              union all select ym, 'Late aircraft', sum(late_aircraft_delay_min) from facts group by ym)""",
    "impact": """
        select g.*, round(g.dep_delay_pct - calm.dep_delay_pct, 2) + 0.0 as delay_uplift_pp
        from impact_group g left join impact_group calm
          on calm.airport_code = g.airport_code and calm.weather_condition = 'Dry & calm'""",
    "impact_group": """
        select airport_code, weather_condition, count(*) as departures, round(100 * avg(is_dep_delayed::int), 2) + 0.0 as dep_delay_pct,
               round(avg(dep_delay_min), 2) + 0.0 as avg_dep_delay_min, round(100 * avg(is_cancelled::int), 2) + 0.0 as cancellation_pct
        from (select *, unnest([origin_code, 'ALL HUBS']) as airport_code from facts where has_weather)
        group by airport_code, weather_condition""",
    "hour_profile": """
        select scheduled_dep_hour, count(*) as departures, round(100 * avg(is_dep_delayed::int), 2) + 0.0 as dep_delay_pct,
               round(avg(dep_delay_min), 2) + 0.0 as avg_dep_delay_min,
               round(100 * avg(if(late_aircraft_delay_min > 0, 1, 0)), 2) + 0.0 as late_aircraft_pct
        from facts where not is_cancelled group by scheduled_dep_hour""",
}

_NAMES = re.compile(r"\b(" + "|".join(TABLES) + r")\b")


def with_tables(sql: str, **changed: str) -> str:
    """Prefix ``sql`` with the common tables it names, directly or through others.

    ``changed`` puts a condition on the rows of some tables.
    """
    tables = {**TABLES, **{n: f"select * from ({TABLES[n]}) where {c}" for n, c in changed.items()}}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name not in needed and tables[name] is not text:
                visit(tables[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    common = ",\n".join(f"{name} as ({tables[name]})" for name in needed)
    body = sql.strip()
    joined = f",\n{body[4:].lstrip()}" if body.lower().startswith("with ") else f"\n{body}"
    return f"with {common}{joined}"
