"""Generic operators straight on the driver's tables, and small expressions over bronze.

Windows run over grouped rows only; hot keys are combined before every shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import functions as fn
from tarmac import operators as op
from tarmac.registry.binding import Tables
from tarmac.registry.book import query


# --- projections and predicates -------------------------------------------------------------


@query("""select l_orderkey, l_linenumber, l_partkey, upper(trim(raw)) as code from
    (select *, '  ' || lower(l_returnflag) || l_linestatus || ' ' as raw from lineitem)""")
def p02_normal_code(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("  "), F.lower("l_returnflag"), "l_linestatus", F.lit(" "))
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", fn.normal_code(raw).alias("code"))


@query("""select event_id, nullif(trim(if(event_type = 'view', '   ', event_type || ' ')), '') as label from events""")
def p03_blank_to_null(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_type") == "view", "   ").otherwise(F.concat("event_type", F.lit(" ")))
    return t["events"].select("event_id", fn.blank_to_null(raw).alias("label"))


@query("""select o_orderkey, coalesce(case o_orderstatus when 'F' then 1.0 when 'O' then 0.0 end, 0) = 1 as is_done from orders""")
def p04_flag(t: Tables) -> DataFrame:
    number = F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.0)
    return t["orders"].select("o_orderkey", fn.flag(number).alias("is_done"))


@query("""select l_orderkey, l_partkey, l_linenumber, md5(concat_ws('|', l_orderkey, if(l_linenumber = 2, null, l_linenumber), l_returnflag)) as id
    from lineitem""")
def p06_surrogate_key(t: Tables) -> DataFrame:
    middle = F.when(F.col("l_linenumber") != 2, F.col("l_linenumber"))
    key = fn.natural_key(F.col("l_orderkey"), middle, F.col("l_returnflag"))
    return t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", F.md5(key).alias("id"))


@query("""select hhmm, if(hhmm >= 2400, 0, hhmm // 100)::int as hour, if(hhmm >= 2400, 0, hhmm % 100)::int as minute, count(*) as rows
    from (select ((l_orderkey % 26) * 100 + l_partkey % 60)::int as hhmm from lineitem) group by all""")
def p07_hhmm_parts(t: Tables) -> DataFrame:
    clock = t["lineitem"].select(F.expr("cast((l_orderkey % 26) * 100 + l_partkey % 60 as int)").alias("hhmm"))
    c = F.col("hhmm")
    return clock.groupBy("hhmm").agg(F.count(F.lit(1)).alias("rows")).select(
        "hhmm", fn.hhmm_hour(c).alias("hour"), fn.hhmm_minute(c).alias("minute"), "rows"
    )


@query("""select o_orderkey, o_orderdate::date + to_minutes(o_orderkey % 1440) as at, date_trunc('hour', o_orderdate::date + to_minutes(o_orderkey % 1440)) as hour from orders""")
def p08_wall_clock(t: Tables) -> DataFrame:
    minute = F.col("o_orderkey") % 1440
    at = fn.wall_clock(
        F.col("o_orderdate").cast("date"), F.floor(minute / 60).cast("int"), (minute % 60).cast("int")
    )
    return t["orders"].select("o_orderkey", at.alias("at")).withColumn("hour", fn.hour_bucket(F.col("at")))


@query("""select airport_code, weather_time, _tie, case when snowfall > 0 then 'Snow' when precipitation >= 2.5 then 'Heavy rain'
    when precipitation > 0 then 'Light rain' when wind_gusts_10m >= 50 then 'Strong wind' else 'Dry & calm' end as weather_condition from b_weather""")
def p10_weather_class(t: Tables) -> DataFrame:
    label = fn.weather_class(F.col("snowfall"), F.col("precipitation"), F.col("wind_gusts_10m"))
    return t.bronze_weather().select("airport_code", "weather_time", "_tie", label.alias("weather_condition"))


@query("""select strftime(o_orderdate, '%Y%m%d')::int as date_key, strftime(o_orderdate, '%Y-%m') as year_month, count(*) as orders from orders group by all""")
def p12_date_key(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t["orders"].groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("orders")).select(
        fn.date_key(F.col("_day")).alias("date_key"), fn.month_label(F.col("_day")).alias("year_month"), "orders"
    )


@query("""select case cancellation_code when 'A' then 'Carrier' when 'B' then 'Weather' when 'C' then 'National Air System' when 'D' then 'Security' end as reason,
    origin || '-' || dest as route, count(*) as rows from flights group by all""")
def p14_reason_and_route(t: Tables) -> DataFrame:
    flights = t.silver().groupBy("cancellation_code", "origin", "dest").agg(F.count(F.lit(1)).alias("n"))
    named = flights.select(
        fn.cancellation_reason(F.col("cancellation_code")).alias("reason"),
        fn.route_label(F.col("origin"), F.col("dest")).alias("route"),
        "n",
    )
    return named.groupBy("reason", "route").agg(F.sum("n").alias("rows"))


@query("""select is_cancelled, is_diverted, dep_delay_min >= 15 as behind, if(is_cancelled, null, dep_delay_min >= 15) as is_dep_delayed,
    if(is_cancelled or is_diverted, null, arr_delay_min >= 15) as is_arr_delayed, count(*) as rows from flights group by all""")
def p15_outcome_flags(t: Tables) -> DataFrame:
    gone, diverted = F.col("is_cancelled"), F.col("is_diverted")
    return t.silver().groupBy(
        "is_cancelled", "is_diverted",
        (F.col("dep_delay_min") >= 15).alias("behind"),
        fn.is_late(F.col("dep_delay_min"), gone).alias("is_dep_delayed"),
        fn.is_late(F.col("arr_delay_min"), gone | diverted).alias("is_arr_delayed"),
    ).agg(F.count(F.lit(1)).alias("rows"))


# --- joins ----------------------------------------------------------------------------------


@query("""select o_orderkey, o_custkey, e.events from orders left join
    (select user_id, date_trunc('hour', ts)::date as day, count(*) as events from events group by all) e
    on e.user_id = o_custkey and e.day = date '2024-01-01' + (o_orderkey % 30)::int""")
def j01_lookup_join(t: Tables) -> DataFrame:
    """Left equi-join on a code and a time bucket; the lookup is broadcast only if measured small."""
    events = t["events"].select("user_id", F.col("ts").cast("date").alias("day"))
    lookup = events.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("events"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    joined = op.join_lookup(
        t["orders"].select("o_orderkey", "o_custkey"), lookup,
        (F.col("user_id") == F.col("o_custkey")) & (F.col("day") == day), "left", op.fits_broadcast(events),
    )
    return joined.select("o_orderkey", "o_custkey", "events")


@query("""select l_orderkey, count(*) as rows from lineitem where not exists
    (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P') group by 1""")
def j08_orphans(t: Tables) -> DataFrame:
    parents = t["orders"].filter(F.col("o_orderstatus") != "P")
    return op.orphans(t["lineitem"], "l_orderkey", parents, "o_orderkey")


# --- aggregations ---------------------------------------------------------------------------


@query("""select o_orderstatus, o_orderpriority, count(*) as orders, round(100 * avg((o_totalprice > 250000)::int), 2) + 0.0 as large_pct,
    round(avg(o_orderkey % 100) filter (where o_orderpriority <> '5-LOW'), 2) + 0.0 as mean_key,
    round(sum(o_orderkey % 60) / 60, 0) + 0.0 as total_hours, count(distinct year(o_orderdate)) as years from orders group by all""")
def a02_rates(t: Tables) -> DataFrame:
    """Rate, conditional mean, hours total and exact distinct count in one grouping."""
    remainder = (F.col("o_orderkey") % 100).cast("double")
    return t["orders"].groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        fn.percent(F.col("o_totalprice") > 250000).alias("large_pct"),
        fn.rounded(F.avg(F.when(F.col("o_orderpriority") != "5-LOW", remainder)), 2).alias("mean_key"),
        fn.hours(F.col("o_orderkey") % 60).alias("total_hours"),
        F.count_distinct(F.year("o_orderdate")).alias("years"),
    )


@query("""select p_brand, count(*) as parts, min(p_size) as smallest, max(p_size) as largest from part group by 1 having count(*) >= 30""")
def a13_having(t: Tables) -> DataFrame:
    grouped = t["part"].groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"), F.min("p_size").alias("smallest"),
        F.max("p_size").alias("largest"),
    )
    return grouped.filter(F.col("parts") >= 30)


@query("""select l_returnflag, l_linestatus, sum(l_quantity) as quantity, count(*) as lines from lineitem group by all
    union all select 'ALL FLAGS', l_linestatus, sum(l_quantity), count(*) from lineitem group by l_linestatus""")
def a14_total_level(t: Tables) -> DataFrame:
    partials = t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("_quantity"), F.count(F.lit(1)).alias("_lines"))
    return op.with_total_level(
        partials, "l_returnflag", ["l_linestatus"], "ALL FLAGS",
        [F.sum("_quantity").alias("quantity"), F.sum("_lines").alias("lines")],
    )


@query("""select c_mktsegment, round(ifnull(sum(pct * n), 0) / sum(n), 6) + 0.0 as pct from
    (select c_mktsegment, c_nationkey, count(*) as n, round(100 * avg((c_acctbal > 5000)::int), 2) + 0.0 as pct from customer group by all) group by 1""")
def a15_weighted_mean(t: Tables) -> DataFrame:
    daily = t["customer"].groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), fn.percent(F.col("c_acctbal") > 5000).alias("pct"))
    mean = op.weighted_mean(F.col("pct"), F.col("n"))
    return daily.groupBy("c_mktsegment").agg(fn.rounded(mean, 6).alias("pct"))


@query("""select p_brand, p_size, n as parts from (select p_brand, p_size, count(*) as n from part group by all) g
    where n >= (select quantile_cont(h.n, 0.5) from (select p_size, count(*) as n from part where part.p_brand = g.p_brand group by 1) h)""")
def a17_median_filter(t: Tables) -> DataFrame:
    sizes = t["part"].groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("parts"))
    return op.at_least_median(sizes, "parts", ["p_brand"])


# --- windows --------------------------------------------------------------------------------


@query("""select distinct on (l_orderkey, l_linenumber) l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from lineitem
    order by l_orderkey, l_linenumber, l_shipdate desc, l_partkey desc, l_suppkey desc""")
def w01_latest_by(t: Tables) -> DataFrame:
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = [F.desc_nulls_last(c) for c in ("l_shipdate", "l_partkey", "l_suppkey")]
    return op.latest_by(lines, ["l_orderkey", "l_linenumber"], order)


@query("""select month, l_returnflag, lines, rank() over (partition by month order by lines desc) as place from
    (select strftime(l_shipdate, '%Y-%m') as month, l_returnflag, round(count(*) / 10, 0) + 0.0 as lines from lineitem group by all)""")
def w03_rank(t: Tables) -> DataFrame:
    """Ranks of rounded values, so ties leave gaps."""
    grouped = t["lineitem"].groupBy(
        fn.month_start(F.col("l_shipdate").cast("date")).alias("_month"), "l_returnflag"
    ).agg(fn.rounded(F.count(F.lit(1)) / 10, 0).alias("lines"))
    return grouped.select(
        fn.month_label(F.col("_month")).alias("month"), "l_returnflag", "lines",
        op.rank_desc("lines", ["_month"]).alias("place"),
    )


@query("""select year, o_orderpriority, orders, round(100 * orders / nullif(sum(orders) over (partition by year), 0), 2) + 0.0 as share_pct from
    (select year(o_orderdate)::int as year, o_orderpriority, count(*)::double as orders from orders group by all)""")
def w04_share_of_total(t: Tables) -> DataFrame:
    grouped = t["orders"].groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(
        F.count(F.lit(1)).cast("double").alias("orders"))
    return grouped.withColumn("share_pct", op.share_of_total("orders", ["year"]))


@query("""select o_orderpriority, o_orderstatus, mean_key, round(mean_key - max(if(o_orderstatus = 'F', mean_key, null)) over (partition by o_orderpriority), 2) + 0.0 as uplift
    from (select o_orderpriority, o_orderstatus, round(avg(o_custkey % 97), 2) + 0.0 as mean_key from orders group by all)""")
def w05_uplift(t: Tables) -> DataFrame:
    grouped = t["orders"].groupBy("o_orderpriority", "o_orderstatus").agg(
        fn.rounded(F.avg(F.col("o_custkey") % 97), 2).alias("mean_key"))
    uplift = op.uplift_over("mean_key", F.col("o_orderstatus") == "F", ["o_orderpriority"])
    return grouped.withColumn("uplift", uplift)


@query("""select month, orders, orders - lag(orders) over (order by month) as change from
    (select strftime(o_orderdate, '%Y-%m') as month, count(*) as orders from orders group by 1)""")
def w06_delta(t: Tables) -> DataFrame:
    months = t["orders"].groupBy(fn.month_start(F.col("o_orderdate").cast("date")).alias("_month")).agg(
        F.count(F.lit(1)).alias("orders"))
    return months.select(
        fn.month_label(F.col("_month")).alias("month"), "orders",
        op.change_from_previous("orders", "_month").alias("change"),
    )


# --- sorts, set operations, reshaping -------------------------------------------------------


@query("""select c_custkey, c_acctbal from customer order by c_acctbal desc nulls last, c_custkey limit 10""")
def o02_top_k(t: Tables) -> DataFrame:
    return op.top_k(t["customer"].select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 10)


@query("""select c_custkey, c_acctbal from customer order by c_acctbal nulls last, c_custkey limit 15""")
def o03_bottom_k(t: Tables) -> DataFrame:
    return op.bottom_k(t["customer"].select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 15)


@query("""select event_type, count(*) as events from events where event_type in ('purchase', 'view', 'error') group by 1""")
def o05_fixed_order(t: Tables) -> DataFrame:
    counts = t["events"].groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return op.in_order(counts, "event_type", ["purchase", "view", "never", "error"])


@query("""select l_returnflag, max(l_shipdate) as last_day, (select max(m.l_orderkey) from lineitem m
    where m.l_returnflag = l.l_returnflag and m.l_shipdate = max(l.l_shipdate)) as orderkey from lineitem l group by 1""")
def o06_arg_max(t: Tables) -> DataFrame:
    """Per day first: a largest key beside a date stays a fixed-width, hashed aggregate."""
    days = t["lineitem"].groupBy("l_returnflag", "l_shipdate").agg(F.max("l_orderkey").alias("orderkey"))
    return days.groupBy("l_returnflag").agg(
        F.max("l_shipdate").alias("last_day"), F.max_by("orderkey", "l_shipdate").alias("orderkey")
    )


@query("""select c_nationkey as nationkey from customer union select s_nationkey from supplier""")
def u01_union_distinct(t: Tables) -> DataFrame:
    buyers = t["customer"].select(F.col("c_nationkey").alias("nationkey"))
    return buyers.union(t["supplier"].select("s_nationkey")).distinct()


@query("""select 'customer' as kind, c_nationkey as nationkey, count(*) as n from customer group by all
    union all select 'supplier', s_nationkey, count(*) from supplier group by all""")
def u02_union_all(t: Tables) -> DataFrame:
    def counted(table: str, key: str) -> DataFrame:
        return t[table].groupBy(F.col(key).alias("nationkey")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(table).alias("kind"), "nationkey", "n")

    return counted("customer", "c_nationkey").unionByName(counted("supplier", "s_nationkey"))


@query("""select o_orderpriority, 'Open' as status, count(*) filter (where o_orderstatus = 'O')::double as orders from orders group by 1 having orders > 0
    union all select o_orderpriority, 'Filled', count(*) filter (where o_orderstatus = 'F')::double as orders from orders group by 1 having orders > 0
    union all select o_orderpriority, 'In part', null from orders group by 1 having false""")
def r01_unpivot(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    wide = t["orders"].groupBy("o_orderpriority").agg(
        F.nullif(F.count_if(status == "O"), F.lit(0)).cast("double").alias("o"),
        F.nullif(F.count_if(status == "F"), F.lit(0)).cast("double").alias("f"),
        F.lit(None).cast("double").alias("p"),
    )
    return op.unpivot_named(wide, ["o_orderpriority"], {"Open": "o", "Filled": "f", "In part": "p"}, "status", "orders")


@query("""select l_returnflag, sum(l_quantity) filter (where l_linestatus = 'O') as "O", sum(l_quantity) filter (where l_linestatus = 'F') as "F"
    from lineitem group by 1""")
def r02_pivot(t: Tables) -> DataFrame:
    return op.pivot_fixed(t["lineitem"], "l_returnflag", "l_linestatus", ["O", "F"], F.sum("l_quantity"))


# --- scalar functions -----------------------------------------------------------------------


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / 7, 2) + 0.0 as two, round(l_extendedprice / 7, 0) + 0.0 as zero,
    round(l_partkey * 0.005::double + 1, 2) + 0.0 as halves from lineitem""")
def x01_rounded(t: Tables) -> DataFrame:
    seventh = F.col("l_extendedprice") / 7
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.rounded(seventh, 2).alias("two"),
        fn.rounded(seventh, 0).alias("zero"),
        fn.rounded(F.col("l_partkey") * F.lit(0.005) + 1, 2).alias("halves"),
    )


@query("""select event_id, cast(event_id / 2.0::double as integer) as half, cast(value as integer) as whole from events""")
def x02_half_even_int(t: Tables) -> DataFrame:
    return t["events"].select(
        "event_id",
        fn.half_even_int(F.col("event_id") / 2).alias("half"),
        fn.half_even_int(F.col("value")).alias("whole"),
    )


@query("""select o_orderdate::date as day, strftime(o_orderdate, '%b') as month_short, strftime(o_orderdate, '%a') as day_name,
    isodow(o_orderdate)::int as day_of_week, quarter(o_orderdate)::int as quarter, count(*) as orders from orders group by all""")
def x04_date_labels(t: Tables) -> DataFrame:
    day = F.col("day")
    days = t["orders"].groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return days.select(
        "day", F.date_format(day, "MMM").alias("month_short"), F.date_format(day, "E").alias("day_name"),
        (F.weekday(day) + 1).alias("day_of_week"), F.quarter(day).alias("quarter"), "orders",
    )


@query("""select event_id, date_trunc('hour', ts) as hour from events""")
def x07_hour_bucket(t: Tables) -> DataFrame:
    return t["events"].select("event_id", fn.hour_bucket(F.col("ts")).alias("hour"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(least(l_discount, if(l_linenumber = 1, null, l_tax)), 0) as low,
    l_linenumber / 2 as half from lineitem""")
def x10_least_and_division(t: Tables) -> DataFrame:
    tax = F.when(F.col("l_linenumber") != 1, F.col("l_tax"))
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.coalesce(F.least("l_discount", tax), F.lit(0.0)).alias("low"),
        (F.col("l_linenumber") / 2).alias("half"),
    )


@query("""select flight_date, count(*) as rows, count(tail_number) as tails, sum(distance_miles) as miles, max(_ingested_at) as last_ingest
    from flights group by 1""")
def s09_silver_by_day(t: Tables) -> DataFrame:
    return t.silver().groupBy("flight_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count("tail_number").alias("tails"),
        F.sum("distance_miles").alias("miles"), F.max("_ingested_at").alias("last_ingest"),
    )
