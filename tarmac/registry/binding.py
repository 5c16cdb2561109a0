"""Flights, weather and seeds derived from the driver's tables, in the bronze shape.

The lake is laid out as in production: bronze, the matched silver flights and the
dimensions are written once per application to the shared folder, everything else is
a lazy plan over them. So the line items are joined and the flights de-duplicated once, however
many queries follow, and those queries read only the columns they name. The written
tables belong to the exact source files (path, size, time); changed files are bound
anew.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import fits_broadcast
from tarmac.plans import marts
from tarmac.plans.staging import stg_flights, stg_weather
from tarmac.plans.star import dim_airport, dim_carrier, dim_date, fct_flights, int_flights_weather
from tarmac.session import scratch_path, side_by_side
from tarmac.sources import seeds

_SOURCES = ["lineitem", "orders", "customer", "supplier", "nation", "events"]
_WRITTEN: dict[tuple, str] = {}


def month_number(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def by_month(flights: DataFrame) -> DataFrame:
    return flights.withColumn("ym", month_number(F.col("flight_date")))


def airport_code(nation: Column) -> Column:
    return F.concat(F.lit("A"), F.lpad(nation.cast("string"), 2, "0"))


class Tables:
    """The tables as one query sees them: source version and scans are looked up once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._scans: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- written once -----------------------------------------------------------------------

    @cached_property
    def _stamp(self) -> tuple:
        """What identifies the source files: one row from a listing of six tables, no data."""
        files = self.spark.read.format("binaryFile").load([f"{self.sf_dir}/{n}.parquet" for n in _SOURCES])
        return tuple(files.agg(
            F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
        ).first())

    def _key(self, name: str) -> tuple:
        return (self.spark.sparkContext.applicationId, self._stamp, name)

    def once(self, name: str, write: Callable[[], str]) -> str:
        """The path ``write`` wrote for these source files, on first use."""
        key = self._key(name)
        if key not in _WRITTEN:
            _WRITTEN[key] = write()
        return _WRITTEN[key]

    def _table(self, name: str, build: Callable[[], DataFrame], *by: str) -> DataFrame:
        """The table ``name``, written on first use.

        Bronze and silver lie by month. The bound flights fall into two months, so every task
        writes at most two files, side by side, and neither a shuffle nor a sort is spent on the layout.
        """
        def write() -> str:
            path = scratch_path(self.spark, name)
            rows = build()
            with side_by_side(self.spark):
                rows.write.option("compression", "zstd").partitionBy(*by).parquet(path)
            return path

        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(self.once(name, write))
        return self._scans[name]

    def bronze_flights(self) -> DataFrame:
        return self._table("bronze-flights", self._dated_flights, "year", "month").drop("year", "month")

    def bronze_weather(self) -> DataFrame:
        return self._table("bronze-weather", self.derive_weather)

    def staged(self) -> DataFrame:
        """De-duplicated flights before they meet the weather: what the checks hold the facts against."""
        return self._table("staged", lambda: by_month(self.stg_flights()), "ym").drop("ym")

    def silver(self) -> DataFrame:
        return self._table("silver", self._silver_by_month, "ym").drop("ym")

    def _silver_by_month(self) -> DataFrame:
        """The matched flights; staged ones that are written are not de-duplicated again."""
        return by_month(self.int_flights_weather(self.staged() if self._key("staged") in _WRITTEN else None))

    def facts_of_month(self, year_month: str) -> DataFrame:
        """Facts of one month, read from its folder."""
        silver = self._table("silver", self._silver_by_month, "ym")
        return fct_flights(silver.filter(F.col("ym") == int(year_month.replace("-", ""))).drop("ym"))

    # --- bronze from the driver's tables ----------------------------------------------------

    def _dated_flights(self) -> DataFrame:
        day = F.col("flight_date").cast("date")
        return self.derive_flights().withColumns({"year": F.year(day), "month": F.month(day)})

    def derive_flights(self) -> DataFrame:
        """Every line item as a flight, with re-ingested copies of every fiftieth order.

        Customers join orders first, so the line items are shuffled once for that pair; the
        hint keeps small line items from being broadcast, which would leave one task.
        """
        buyers = self["orders"].join(self["customer"], F.col("o_custkey") == F.col("c_custkey")).selectExpr(
            "o_orderkey as l_orderkey", "c_nationkey as cn")
        sellers = self["supplier"].selectExpr("s_suppkey as l_suppkey", "s_nationkey as sn")
        nations = self["nation"]
        lines = (
            self["lineitem"]
            .join(buyers.hint("merge"), "l_orderkey")
            .join(sellers, "l_suppkey")
            .join(nations.selectExpr("n_nationkey as sn", "n_name as on", "n_regionkey as oreg"), "sn")
            .join(nations.selectExpr("n_nationkey as cn", "n_name as dn", "n_regionkey as dreg"), "cn")
        )
        codes = ", ".join(f"'{r[0]}'" for r in seeds.seed_rows(seeds.CARRIER_ROWS))
        slot, price = "(l_orderkey * 7 + l_linenumber) % 25", "cast(floor(l_extendedprice) as bigint)"
        derived = lines.selectExpr(
            "*",
            "date_add(date '2024-01-01', cast(datediff(cast(l_shipdate as date), date '1995-01-01') % 60 as int)) as fd",
            f"{price} % 37 = 0 as canc",
            f"{price} % 101 = 1 and not {price} % 37 = 0 as divr",
            f"not {price} % 37 = 0 and not {price} % 101 = 1 as comp",
            f"case when {slot} = 24 then 2400 else cast({slot} * 100 + (l_partkey % 12) * 5 as int) end as crs",
            "60 + (sn * 25 + cn) % 300 as el",
            "l_linenumber - 4 as adj",
            "explode(if(l_orderkey % 50 = 0, array(0, 1), array(0))) as copy",
        ).selectExpr("*", "cast(floor(l_quantity) as int) * 3 - 90 + 6 * copy as dd").selectExpr("*", "dd + adj as ad").selectExpr(
            "*",
            "comp and ad >= 15 as late",
            "timestamp_ntz '2024-03-01 00:00:00' + make_dt_interval(copy, 0, 0, l_partkey) as ing",
        )
        return derived.selectExpr(
            "cast(fd as string) as flight_date",
            f"element_at(array({codes}, 'X1', 'X2'), cast(l_partkey % 26 as int) + 1) as carrier_code",
            "cast(l_orderkey as string) as flight_number",
            "case when l_partkey % 29 = 0 then '' else concat('N', cast(l_suppkey as string)) end as tail_number",
            "concat('A', lpad(cast(sn as string), 2, '0')) as origin",
            "on as origin_city",
            "concat('R', cast(oreg as string)) as origin_state",
            "concat('A', lpad(cast(cn as string), 2, '0')) as dest",
            "dn as dest_city",
            "concat('R', cast(dreg as string)) as dest_state",
            "cast(crs as smallint) as crs_dep_time",
            "cast(case when not canc then crs end as smallint) as dep_time",
            "cast(case when not canc then dd end as double) as dep_delay",
            "cast(case when not canc then if(dd >= 15, 1, 0) end as double) as dep_del15",
            "cast(case when not canc then 10 + l_partkey % 25 end as double) as taxi_out",
            "cast(case when comp then 3 + l_suppkey % 12 end as double) as taxi_in",
            "cast((crs % 2400 + 200) % 2400 as smallint) as crs_arr_time",
            "cast(case when comp then (crs % 2400 + 200) % 2400 end as smallint) as arr_time",
            "cast(case when comp then ad end as double) as arr_delay",
            "cast(case when comp then if(ad >= 15, 1, 0) end as double) as arr_del15",
            "cast(canc as double) as cancelled",
            "if(canc, substr('ABCD', cast(l_orderkey % 4 as int) + 1, 1), '') as cancellation_code",
            "cast(divr as double) as diverted",
            "cast(el as double) as crs_elapsed_time",
            "cast(case when comp then el + adj end as double) as actual_elapsed_time",
            "cast(case when comp then el - 25 end as double) as air_time",
            "cast(100 + 40 * abs(sn - cn) as double) as distance",
            "cast(case when late then ad div 3 end as double) as carrier_delay",
            "cast(case when late then ad % 5 end as double) as weather_delay",
            "cast(case when late then ad % 4 end as double) as nas_delay",
            "cast(case when late then if(ad % 11 = 0, 1, 0) end as double) as security_delay",
            "cast(case when late then ad - ad div 3 - ad % 5 - ad % 4 - if(ad % 11 = 0, 1, 0) end as double) as late_aircraft_delay",
            "ing as _ingested_at",
        )

    def derive_weather(self) -> DataFrame:
        """Every event as an hourly observation; many repeat an airport and hour."""
        whole = "cast(floor(value) as int)"
        return self["events"].selectExpr(
            "concat('A', lpad(cast(user_id % 15 as string), 2, '0')) as airport_code",
            "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0) as weather_time",
            "cast(event_id % 40 - 5 as double) as temperature_2m",
            f"if(event_type = 'purchase', {whole} % 7, 0) * 0.5D as precipitation",
            "cast(event_type = 'error' as double) as snowfall",
            f"cast({whole} % 40 as double) as wind_speed_10m",
            f"cast({whole} % 70 as double) as wind_gusts_10m",
            "cast(event_id % 101 as double) as cloud_cover",
            "cast(event_id % 100 as int) as weather_code",
            "'UTC' as timezone",
            "ts as _ingested_at",
            "event_id as _tie",
        )

    # --- seeds ------------------------------------------------------------------------------

    def carriers(self) -> DataFrame:
        return seeds.carriers(self.spark)

    def hubs(self) -> DataFrame:
        return self["nation"].filter(F.col("n_nationkey") < 15).select(
            airport_code(F.col("n_nationkey")).alias("airport_code"),
            F.expr("concat(n_name, ' Intl')").alias("airport_name"),
            F.col("n_name").alias("city"),
            F.expr("concat('R', cast(n_regionkey as string))").alias("state"),
            F.expr("25.0D + n_nationkey").alias("latitude"),
            F.expr("-70.0D - 2 * n_nationkey").alias("longitude"),
        )

    # --- silver and core --------------------------------------------------------------------

    def stg_flights(self) -> DataFrame:
        return stg_flights(self.bronze_flights())

    def stg_weather(self) -> DataFrame:
        return stg_weather(self.bronze_weather(), ties=[F.desc("_tie")])

    def int_flights_weather(self, flights: DataFrame | None = None) -> DataFrame:
        """Flights, those of bronze unless given, with weather; the hours are measured on the bronze keys before the join."""
        weather = self.bronze_weather()
        small = fits_broadcast(weather.select("airport_code", "weather_time"))
        return int_flights_weather(self.stg_flights() if flights is None else flights, self.stg_weather(), small)

    def facts(self) -> DataFrame:
        return fct_flights(self.silver())

    def dim_airport(self) -> DataFrame:
        return self._table("dim-airport", self.derive_dim_airport)

    def dim_carrier(self) -> DataFrame:
        return self._table("dim-carrier", self.derive_dim_carrier)

    def dim_date(self) -> DataFrame:
        return self._table("dim-date", self.derive_dim_date)

    def derive_dim_airport(self) -> DataFrame:
        return dim_airport(self.silver(), self.hubs())

    def derive_dim_carrier(self) -> DataFrame:
        return dim_carrier(self.silver(), self.carriers())

    def derive_dim_date(self) -> DataFrame:
        return dim_date(self.silver())

    # --- marts as written -------------------------------------------------------------------

    def mart(self, name: str) -> DataFrame:
        """A mart, written on first use, as the serving queries and the checks read it."""
        builders: dict[str, Callable[[], DataFrame]] = {
            "mart_kpis_monthly": lambda: marts.mart_kpis_monthly(self.facts()),
            "mart_carrier_monthly": lambda: marts.mart_carrier_monthly(self.facts(), self.carriers()),
            "mart_airport_daily": lambda: marts.mart_airport_daily(self.facts(), self.dim_airport()),
            "mart_route_monthly": lambda: marts.mart_route_monthly(self.facts()),
            "mart_delay_causes_monthly": lambda: marts.mart_delay_causes_monthly(self.facts()),
            "mart_weather_impact": lambda: marts.mart_weather_impact(self.facts()),
            "mart_hourly_profile": lambda: marts.mart_hourly_profile(self.facts()),
        }
        return self._table(name, builders[name])
