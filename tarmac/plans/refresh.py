"""The refresh job: ingest a window of months, rebuild what changed, check, publish.

What to rebuild is read off bronze itself: a build remembers a stamp of each bronze month's
files and the months its rows are dated in. Months whose files changed since, however they
came, make the months stale that their old or new rows are dated in, and exactly these are
rebuilt, from every bronze month that holds rows of them. The natural key holds the flight date
and weather is matched within the day, so a month of silver and facts depends on nothing else.
Dimensions and marts are kept as partial aggregates per month and finished from all of them.
Partials are as small as marts: at most days x airports rows.

A build writes new folders only. The checks look at them, and only if all hold does an
appended list make them current (``tarmac.sources.versions``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators import fits_broadcast
from tarmac.plans import ingest, marts, quality, star
from tarmac.plans.staging import stg_flights, stg_weather
from tarmac.schemas import BRONZE_FLIGHTS, BRONZE_WEATHER
from tarmac.session import side_by_side
from tarmac.sources import landing as landed
from tarmac.sources import seeds
from tarmac.sources.lake import MARTS, bronze_path, month_stamps, read_bronze
from tarmac.sources.versions import (
    MONTH, Entry, Snapshot, append_snapshot, drop_unused, partition_months, read_snapshot, read_version,
    sole_writer, table_path,
)

log = logging.getLogger(__name__)

DAYS = {"flights": "flight_date", "weather": "weather_time"}


class QualityError(RuntimeError):
    """The refreshed tables break at least one check."""


def month_number(day: str) -> F.Column:
    moment = F.col(day).cast("date")
    return F.year(moment) * 100 + F.month(moment)


@dataclass
class Lake:
    """A lake as one build sees it: ``snapshot`` is what it makes, ``months`` what it rebuilds."""

    spark: SparkSession
    root: str
    snapshot: Snapshot
    months: set[int] = field(default_factory=set)
    changed: set[tuple[str, int]] = field(default_factory=set)

    def bronze(self, name: str, changed: bool = False) -> DataFrame:
        """Bronze rows dated in the rebuilt months, from the partitions that hold some; or the changed partitions."""
        schema = BRONZE_FLIGHTS if name == "flights" else BRONZE_WEATHER
        held = {ym for ym, e in self.snapshot.months("bronze", name).items() if self.months & set(e.months)}
        wanted = {ym for n, ym in self.changed if n == name} & set(self.snapshot.months("bronze", name)) if changed else held
        if not wanted:
            return self.spark.createDataFrame([], schema)
        rows = read_bronze(self.spark, self.root, name).filter((F.col("year") * 100 + F.col("month")).isin(sorted(wanted)))
        return rows if changed else rows.filter(month_number(DAYS[name]).isin(sorted(self.months)))

    def read(self, layer: str, name: str, touched: bool = False) -> DataFrame:
        return read_version(
            self.spark, self.root, self.snapshot, layer, name, self.months if touched else None).drop(MONTH)

    def _folder(self, layer: str, name: str) -> str:
        return f"{table_path(self.root, layer, name)}/build={self.snapshot.build}"

    def write(self, df: DataFrame, layer: str, name: str, day: str) -> None:
        """The rebuilt months of a table; a month without rows is gone from it.

        Rows come by month, as bronze and what is made of it lie, so no row moves for the layout.
        """
        rows = df.select("*", month_number(day).alias(MONTH))
        written: list[int] = []
        if self.months:
            folder = self._folder(layer, name)
            with side_by_side(self.spark):
                rows.write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH).parquet(folder)
            written = partition_months(self.spark, folder)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        entries, build = self.snapshot.entries, self.snapshot.build
        for ym in self.months:
            entries.pop((layer, name, ym), None)
        entries.update({(layer, name, ym): Entry(build) for ym in written})
        entries[layer, name, 0] = Entry(build, schema.json())

    def publish(self, df: DataFrame, name: str) -> None:
        """A whole dimension or mart; the adaptive plan merges its few rows into few files."""
        df.write.mode("overwrite").parquet(self._folder("gold", name))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        self.snapshot.entries["gold", name, 0] = Entry(self.snapshot.build, schema.json())

    def finish(
        self, name: str, partials: DataFrame, finish: Callable[[DataFrame], DataFrame], day: str = "_month"
    ) -> None:
        """Write the rebuilt months' partials and publish what all months' partials make."""
        self.write(partials, "partials", name, day)
        self.publish(finish(self.read("partials", name)), name)


def build_silver(lake: Lake) -> None:
    """Flights of the touched months with their weather, de-duplicated once for all readers."""
    weather = lake.bronze("weather")
    small = fits_broadcast(weather.select("airport_code", "weather_time"))
    flights = star.int_flights_weather(stg_flights(lake.bronze("flights")), stg_weather(weather), small)
    lake.write(flights, "silver", "int_flights_weather", "flight_date")


def _together(*steps: Callable[[], None]) -> None:
    """Independent writes at the same time, so the tail of one job overlaps the next."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def build_core(lake: Lake, carriers: DataFrame, hubs: DataFrame) -> None:
    silver = lake.read("silver", "int_flights_weather", touched=True)
    dated = silver.withColumn("_month", F.trunc("flight_date", "month"))
    codes = dated.select("_month", "carrier_code").distinct()
    _together(
        lambda: lake.write(star.fct_flights(silver), "gold", "fct_flights", "flight_date"),
        lambda: lake.finish(
            "dim_airport", star.airports_seen(dated, "_month"), lambda p: star.finish_airports(p, hubs)),
        lambda: lake.finish("dim_carrier", codes, lambda p: star.dim_carrier(p, carriers)),
        lambda: lake.finish("dim_date", star.dates_seen(dated, "_month"), star.finish_dates),
    )


def build_marts(lake: Lake, carriers: DataFrame) -> None:
    facts = lake.read("gold", "fct_flights", touched=True)
    airports = lake.read("gold", "dim_airport")
    _together(
        lambda: lake.finish("mart_kpis_monthly", marts.kpi_months(facts), marts.labelled),
        lambda: lake.finish(
            "mart_carrier_monthly", marts.carrier_months(facts), lambda p: marts.finish_carriers(p, carriers)),
        lambda: lake.finish(
            "mart_airport_daily", marts.airport_days(facts),
            lambda p: marts.finish_airport_days(p, airports), day="flight_date"),
        lambda: lake.finish("mart_route_monthly", marts.route_months(facts), marts.finish_routes),
        lambda: lake.finish("mart_delay_causes_monthly", marts.cause_months(facts), marts.finish_causes),
        lambda: lake.finish("mart_weather_impact", marts.weather_impact_partials(facts), marts.finish_weather_impact),
        lambda: lake.finish("mart_hourly_profile", marts.hourly_profile_partials(facts), marts.finish_hourly_profile),
    )


def _dated_in(spark: SparkSession, root: str, name: str, months: set[int]) -> dict[int, tuple[int, ...]]:
    """Of some bronze months the months their rows are dated in (a scan of one column)."""
    if not months:
        return {}
    own = F.col("year") * 100 + F.col("month")
    found = read_bronze(spark, root, name).filter(own.isin(sorted(months))).groupBy(own.alias("own")).agg(
        F.array_sort(F.collect_set(month_number(DAYS[name]))).alias("dated"))
    return {ym: () for ym in months} | {r.own: tuple(r.dated) for r in found.collect()}


def _seed_stamp(df: DataFrame) -> str:
    return str(df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.count("*")).first())


def plan_build(spark: SparkSession, root: str, carriers: DataFrame, hubs: DataFrame) -> Lake | None:
    """What the next build has to do; None if nothing changed since the last one."""
    old = read_snapshot(spark, root)
    snapshot = Snapshot(1) if old is None else old.next()
    stale: set[int] = set()
    changed: set[tuple[str, int]] = set()
    for name in DAYS:
        now = {y * 100 + m: s for (y, m), s in month_stamps(spark, bronze_path(root, name)).items()}
        before = snapshot.months("bronze", name)
        differ = {ym for ym in {*now, *before} if ym not in now or ym not in before or now[ym] != before[ym].stamp}
        dated = _dated_in(spark, root, name, differ & set(now))
        for ym in differ:
            stale |= {*(before[ym].months if ym in before else ()), *dated.get(ym, ())}
            snapshot.entries.pop(("bronze", name, ym), None)
            if ym in now:
                snapshot.entries["bronze", name, ym] = Entry(snapshot.build, now[ym], dated[ym])
        changed |= {(name, ym) for ym in differ}
    seeds_differ = False
    for name, df in (("carriers", carriers), ("hubs", hubs)):
        entry = Entry(snapshot.build, _seed_stamp(df))
        seeds_differ |= ("seed", name, 0) not in snapshot.entries or snapshot.entries["seed", name, 0].stamp != entry.stamp
        snapshot.entries["seed", name, 0] = entry
    if old is not None and not changed and not seeds_differ:
        return None
    return Lake(spark, root, snapshot, stale, changed)


def build(
    spark: SparkSession, root: str, carriers: DataFrame | None = None, hubs: DataFrame | None = None,
    checked: bool = False,
) -> list[int]:
    """Bring silver, core and marts up to bronze; returns the months rebuilt.

    Readers see the result only when it is complete and, if ``checked``, all checks hold.
    Repeating a build that broke off is safe: it starts from the last complete one. A second build
    at the same time is refused.
    """
    carriers = seeds.carriers(spark) if carriers is None else carriers
    hubs = seeds.hub_airports(spark) if hubs is None else hubs
    with sole_writer(spark, root):
        lake = plan_build(spark, root, carriers, hubs)
        if lake is None:
            return []
        build_silver(lake)
        build_core(lake, carriers, hubs)
        build_marts(lake, carriers)
        if checked:
            check(lake)
        append_snapshot(spark, root, lake.snapshot)
        drop_unused(spark, root, lake.snapshot)
        return sorted(lake.months)


def lake_tables(lake: Lake) -> dict[str, DataFrame]:
    """What the quality suite looks at, as written.

    Of the large tables the rebuilt months: every rule on them holds or breaks within a
    month. The small ones are taken whole.
    """
    gold = ["dim_carrier", "dim_airport", "dim_date", *MARTS]
    return {
        "bronze_flights": lake.bronze("flights", changed=True),
        "stg_flights": lake.read("silver", "int_flights_weather", touched=True),
        "stg_weather": stg_weather(lake.bronze("weather")),
        "fct_flights": lake.read("gold", "fct_flights", touched=True),
        **{name: lake.read("gold", name) for name in gold},
    }


def current(spark: SparkSession, root: str) -> Lake:
    """The lake as last published, all months of it."""
    snapshot = read_snapshot(spark, root)
    if snapshot is None:
        raise FileNotFoundError(f"no complete build in {root}")
    months = {m for name in DAYS for e in snapshot.months("bronze", name).values() for m in e.months}
    return Lake(spark, root, snapshot, months, {(n, ym) for n in DAYS for ym in snapshot.months("bronze", n)})


def check(lake: Lake) -> None:
    """Raise with the broken checks, if any."""
    broken = quality.report(lake_tables(lake)).filter(F.col("violations") > 0).collect()
    if broken:
        raise QualityError("; ".join(
            f"{r.check_name}({r.table_name}.{r.column_name}): {r.violations}" for r in broken))


def refresh(
    spark: SparkSession, landing: str, root: str, months: int = 12, transform: bool = True,
    force: bool = False, today: date | None = None,
    carriers: DataFrame | None = None, hubs: DataFrame | None = None,
) -> int:
    """Bring the lake up to the newest landed month; returns new flight rows.

    ``landing`` holds ``flights/`` and ``weather/``, listed once. A gap in the window's extracts
    is an error; missing weather is not. Rows and extracts that cannot be loaded are set aside (``plans.rejects``). ``hubs`` (with a ``position`` for the payloads' order, or
    in the order of its rows' codes) and ``carriers`` replace the built-in seeds.
    """
    extracts, payloads = f"{landing}/flights", f"{landing}/weather"
    day = F.current_date() if today is None else F.lit(today)
    available = landed.landed_months(spark, extracts, "zip").unionByName(
        landed.landed_months(spark, extracts, "csv"))
    last = ingest.latest_month(available, day).collect()
    if not last:
        raise RuntimeError("no extract landed in the last months")
    window = ingest.month_window(spark.createDataFrame(last, "year int, month int"), months)
    gaps = ingest.missing_extracts(spark, extracts, root, window)
    if gaps:
        raise FileNotFoundError(f"extracts not landed: {gaps}")
    flights, weather = (
        ingest.pending_files(spark, folder, root, name, window, force)
        for folder, name in ((extracts, "flights"), (payloads, "weather")))
    ingest.reject_unplaced(spark, extracts, root, force)
    rows = ingest.load_flights(spark, root, flights)
    order = hubs.select("position", "airport_code") if hubs is not None and "position" in hubs.columns else None
    ingest.load_weather(spark, root, weather, order)
    log.info("new flight rows: %d", rows)
    if transform:
        places = None if hubs is None else hubs.drop("position")
        log.info("months rebuilt: %s", build(spark, root, carriers, places, checked=True))
    return rows
