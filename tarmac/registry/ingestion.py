"""Sources, sinks (s) and ingestion steps (i), fed from the driver's tables."""

from __future__ import annotations

import sys
import zipfile
from collections.abc import Iterator
from contextlib import ExitStack
from datetime import date

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac import functions as fn
from tarmac.plans import ingest, refresh, rejects
from tarmac.registry.binding import Tables, airport_code
from tarmac.registry.book import query
from tarmac.schemas import EXTRACT_COLUMNS, WEATHER_VARIABLES
from tarmac.session import scratch_path, side_by_side
from tarmac.sources import landing as landed
from tarmac.sources import seeds
from tarmac.sources.lake import MARTS, adopt_bronze, bronze_path, read_bronze, read_marts, write_month_partitions
from tarmac.sources.stores import stored
from tarmac.streaming.weather import stream_weather

_TEXTS = [name for _, name, kind in EXTRACT_COLUMNS if kind == "string"]
_BRONZE = ", ".join(
    f"nullif({name}, '') as {name}" if name in _TEXTS else name for _, name, _ in EXTRACT_COLUMNS
)


def _extract(t: Tables) -> DataFrame:
    """Bound flights as the raw text of an extract: drifting dates, padding, tokens for missing."""
    day = F.col("flight_date").cast("date")

    def text(name: str, kind: str) -> Column:
        value = F.col(name).cast("string")
        if kind == "smallint":
            value = F.lpad(value, 4, "0")
        if name == "flight_number":
            value = F.concat(F.lit(" \t"), value, F.lit("  "))
        missing = {"string": "", "smallint": "n/a", "double": "NA"}[kind]
        return F.coalesce(value, F.lit(missing))

    year, month = F.year(day).cast("string"), F.month(day).cast("string")
    in_four = F.lpad(year, 4, "0")  # put together, as formatting a date costs more than all its numbers
    return t.bronze_flights().select(
        year.alias("Year"),
        month.alias("Month"),
        F.dayofmonth(day).cast("string").alias("DayofMonth"),
        F.concat(month, F.lit("/"), F.dayofmonth(day).cast("string"), F.lit("/"), in_four, F.lit(" 12:00:00 AM")).alias("FlightDate"),
        *[text(name, kind).alias(source) for source, name, kind in EXTRACT_COLUMNS if name != "flight_date"],
        F.concat(F.lit("on_time_"), in_four, F.lit("_"), month, F.lit(".zip")).alias("_source_file"),
    )


@query(f"""select {_BRONZE}, 'on_time_' || strftime(flight_date::date, '%Y_%-m') || '.zip' as _source_file,
    year(flight_date::date)::int as year, month(flight_date::date)::int as month from b_flights""")
def i01_bronze_flights(t: Tables) -> DataFrame:
    """Raw extract text to bronze; the clock column is left out."""
    return ingest.bronze_flights(_extract(t)).drop("_ingested_at")


_ROWS = """select flight_date, carrier_code, flight_number, tail_number, origin, dest, crs_dep_time, dep_time, distance, cancelled,
    late_aircraft_delay from b_flights"""


@query(_ROWS.replace("tail_number,", "nullif(tail_number, '') as tail_number,"))
def s02_extract_csv(t: Tables) -> DataFrame:
    """The extract written as delimited text, read back by the extract reader, to bronze."""
    def write() -> str:
        path = scratch_path(t.spark, "extract")
        day = F.to_date(F.concat_ws("-", "Year", "Month", "DayofMonth"), "y-M-d")
        named = _extract(t).withColumn("_file", F.date_format(day, "'on_time_'yyyy_M")).drop("_source_file")
        with side_by_side(t.spark):
            named.write.partitionBy("_file").option("header", True).option("escape", '"').csv(path)
        return path

    path = t.once("extract-csv", write)
    rows = ingest.bronze_flights(landed.read_extract_csv(t.spark, f"{path}/*"))
    return rows.select("flight_date", "carrier_code", "flight_number", "tail_number", "origin", "dest", "crs_dep_time",
                       "dep_time", "distance", "cancelled", "late_aircraft_delay")


#: Rows of a landed file at most, about what a month of real flights has; more make further files of the name.
_LANDED_ROWS = 500_000


def _land(extract: DataFrame, folder: str, most: int = _LANDED_ROWS) -> None:
    """The rows of every ``_file`` as zipped or plain extracts of that name, streamed by the tasks that have them.

    Each lies in a folder of its own, named by the task and counted, so a large month is many files that no task has
    to write or read alone.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    names = [c for c in extract.columns if c != "_file"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, counted = TaskContext.get().partitionId(), 0
        with ExitStack() as all_files:
            files: dict[str, tuple[ExitStack, csv.CSVWriter, int]] = {}
            for batch in batches:
                for part in pc.unique(batch.column("_file")).to_pylist():
                    rows = batch.filter(pc.equal(batch.column("_file"), part)).select(names)
                    if part not in files:
                        own = all_files.enter_context(ExitStack())
                        system, path = stored(f"{folder}/part-{task}-{counted}/{part}")
                        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        target = own.enter_context(system.open_output_stream(path))
                        if part.endswith(".zip"):
                            archive = own.enter_context(zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=1))
                            target = own.enter_context(archive.open(part.replace(".zip", ".csv"), "w", force_zip64=True))
                        files[part] = own, own.enter_context(csv.CSVWriter(target, rows.schema)), 0
                        counted += 1
                    own, writer, written = files[part]
                    writer.write_batch(rows)
                    files[part] = own, writer, written + rows.num_rows
                    if written + rows.num_rows >= most:
                        own.close()
                        del files[part]
        yield pa.RecordBatch.from_pydict({"written": pa.array([], pa.string())})

    system, path = stored(folder)
    system.create_dir(path, recursive=True)
    extract.mapInArrow(write, "written string").count()


@query(_ROWS.replace("tail_number,", "nullif(tail_number, '') as tail_number,"))
def s01_extract_zip(t: Tables) -> DataFrame:
    """The extract landed as archives by month, read back through the data source, to bronze."""
    def write() -> str:
        path = scratch_path(t.spark, "archives")
        _land(_extract(t).withColumnRenamed("_source_file", "_file"), path)
        return path

    rows = ingest.bronze_flights(landed.read_extract_zip(t.spark, t.once("extract-zip", write)))
    return rows.select("flight_date", "carrier_code", "flight_number", "tail_number", "origin", "dest", "crs_dep_time",
                       "dep_time", "distance", "cancelled", "late_aircraft_delay")


_PLANTED = [("number", "TaxiOut", 97, 5), ("date", "FlightDate", 89, 7), ("range", "DepTime", 83, 11)]
_LANDED_TWICE = "select 'extra.zip', k from f where k % 101 = 3"


@query(f"""with f as (select flight_number::bigint as k, 'on_time_' || strftime(flight_date::date, '%Y_%-m') as file from b_flights),
    landed as (select file || '.zip' as file, k from f union all {_LANDED_TWICE}),
    faults as (select file, 'month' as reason, '_source_file' as field from landed where file = 'extra.zip' union all
        select min(file) || '.csv', 'hidden', '_source_file' from f union all """ + " union all ".join(
    f"select file, '{reason}', '{field}' from landed where k % {n} = {rest}" for reason, field, n, rest in _PLANTED)
    + ") select file as source_file, reason, field, count(*) as rows from faults group by all")
def i14_rejects(t: Tables) -> DataFrame:
    """Faults planted in the landed extracts, an extract without a month and a hidden one, as the ingest sets them aside."""
    def write() -> str:
        root, k = scratch_path(t.spark, "faulty"), F.trim(F.translate("Flight_Number_Reporting_Airline", "\t", "")).cast("long")
        at = {field: k % n == rest for _, field, n, rest in _PLANTED}
        rows = _extract(t).withColumns({
            "k": k, "TaxiOut": F.when(at["TaxiOut"], "ten").otherwise(F.col("TaxiOut")),
            "DepTime": F.when(at["DepTime"], "99999").otherwise(F.col("DepTime")),
            "Month": F.when(at["FlightDate"], "13").otherwise(F.col("Month"))}).withColumnRenamed("_source_file", "_file")
        extra = rows.filter("k % 101 = 3").withColumn("_file", F.lit("extra.zip"))
        first = rows.select("_file").distinct().agg(F.min("_file")).first()[0]
        hidden = rows.filter((F.col("_file") == first) & (F.col("k") % 7 == 0)).withColumn(
            "_file", F.lit(first.replace(".zip", ".csv")))
        _land(rows.union(extra).union(hidden).drop("k"), f"{root}/landing")
        months = landed.landed_months(t.spark, f"{root}/landing", "zip").select("year", "month")
        ingest.ingest_flights(t.spark, f"{root}/landing", root, months)
        return root

    return rejects.reject_counts(rejects.read_rejects(t.spark, t.once("faulty-lake", write)))


@query(f"select {_BRONZE} from b_flights")
def s06_drifting_bronze(t: Tables) -> DataFrame:
    """Bronze whose column types and columns differ between files, adopted into one contract."""
    def write() -> str:
        source, lake = scratch_path(t.spark, "foreign"), scratch_path(t.spark, "adopted")
        day, whole = F.col("flight_date").cast("date"), F.pmod(F.xxhash64("flight_number"), F.lit(3))
        rows = t.bronze_flights().withColumns({"year": F.year(day), "month": F.lpad(F.month(day).cast("string"), 2, "0")})
        drifts = [
            {c: F.col(c).cast("bigint") for c in ("dep_delay", "distance", "cancelled")},
            {c: F.col(c).cast("decimal(12,2)") for c in ("air_time", "taxi_in")} | {"_other": F.lit("x")},
            {c: F.col(c).cast("int") for c in ("crs_dep_time", "dep_time")} | {"dep_delay": F.col("dep_delay").cast("float")},
        ]
        for i, drift in enumerate(drifts):
            with side_by_side(t.spark):
                rows.filter(whole == i).withColumns(drift).write.mode("append").partitionBy("year", "month").parquet(
                    bronze_path(source, "flights"))
        adopt_bronze(t.spark, source, lake, "flights")
        return lake

    texts = {c: F.nullif(F.col(c), F.lit("")) for c in _TEXTS}
    return read_bronze(t.spark, t.once("adopted-lake", write), "flights").withColumns(texts).select(
        *[name for _, name, _ in EXTRACT_COLUMNS])


@query("select 'carriers' as seed, carrier_code as code, carrier_name as label, carrier_type as kind from seed_carriers "
       "union all select 'hubs', airport_code, airport_name, state from seed_hubs")
def s07_seeds(t: Tables) -> DataFrame:
    """Seeds written as header files and read back typed."""
    def write() -> str:
        path = scratch_path(t.spark, "seeds")
        t.carriers().write.option("header", True).csv(f"{path}/carriers")
        t.hubs().write.option("header", True).csv(f"{path}/hubs")
        return path

    path = t.once("seed-files", write)
    carriers, hubs = seeds.carriers(t.spark, f"{path}/carriers"), seeds.hub_airports(t.spark, f"{path}/hubs")
    return carriers.select(F.lit("carriers").alias("seed"), F.col("carrier_code").alias("code"),
                           F.col("carrier_name").alias("label"), F.col("carrier_type").alias("kind")).unionByName(
        hubs.select(F.lit("hubs").alias("seed"), F.col("airport_code").alias("code"),
                    F.col("airport_name").alias("label"), F.col("state").alias("kind")))


@query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders""")
def i02_date_rebuild(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    parts = [F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")]
    return t["orders"].select("o_orderkey", ingest.rebuilt_date(*parts).alias("day"))


_CLOCK_TEXT = """case event_id % 5 when 0 then lpad((event_id % 2401)::varchar, 4, '0') when 1 then (event_id % 240) || '.5'
    when 2 then event_type when 3 then (event_id % 2401) || '.0' end"""


@query(f"select event_id, raw, cast(try_cast(raw as double) as smallint) as hhmm from (select event_id, {_CLOCK_TEXT} as raw from events)")
def i03_hhmm_coerce(t: Tables) -> DataFrame:
    raw = t["events"].select("event_id", F.expr(_CLOCK_TEXT.replace("::varchar", "")).alias("raw"))
    return raw.withColumn("hhmm", fn.hhmm_number(F.col("raw")))


_TOKEN = "case event_id % 7 when 0 then 'NA' when 1 then 'null' when 2 then '' when 3 then 'None' when 4 then '#N/A' else event_type end"


@query("select event_id, if(event_id % 7 < 5, null, event_type) as label from events")
def i04_missing_tokens(t: Tables) -> DataFrame:
    return t["events"].select("event_id", fn.missing_to_null(F.expr(_TOKEN)).alias("label"))


@query("select c_custkey, c_mktsegment as segment from customer")
def i05_strip(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\t "), "c_mktsegment", F.lit(" \r\n"))
    return t["customer"].select("c_custkey", fn.strip_all(padded).alias("segment"))


def _months(df: DataFrame, column: str) -> DataFrame:
    """Distinct (year, month); combined before the shuffle."""
    return df.select(F.year(column).alias("year"), F.month(column).alias("month")).distinct()


@query("""select year(l_shipdate)::int as year, month(l_shipdate)::int as month from lineitem
    except select year(o_orderdate)::int, month(o_orderdate)::int from orders""")
def i07_pending_months(t: Tables) -> DataFrame:
    return ingest.pending_months(_months(t["lineitem"], "l_shipdate"), _months(t["orders"], "o_orderdate"))


@query("""select year(m)::int as year, month(m)::int as month from
    (select max(date_trunc('month', o_orderdate)) as m from orders
     where date_trunc('month', o_orderdate) between date '1997-07-01' and date '1998-02-01') where m is not null""")
def i08_latest_month(t: Tables) -> DataFrame:
    return ingest.latest_month(_months(t["orders"], "o_orderdate"), F.lit(date(1998, 3, 15)))


@query("""select year(m)::int as year, month(m)::int as month from (select unnest(range(
    max(date_trunc('month', o_orderdate)) - interval 13 month, max(date_trunc('month', o_orderdate)) + interval 1 month, interval 1 month)) as m from orders)""")
def i09_month_window(t: Tables) -> DataFrame:
    last = t["orders"].agg(F.max("o_orderdate").alias("d")).select(
        F.year("d").alias("year"), F.month("d").alias("month"))
    return ingest.month_window(last, 14)


@query("""select distinct year(o_orderdate)::int as year, month(o_orderdate)::int as month, date_trunc('month', o_orderdate)::date as first_day,
    last_day(o_orderdate::date) as last_day from orders""")
def i10_month_bounds(t: Tables) -> DataFrame:
    return ingest.month_bounds(_months(t["orders"], "o_orderdate"))


def _payloads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """De-duplicated hours as one nested payload per month, and the hub positions.

    A payload holds at most hubs x hours of a month; hubs without hours get empty arrays.
    """
    weather = t.stg_weather()
    hubs = t["nation"].filter(F.col("n_nationkey") < 15).select(
        F.col("n_nationkey").alias("position"), airport_code(F.col("n_nationkey")).alias("airport_code"))
    columns = dict(zip(WEATHER_VARIABLES, weather.columns[2:]))
    hour = F.col("weather_hour")
    hourly = weather.join(hubs, "airport_code").groupBy(
        F.year(hour).alias("year"), F.month(hour).alias("month"), "position"
    ).agg(F.sort_array(F.collect_list(F.struct(
        F.date_format(hour, "yyyy-MM-dd'T'HH:mm").alias("time"),
        *[F.col(c).cast("double").alias(name) for name, c in columns.items()]))).alias("h"))
    names = ["time", *WEATHER_VARIABLES]
    response = F.struct(
        F.lit("UTC").alias("timezone"), F.struct(*[F.col(f"h.{n}").alias(n) for n in names]).alias("hourly"))
    empty = F.struct(F.lit("UTC").alias("timezone"), F.struct(
        F.array().cast("array<string>").alias("time"),
        *[F.array().cast("array<double>").alias(n) for n in WEATHER_VARIABLES]).alias("hourly"))
    placed = hourly.groupBy("year", "month").agg(
        F.map_from_entries(F.collect_list(F.struct("position", response))).alias("m"))
    responses = F.transform(
        F.sequence(F.lit(0), F.lit(14)), lambda p: F.coalesce(F.try_element_at("m", p), empty))
    return placed.select("year", "month", responses.alias("responses")), hubs


@query("""select airport_code, weather_hour as weather_time, temperature_c as temperature_2m, precipitation_mm as precipitation,
    snowfall_cm as snowfall, wind_speed_kmh as wind_speed_10m, wind_gusts_kmh as wind_gusts_10m, cloud_cover_pct as cloud_cover,
    wmo_weather_code::double as weather_code, 'UTC' as timezone, year(weather_hour)::int as year, month(weather_hour)::int as month from weather""")
def s03_payload_flatten(t: Tables) -> DataFrame:
    """Nested payloads back to one row per hub and hour, matched by place in the list."""
    payloads, hubs = _payloads(t)
    return ingest.bronze_weather(payloads, hubs).drop("_ingested_at")


def _land_texts(files: DataFrame, folder: str) -> None:
    """Every row (``name``, ``value``) as a file of that name, written by tasks."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, value in zip(*(column.to_pylist() for column in batch.columns)):
                system, path = stored(f"{folder}/{name}")
                with system.open_output_stream(path) as out:
                    out.write(value.encode())
        yield pa.RecordBatch.from_pydict({"written": pa.array([], pa.string())})

    system, path = stored(folder)
    system.create_dir(path, recursive=True)
    files.select("name", "value").mapInArrow(write, "written string").count()


@query("""select airport_code, weather_hour as weather_time, temperature_c as temperature_2m, precipitation_mm as precipitation,
    snowfall_cm as snowfall, wind_speed_kmh as wind_speed_10m, wind_gusts_kmh as wind_gusts_10m, cloud_cover_pct as cloud_cover,
    wmo_weather_code::double as weather_code, 'UTC' as timezone, year(weather_hour)::int as year, month(weather_hour)::int as month from weather
    union all select 'rejected', null, null, null, null, null, null, null, null, reason, null, null from (values ('month'), ('payload')) r(reason)""")
def i15_streamed_weather(t: Tables) -> DataFrame:
    """Payloads landed as files and streamed to bronze, beside one that is no payload and one without a month, which are set aside."""
    def write() -> str:
        root = scratch_path(t.spark, "streamed")
        payloads, hubs = _payloads(t)
        named = payloads.select(F.format_string("weather_%d_%d.json", "year", "month").alias("name"), F.to_json("responses").alias("value"))
        bad = t.spark.range(1).select(F.inline(F.array(
            F.struct(F.lit("weather_1999_1.json").alias("name"), F.lit("no payload").alias("value")),
            F.struct(F.lit("weather.json").alias("name"), F.lit("[]").alias("value")))))
        _land_texts(named.union(bad), f"{root}/landing")
        stream_weather(t.spark, f"{root}/landing", root, f"{root}/state", hubs).awaitTermination()
        return root

    root = t.once("streamed-weather", write)
    rows = read_bronze(t.spark, root, "weather").drop("_ingested_at")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    named = {"airport_code": F.lit("rejected").alias("airport_code"), "timezone": F.col("reason").alias("timezone")}
    aside = rejects.reject_counts(rejects.read_rejects(t.spark, root, "weather"))
    return rows.union(aside.select(*[named.get(f.name, column) for f, column in zip(rows.schema, nothing)]))


def _lake_flights(t: Tables) -> DataFrame:
    day = F.col("flight_date").cast("date")
    return t.bronze_flights().withColumns({
        "_ingested_at": F.col("_ingested_at").cast("timestamp"),
        "_source_file": F.lit("driver tables"),
        "year": F.year(day),
        "month": F.month(day),
    })


def _lake_weather(t: Tables) -> DataFrame:
    """Bound observations. The ingestion time orders the repeats of an hour; of equal times the latest event counts,
    and the event id, far below a microsecond's share of a second, decides."""
    time = F.col("weather_time")
    whole = F.date_trunc("second", F.col("_ingested_at").cast("timestamp"))
    order = F.row_number().over(Window.partitionBy("airport_code", "weather_time").orderBy("_ingested_at", "_tie"))
    ingested = F.timestamp_micros(F.unix_micros(whole) + order)
    return t.bronze_weather().withColumns({
        "_ingested_at": ingested,
        "weather_code": F.col("weather_code").cast("double"),
        "year": F.year(time),
        "month": F.month(time),
    }).drop("_tie")


@query("""select year(flight_date::date)::int as year, month(flight_date::date)::int as month, count(*) as rows,
    count(distinct flight_number) as numbers, sum(distance) as miles from b_flights group by all""")
def s04_bronze_partitions(t: Tables) -> DataFrame:
    """Bronze written by month to the shared folder and scanned back."""
    def write() -> str:
        lake = scratch_path(t.spark, "bronze")
        write_month_partitions(_lake_flights(t), bronze_path(lake, "flights"), by_month=True)
        return lake

    return read_bronze(t.spark, t.once("bronze-lake", write), "flights").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("flight_number").alias("numbers"),
        F.sum("distance").alias("miles"),
    )


def _first_month(t: Tables) -> tuple[int, int]:
    first = t.bronze_flights().agg(F.min("flight_date")).first()[0]
    return int(first[:4]), int(first[5:7])


def _of_first_month(t: Tables) -> Column:
    year, month = _first_month(t)
    return (F.col("year") == year) & (F.col("month") == month)


def _built_lake(t: Tables) -> str:
    """A lake built in two refreshes: the first month alone, then all others added to it."""
    return t.once("lake", lambda: _build_lake(t))


def _build_lake(t: Tables) -> str:
    lake, flights = scratch_path(t.spark, "lake"), _lake_flights(t)
    first = _of_first_month(t)
    write_month_partitions(flights.filter(first), bronze_path(lake, "flights"), by_month=True)
    write_month_partitions(_lake_weather(t), bronze_path(lake, "weather"))
    refresh.build(t.spark, lake, t.carriers(), t.hubs())
    write_month_partitions(flights.filter(~first), bronze_path(lake, "flights"), by_month=True)
    refresh.build(t.spark, lake, t.carriers(), t.hubs())
    return lake


def _corrected_lake(t: Tables) -> str:
    """A lake whose first month is replaced after the build, without the flights of eight airports."""
    def build() -> str:
        lake, flights = scratch_path(t.spark, "corrected"), _lake_flights(t)
        write_month_partitions(flights, bronze_path(lake, "flights"), by_month=True)
        write_month_partitions(_lake_weather(t), bronze_path(lake, "weather"))
        refresh.build(t.spark, lake, t.carriers(), t.hubs())
        corrected = flights.filter(_of_first_month(t) & (F.col("origin") >= "A08"))
        write_month_partitions(corrected, bronze_path(lake, "flights"), by_month=True)
        refresh.build(t.spark, lake, t.carriers(), t.hubs())
        return lake

    return t.once("corrected-lake", build)


_MART_SQL = dict(zip(MARTS, ["kpis", "carrier_month", "airport_day", "route_month", "cause_month", "impact", "hour_profile"]))


@query(" union all ".join(f"select '{m}' as mart, count(*) as rows from {table}" for m, table in _MART_SQL.items()))
def s10_gold_marts(t: Tables) -> DataFrame:
    """All marts of a built lake, read by name."""
    marts = read_marts(t.spark, _built_lake(t))
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(m).alias("mart"), "rows") for m, df in marts.items()]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def _register_refreshed(mart: str, table: str) -> None:
    """A mart of the lake after an incremental refresh equals the full computation, value by value."""
    def build(t: Tables) -> DataFrame:
        return read_marts(t.spark, _built_lake(t))[mart]

    build.__name__ = f"s10_{mart}"
    query(f"select * from {table}")(build)


for _mart, _table in _MART_SQL.items():
    _register_refreshed(_mart, _table)


@query("select * from impact")
def i12_incremental_refresh(t: Tables) -> DataFrame:
    """A whole-period mart after an incremental refresh equals the full computation."""
    return read_marts(t.spark, _built_lake(t))["mart_weather_impact"]


_CORRECTED = """not (origin < 'A08' and left(flight_date, 7) = (select left(cast(min(
    date '2024-01-01' + cast(date_diff('day', date '1995-01-01', cast(l_shipdate as date)) % 60 as int)) as varchar), 7) from lineitem))"""


@query("select * from impact", b_flights=_CORRECTED)
def i13_corrected_month(t: Tables) -> DataFrame:
    """The first month loses the flights of eight airports; nothing of them is left in the mart."""
    return read_marts(t.spark, _corrected_lake(t))["mart_weather_impact"]


@query("select * from hour_profile", b_flights=_CORRECTED)
def i13_corrected_hours(t: Tables) -> DataFrame:
    return read_marts(t.spark, _corrected_lake(t))["mart_hourly_profile"]
