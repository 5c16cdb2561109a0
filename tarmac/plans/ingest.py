"""Landing to bronze: clean-up of extracts and payloads, month bookkeeping, idempotent loads."""

from __future__ import annotations

import logging
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import hhmm_number, missing_to_null, strip_all
from tarmac.operators import zip_arrays
from tarmac.plans import rejects
from tarmac.schemas import EXTRACT_COLUMNS, WEATHER_VARIABLES
from tarmac.session import compiled
from tarmac.sources import landing as landed
from tarmac.sources.lake import bronze_path, month_stamps, present_months, read_bronze, write_month_partitions
from tarmac.sources.seeds import hub_order

log = logging.getLogger(__name__)


def rebuilt_date(year: Column, month: Column, day: Column) -> Column:
    """yyyy-MM-dd text from numeric parts; the date text of the source changes its format."""
    return F.date_format(F.make_date(year.cast("int"), month.cast("int"), day.cast("int")), "yyyy-MM-dd")


def bronze_flights(raw: DataFrame) -> DataFrame:
    """Raw text rows of the extracts, or parsed ones, in bronze names, order and types.

    The partition is the month of the file, so a stray date cannot replace another month.
    """
    texts = {name for name, kind in raw.dtypes if kind == "string"}

    def clean(source: str, kind: str) -> Column:
        if source == "FlightDate":
            return rebuilt_date(F.col("Year"), F.col("Month"), F.col("DayofMonth"))
        text = missing_to_null(F.col(source)) if source in texts else F.col(source)
        if source == "Flight_Number_Reporting_Airline":
            return strip_all(text)
        if kind == "smallint":
            return hhmm_number(text)
        return text.cast(kind)

    return raw.select(
        *[clean(source, kind).alias(name) for source, name, kind in EXTRACT_COLUMNS],
        F.current_timestamp().alias("_ingested_at"),
        "_source_file",
        *landed.month_of(F.col("_source_file")),
    )


def bronze_weather(payloads: DataFrame, hubs: DataFrame) -> DataFrame:
    """Payloads (``responses``, ``year``, ``month``) as one row per hub and hour.

    A response is matched to a hub by its place in the list; responses without a hub
    and hubs without a response are left out.
    """
    placed = payloads.select("year", "month", F.posexplode("responses").alias("position", "response"))
    arrays = zip_arrays(
        ["time", *WEATHER_VARIABLES],
        [F.col(f"response.hourly.{name}") for name in ["time", *WEATHER_VARIABLES]],
    )
    hours = placed.join(hubs, "position").select(
        "airport_code", F.col("response.timezone").alias("timezone"), "year", "month", F.inline(arrays)
    )
    return hours.select(
        "airport_code",
        F.col("time").cast("timestamp_ntz").alias("weather_time"),
        *[F.col(name).cast("double") for name in WEATHER_VARIABLES],
        "timezone",
        F.current_timestamp().alias("_ingested_at"),
        "year",
        "month",
    )


# --- months ---------------------------------------------------------------------------------


def month_window(last: DataFrame, n: int) -> DataFrame:
    """The ``n`` months ending at the month in ``last`` (one row: year, month)."""
    end = F.make_date("year", "month", F.lit(1))
    first = F.add_months(end, -(n - 1))
    months = last.select(F.explode(F.sequence(first, end, F.expr("interval 1 month"))).alias("_month"))
    return months.select(F.year("_month").alias("year"), F.month("_month").alias("month"))


def month_bounds(months: DataFrame) -> DataFrame:
    """First and last calendar day of each month."""
    first = F.make_date("year", "month", F.lit(1))
    return months.select("year", "month", first.alias("first_day"), F.last_day(first).alias("last_day"))


def latest_month(available: DataFrame, today: Column, lookback: int = 8) -> DataFrame:
    """The newest available month among the ``lookback`` months before ``today``'s month."""
    age = F.months_between(F.trunc(today, "month"), F.make_date("year", "month", F.lit(1)))
    newest = available.filter(age.between(1, lookback)).agg(
        F.max(F.struct("year", "month")).alias("newest")
    )
    return newest.filter(F.col("newest").isNotNull()).select("newest.year", "newest.month")


def pending_months(available: DataFrame, present: DataFrame, force: bool = False) -> DataFrame:
    """Available months not yet present; with ``force`` all of them."""
    return available if force else available.join(present, ["year", "month"], "left_anti")


# --- loads ----------------------------------------------------------------------------------


def _load(bronze: DataFrame, lake: str, name: str, files: list[Row], by_month: bool = False) -> int:
    """Replace the months of these files, also those without any row left; returns the rows now in them.

    Rows are counted in the written footers: a count taken on the way would include
    the rows of tasks that a lost executor made run twice.
    """
    months = sorted({(f.year, f.month) for f in files})
    write_month_partitions(bronze, bronze_path(lake, name), emptied=months, by_month=by_month)
    if not month_stamps(bronze.sparkSession, bronze_path(lake, name)):
        return 0
    written = read_bronze(bronze.sparkSession, lake, name)
    return written.filter((F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months])).count()


def pending_files(
    spark: SparkSession, landing: str, lake: str, name: str, window: DataFrame, force: bool = False
) -> list[Row]:
    """Landed files (path, year, month) of the window that bronze does not hold yet.

    Of a month landed both zipped and plain the zipped files count. A driver-side list,
    bounded by the months of the window.
    """
    suffixes = ["zip", "csv"] if name == "flights" else ["json"]
    files = reduce(DataFrame.unionByName, [
        landed.landed_months(spark, landing, s).withColumn("_rank", F.lit(i)) for i, s in enumerate(suffixes)])
    first = files.groupBy("year", "month").agg(F.min("_rank").alias("_rank"))
    wanted = files.join(first, ["year", "month", "_rank"], "left_semi").drop("_rank").join(
        window, ["year", "month"], "left_semi")
    pending = pending_months(wanted, present_months(spark, bronze_path(lake, name)), force)
    return pending.orderBy("year", "month", "path").collect()


def missing_extracts(spark: SparkSession, landing: str, lake: str, window: DataFrame) -> list[tuple[int, int]]:
    """Months of the window that are neither landed nor in bronze."""
    known = present_months(spark, bronze_path(lake, "flights"))
    for suffix in ("zip", "csv"):
        known = known.unionByName(landed.landed_months(spark, landing, suffix).select("year", "month"))
    gaps = window.join(known, ["year", "month"], "left_anti").orderBy("year", "month").collect()
    return [(r.year, r.month) for r in gaps]


def unplaced_files(
    spark: SparkSession, landing: str, lake: str, force: bool = False
) -> tuple[list[str], list[str]]:
    """Extracts without a month in their name, and plain ones of a month that is landed zipped too; paths.

    Those that are among the rejects already are left out. Driver-side lists of what should not be there.
    """
    zips, texts = (landed.landed_files(spark, landing, s) for s in ("zip", "csv"))
    zipped = zips.select("year", "month").distinct()
    found = zips.unionByName(texts).filter(F.col("year").isNull()).select("path", F.lit("month").alias("why")).unionByName(
        texts.join(zipped, ["year", "month"], "left_semi").select("path", F.lit("hidden").alias("why")))
    if not force:
        known = rejects.read_rejects(spark, lake).select("source_file").distinct()
        found = found.join(known, F.element_at(F.split("path", "/"), -1) == known["source_file"], "left_anti")
    rows = found.orderBy("path").collect()
    return [r.path for r in rows if r.why == "month"], [r.path for r in rows if r.why == "hidden"]


def reject_unplaced(spark: SparkSession, landing: str, lake: str, force: bool = False) -> None:
    """Set aside the rows of extracts without a month, and name the plain extracts that zipped ones hide."""
    nameless, hidden = unplaced_files(spark, landing, lake, force)
    if nameless:
        rejects.write_rejects(rejects.rejected(rejects.marked(_read_extracts(spark, nameless))), lake, "flights", spark, None)
    if hidden:
        rejects.write_rejects(rejects.hidden(spark, hidden), lake, "flights", spark, None)
    if nameless or hidden:
        log.warning("set aside: %d extracts without a month, %d plain ones landed zipped too", len(nameless), len(hidden))


def ingest_flights(
    spark: SparkSession, landing: str, lake: str, window: DataFrame, force: bool = False
) -> int:
    """Load the pending months of the window; returns rows written. What cannot be loaded is among the rejects."""
    reject_unplaced(spark, landing, lake, force)
    return load_flights(spark, lake, pending_files(spark, landing, lake, "flights", window, force))


def _read_extracts(spark: SparkSession, paths: list[str]) -> DataFrame:
    zips = [p for p in paths if p.lower().endswith(".zip")]
    texts = [p for p in paths if not p.lower().endswith(".zip")]
    return reduce(DataFrame.unionByName, [read(spark, found) for read, found in (
        (landed.read_extract_zip, zips), (landed.read_extract_csv, texts)) if found])


def load_flights(spark: SparkSession, lake: str, files: list[Row]) -> int:
    """Load the listed extracts; returns rows written. A task reads few of them, each of one month, and writes what it reads."""
    if not files:
        return 0
    raw, seen = _read_extracts(spark, [f.path for f in files]), Observation()
    with compiled(spark):
        rows = _load(bronze_flights(rejects.accepted(counted(rejects.parsed(raw), seen))), lake, "flights", files, by_month=True)
    set_aside(spark, rejects.marked(raw), seen, lake, [f.path.rsplit("/", 1)[-1] for f in files])
    return rows


def counted(raw: DataFrame, seen: Observation) -> DataFrame:
    """The marked rows; the write that follows also sees whether any is rejected."""
    return raw.observe(seen, F.count_if("_faulty").alias("rejected"))


def set_aside(spark: SparkSession, raw: DataFrame, seen: Observation, lake: str, files: list[str] | None) -> None:
    """Write the rejected rows, by a second pass over the extracts only if the first has met some.

    The count serves as a mere sign: a task that ran twice may be in it twice, and where no row was accepted
    the adaptive plan may have been cut before it counts.
    """
    try:
        some = seen.get["rejected"] > 0
    except Py4JJavaError:
        some = True
    rejects.write_rejects(rejects.rejected(raw) if some else None, lake, "flights", spark, files)
    if some:
        log.warning("rows were set aside: %s", rejects.rejects_path(lake, "flights"))


def ingest_weather(
    spark: SparkSession, landing: str, lake: str, window: DataFrame,
    hubs: DataFrame | None = None, force: bool = False,
) -> int:
    """Load the pending weather months of the window; returns rows written."""
    return load_weather(spark, lake, pending_files(spark, landing, lake, "weather", window, force), hubs)


def load_weather(spark: SparkSession, lake: str, files: list[Row], hubs: DataFrame | None = None) -> int:
    """Load the listed payloads in one job; if that fails, month by month, so a bad one stops no other.

    Weather only enriches: a failed month is logged and, not being present, picked up
    by the next run.
    """
    hubs = hub_order(spark) if hubs is None else hubs

    def load(some: list[Row]) -> int:
        payload = landed.read_weather_payload(spark, [f.path for f in some])
        dated = payload.select("responses", *landed.month_of(F.col("path")))
        return _load(bronze_weather(dated, hubs), lake, "weather", some)

    if len(files) > 1:
        try:
            return load(files)
        except Exception as error:  # noqa: BLE001
            log.warning("weather is loaded month by month: %s", error)
    rows = 0
    for month in sorted({(f.year, f.month) for f in files}):
        try:
            rows += load([f for f in files if (f.year, f.month) == month])
        except Exception as error:  # noqa: BLE001
            log.warning("weather of %d-%02d skipped, the next run retries it: %s", *month, error)
    return rows
