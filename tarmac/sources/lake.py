"""Lake layout: bronze by month, silver by month, gold marts as one dataset each."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schemas import BRONZE_FLIGHTS, BRONZE_WEATHER
from tarmac.session import side_by_side
from tarmac.sources.footers import files_by_schema
from tarmac.sources.versions import drop_path, read_snapshot, read_version

MARTS = [
    "mart_kpis_monthly", "mart_carrier_monthly", "mart_airport_daily", "mart_route_monthly",
    "mart_delay_causes_monthly", "mart_weather_impact", "mart_hourly_profile",
]
#: Rows of a written file at most, several months of real flights.
FILE_ROWS = 2_000_000
BRONZE = {"flights": BRONZE_FLIGHTS, "weather": BRONZE_WEATHER}


def bronze_path(lake: str, name: str) -> str:
    return f"{lake}/bronze/{name}"


def write_month_partitions(
    df: DataFrame, path: str, emptied: Collection[tuple[int, int]] = (), by_month: bool = False,
) -> None:
    """Replace the months found in ``df``; other months stay, except those of ``emptied`` that ``df`` has no row of.

    Rows are brought together by month; a large month is split into several files, a month
    in one unsplittable extract included. ``by_month`` says that the rows come by month already, as from bronze or extracts:
    a task then writes what it holds, in files of so many rows, and no row moves. Folder names keep the zero-padded month.
    """
    spark = df.sparkSession
    before = month_stamps(spark, path) if emptied else {}
    padded = df.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    with side_by_side(spark):
        (
            (padded if by_month else padded.hint("rebalance", "year", "month")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", FILE_ROWS)
            .partitionBy("year", "month")
            .parquet(path)
        )
    if before:
        after = month_stamps(spark, path)
        for year, month in emptied:
            if (year, month) in before and before[year, month] == after.get((year, month)):
                drop_path(spark, f"{path}/year={year}/month={month:02d}")


def month_stamps(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """A stamp of every month's files: names, sizes and times. A listing, no data is read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        if "year" not in files.columns:
            return {}
        mark = F.concat_ws("|", F.element_at(F.split("path", "/"), -1), "length", F.unix_micros("modificationTime"))
        stamps = files.groupBy(F.col("year").cast("int"), F.col("month").cast("int")).agg(
            F.sha2(F.array_join(F.array_sort(F.collect_list(mark)), ","), 256))
        return {(r[0], r[1]): r[2] for r in stamps.collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def present_months(spark: SparkSession, path: str) -> DataFrame:
    """Year and month of the partitions that hold files; a listing, no data is read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        return files.select(F.col("year").cast("int"), F.col("month").cast("int")).distinct()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN.WITH_SUGGESTION"):
            raise
        return spark.createDataFrame([], "year int, month int")


def read_bronze(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """Bronze written by this package: fixed schema, months pruned by partition filters."""
    return spark.read.schema(BRONZE[name]).parquet(bronze_path(lake, name))


def adopt_bronze(spark: SparkSession, source: str, lake: str, name: str) -> None:
    """Bronze of another tool, whose column types drift between files, into this lake's bronze.

    Files of one schema are read together, with that schema, cast to the contract and united by name, so
    there are as many scans as schemas. Schemas are found by tasks (``sources.footers``).
    """
    root = bronze_path(source, name)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    scans = [spark.read.schema(columns).option("basePath", root).parquet(*paths) if columns
             else spark.read.option("basePath", root).parquet(*paths) for columns, paths in files_by_schema(files)]
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform(scan, BRONZE[name]) for scan in scans])
    write_month_partitions(rows, bronze_path(lake, name), by_month=True)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Cast the known columns to their contract types; absent ones are filled with NULL."""
    columns = []
    for field in contract:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, T.LongType) and isinstance(
            field.dataType, (T.TimestampType, T.TimestampNTZType)
        ):
            # a zone-free wall clock was stored as if it were UTC
            micros = F.floor(value / 1000).cast("long")
            value = (
                F.timestamp_micros(micros)
                if isinstance(field.dataType, T.TimestampType)
                else F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / 1000000)
            )
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def read_table(spark: SparkSession, lake: str, layer: str, name: str) -> DataFrame:
    """A table of the last complete build; tables by month have the partition column ``ym``."""
    snapshot = read_snapshot(spark, lake)
    if snapshot is None:
        raise FileNotFoundError(f"no complete build in {lake}")
    return read_version(spark, lake, snapshot, layer, name)


def read_marts(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The seven marts by name, all of one build."""
    snapshot = read_snapshot(spark, lake)
    if snapshot is None:
        raise FileNotFoundError(f"no complete build in {lake}")
    return {name: read_version(spark, lake, snapshot, "gold", name) for name in MARTS}
