"""Landed files: monthly extracts (zip or plain delimited text) and weather payloads.

The landing folder holds files named ``..._{year}_{month}.zip|csv|json``; the month
is not zero-padded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import EXTRACT_WANTED, WEATHER_PAYLOAD
from tarmac.sources.zips import read_zips

_MONTH_IN_NAME = r"_(\d{4})_(\d{1,2})\.(?:zip|csv|json)$"
_LANDED = "path string, year int, month int"


def month_of(path: Column) -> list[Column]:
    """Year and month a file name ends with, NULL where it does not."""
    return [
        F.regexp_extract(path, _MONTH_IN_NAME, group).try_cast("int").alias(name)
        for group, name in ((1, "year"), (2, "month"))
    ]


def landed_files(spark: SparkSession, landing: str, suffix: str) -> DataFrame:
    """Path, year and month (NULL where the name has none) of every landed file with this suffix.

    A listing: the file contents are pruned away. A folder that is not there yet
    counts as empty.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", f"*.{suffix}")
            .option("recursiveFileLookup", True)
            .load(landing)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LANDED)
    return files.select("path", *month_of(F.col("path")))


def landed_months(spark: SparkSession, landing: str, suffix: str) -> DataFrame:
    """The landed files whose name says a month."""
    return landed_files(spark, landing, suffix).filter(F.col("year").isNotNull())


def read_extract_zip(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Zipped extracts as raw text rows, one task per archive, streamed in blocks of any number."""
    return read_zips(spark, paths)


def read_extract_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Unzipped extracts as raw text rows; large files are split between tasks.

    Files whose header differs from the first one's are refused, not misread.
    """
    rows = (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("nullValue", "")
        .csv(paths)
    )
    return rows.select(*EXTRACT_WANTED, F.col("_metadata.file_name").alias("_source_file"))


def read_weather_payload(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per payload file: path and the list of responses, in file order."""
    texts = spark.read.option("wholetext", True).text(paths)
    responses = F.from_json("value", WEATHER_PAYLOAD, {"mode": "FAILFAST"})
    return texts.select(F.col("_metadata.file_path").alias("path"), responses.alias("responses"))
