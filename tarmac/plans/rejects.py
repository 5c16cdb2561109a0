"""Landed rows and files that bronze does not take: kept beside it, with the reason, never dropped.

``rejects/flights/source_file=…`` holds one row per row or file set aside. Loading a file again replaces
what is kept of it. Reasons, each with the column and the text that gave it:

* ``month``: the file's name does not say its month;
* ``date``: year, month and day are no date;
* ``number``: a text that is neither missing nor a number (clock times excepted, which become NULL);
* ``range``: a clock number beyond 16 bits;
* ``payload``: a weather payload that is no list of responses; ``length``: arrays of unequal length in one;
* ``later``: a payload of a month for which the same batch holds a later one;
* ``hidden``: a plain extract of a month that was landed zipped too. The file is named, ``line`` is NULL.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import missing_to_null
from tarmac.schemas import EXTRACT_COLUMNS, EXTRACT_DATE_PARTS, EXTRACT_WANTED, WEATHER_PAYLOAD, WEATHER_VARIABLES
from tarmac.session import compiled
from tarmac.sources import landing as landed
from tarmac.sources.versions import drop_path

FAULT = "struct<reason: string, field: string, value: string>"
REJECTS = f"faults array<{FAULT}>, line string, rejected_at timestamp, source_file string"
CLOCK_BOUND = 32767


def rejects_path(lake: str, name: str) -> str:
    return f"{lake}/rejects/{name}"


def _fault(reason: str, field: str, broken: Column, value: Column) -> Column:
    found = F.struct(F.lit(reason).alias("reason"), F.lit(field).alias("field"), value.alias("value"))
    return F.when(F.coalesce(broken, F.lit(False)), found)


def _rules() -> list[tuple[str, str, Column, Column]]:
    """What may be wrong with a raw row of an extract: reason, column, whether it is, and the text that gives it."""
    year, _ = landed.month_of(F.col("_source_file"))
    parts = [F.col(c).try_cast("double").cast("int") for c in EXTRACT_DATE_PARTS]
    day = F.concat_ws("-", *[F.col(c) for c in EXTRACT_DATE_PARTS])
    # The days that every month has need no parser.
    sure = F.coalesce(parts[0].between(1, 9999) & parts[1].between(1, 12) & parts[2].between(1, 28), F.lit(False))
    no_date = ~sure & F.try_to_date(F.concat_ws("-", *parts), "y-M-d").isNull()
    rules = [("month", "_source_file", year.isNull(), F.col("_source_file")), ("date", "FlightDate", no_date, day)]
    for source, _, kind in EXTRACT_COLUMNS:
        text = missing_to_null(F.col(source))
        number = text.try_cast("double")
        if kind == "double":
            rules.append(("number", source, text.isNotNull() & number.isNull(), F.col(source)))
        elif kind == "smallint":
            rules.append(("range", source, F.abs(F.rint(number)) > CLOCK_BOUND, F.col(source)))
    return rules


def faults(raw: DataFrame) -> Column:
    """What keeps a raw row of an extract out of bronze; an empty array if nothing does."""
    return F.filter(F.array(*[_fault(*rule) for rule in _rules()]), lambda f: f.isNotNull())


def faulty(raw: DataFrame) -> Column:
    """Whether there are any: most rows have none, and this is compiled, where the array is interpreted."""
    return F.greatest(*[F.coalesce(broken, F.lit(False)) for _, _, broken, _ in _rules()])


def marked(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_faulty", faulty(raw))


def parsed(raw: DataFrame) -> DataFrame:
    """The marked rows with numbers for their texts, NULL where missing or broken: bronze need not look at them again."""
    numbers = {c: missing_to_null(F.col(c)).try_cast("double") for c, _, kind in EXTRACT_COLUMNS if kind != "string"}
    return raw.select(*[numbers.get(c, F.col(c)).alias(c) for c in raw.columns], faulty(raw).alias("_faulty"))


def accepted(rows: DataFrame) -> DataFrame:
    """The marked rows that bronze takes."""
    return rows.filter(~F.col("_faulty")).drop("_faulty")


def rejected(rows: DataFrame) -> DataFrame:
    """The other marked rows: what is wrong, the whole raw row as JSON, and its file."""
    return rows.filter("_faulty").select(
        faults(rows).alias("faults"), F.to_json(F.struct(*EXTRACT_WANTED)).alias("line"),
        F.current_timestamp().alias("rejected_at"), F.col("_source_file").alias("source_file"))


def payload_faults() -> Column:
    """What keeps a payload (``path``, ``value``, ``responses``, ``year``) out of bronze; an empty array if nothing does."""
    name, responses = F.element_at(F.split("path", "/"), -1), F.col("responses")
    sizes = lambda r: [F.size(r["hourly"][v]) for v in WEATHER_VARIABLES]
    unlike = lambda r: F.greatest(*[(F.coalesce(n, F.lit(-1)) != F.size(r["hourly"]["time"])).cast("int") for n in sizes(r)]) == 1
    texts = F.from_json("value", re.sub("array<double>", "array<string>", WEATHER_PAYLOAD))
    found = [
        _fault("month", "path", F.col("year").isNull(), name),
        _fault("payload", "responses", responses.isNull() | F.exists(responses, lambda r: r.isNull()), name),
        _fault("length", "hourly", F.exists(texts, unlike), name),
    ]

    def known(parsed: Column, variable: str) -> Column:
        sizes = F.transform(parsed, lambda r: F.size(F.filter(r["hourly"][variable], lambda x: x.isNotNull())))
        return F.aggregate(sizes, F.lit(0), lambda n, size: n + F.greatest(size, F.lit(0)))

    found += [_fault("number", v, known(texts, v) != known(responses, v), name) for v in WEATHER_VARIABLES]
    return F.filter(F.array(*found), lambda f: f.isNotNull())


def hidden(spark: SparkSession, paths: Collection[str]) -> DataFrame:
    """A row for each plain extract that a zipped one hides; one landed as several files of its name is one, with all paths."""
    by_name: dict[str, list[str]] = {}
    for p in sorted(paths):
        by_name.setdefault(p.rsplit("/", 1)[-1], []).append(p)
    files = spark.createDataFrame([(",".join(found),) for found in by_name.values()], "path string")
    return files.select(
        F.array(F.struct(F.lit("hidden").alias("reason"), F.lit("_source_file").alias("field"),
                         F.col("path").alias("value"))).alias("faults"),
        F.lit(None).cast("string").alias("line"), F.current_timestamp().alias("rejected_at"),
        F.element_at(F.split("path", "/"), -1).alias("source_file"))


def write_rejects(rows: DataFrame | None, lake: str, name: str, spark: SparkSession, files: Collection[str] | None) -> None:
    """Replace what is kept of these files (of those in ``rows`` if not given) by ``rows``; None: nothing is rejected."""
    path = rejects_path(lake, name)
    if files:
        for folder in _folders(spark, path, files):
            drop_path(spark, folder)
    if rows is not None:
        with compiled(spark):
            rows.hint("rebalance", "source_file").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("source_file").parquet(path)


def _folders(spark: SparkSession, path: str, files: Collection[str]) -> list[str]:
    """The folders that keep rejects of these files; a listing."""
    try:
        kept = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if "source_file" not in kept.columns:
        return []
    own = kept.filter(F.col("source_file").cast("string").isin(sorted(files)))
    return [r[0] for r in own.select(F.regexp_extract("path", "(.*)/[^/]*$", 1)).distinct().collect()]


def read_rejects(spark: SparkSession, lake: str, name: str = "flights") -> DataFrame:
    """All that is kept, a row per row or file set aside; empty before the first."""
    try:
        return spark.read.schema(REJECTS).parquet(rejects_path(lake, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECTS)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rows by file, reason and field; a row with several faults counts for each."""
    return rejects.select("source_file", F.inline("faults")).groupBy("source_file", "reason", "field").agg(
        F.count(F.lit(1)).alias("rows"))
