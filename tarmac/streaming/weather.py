"""Landed weather payloads to bronze as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans import rejects
from tarmac.plans.ingest import bronze_weather
from tarmac.schemas import WEATHER_PAYLOAD
from tarmac.session import scratch_path
from tarmac.sources.lake import bronze_path, write_month_partitions
from tarmac.sources.landing import month_of
from tarmac.sources.seeds import hub_order


def payloads(texts: DataFrame) -> DataFrame:
    """Whole payloads (``path``, ``value``, ``modified``) parsed, dated and marked with their faults.

    Of several payloads of a month the one landed last counts; the others are marked ``later``.
    """
    parsed = texts.select("path", "value", "modified", F.from_json("value", WEATHER_PAYLOAD).alias("responses"), *month_of(F.col("path")))
    marked = parsed.withColumn("_faults", rejects.payload_faults())
    sound = F.size("_faults") == 0
    newest = Window.partitionBy("year", "month", sound).orderBy(F.desc("modified"), F.desc("path"))
    name = F.element_at(F.split("path", "/"), -1)
    later = F.array(F.struct(F.lit("later").alias("reason"), F.lit("path").alias("field"), name.alias("value")))
    return marked.withColumn("_faults", F.when(sound & (F.row_number().over(newest) > 1), later).otherwise(F.col("_faults")))


def stream_weather(
    spark: SparkSession, landing: str, lake: str, checkpoint: str, hubs: DataFrame | None = None, files_per_batch: int = 64
) -> StreamingQuery:
    """Load every payload that has arrived since the last run, then stop.

    A month is replaced by its newest payload, so a replayed batch is idempotent and a corrected payload under a new
    name wins. A payload that does not fit is among the rejects, whole, and stops neither the batch nor the query.
    """
    order = hub_order(spark) if hubs is None else hubs

    def load(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        path = scratch_path(own, "payloads")
        payloads(batch).write.parquet(path)  # parsed once
        marked = own.read.parquet(path)
        sound = marked.filter(F.size("_faults") == 0)
        write_month_partitions(bronze_weather(sound.select("responses", "year", "month"), order), bronze_path(lake, "weather"))
        aside = marked.filter(F.size("_faults") > 0)
        if not aside.isEmpty():
            rejects.write_rejects(aside.select(
                F.col("_faults").alias("faults"), F.col("value").alias("line"), F.current_timestamp().alias("rejected_at"),
                F.element_at(F.split("path", "/"), -1).alias("source_file")), lake, "weather", own, None)

    texts = (
        spark.readStream.option("wholetext", True)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(landing)
        .select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_modification_time").alias("modified"))
    )
    return (
        texts.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
