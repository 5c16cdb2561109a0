"""Landed extracts to bronze as a stream of archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans import rejects
from tarmac.plans.ingest import bronze_flights, counted, set_aside
from tarmac.sources.lake import bronze_path, write_month_partitions
from tarmac.sources.zips import stream_zips


def stream_extracts(spark: SparkSession, landing: str, lake: str, checkpoint: str) -> StreamingQuery:
    """Load every zipped extract that has arrived since the last run, then stop.

    The checkpoint remembers the files, which makes the load incremental; a replayed
    batch replaces the same months and the same files' rejects, which makes it idempotent. The next
    build finds the new months by their files. Extracts without a month in their name, and rows that do not
    fit, are among the rejects. A corrected extract has to land under a new name, or go through the forced batch ingest.
    """
    def load(batch: DataFrame, _: int) -> None:
        raw, seen = rejects.marked(batch), Observation()
        write_month_partitions(bronze_flights(rejects.accepted(counted(raw, seen))), bronze_path(lake, "flights"))
        set_aside(batch.sparkSession, raw, seen, lake, None)

    return (
        stream_zips(spark, landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
