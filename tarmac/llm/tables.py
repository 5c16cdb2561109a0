"""Reading the given tables, and cutting lineage with tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarmac.session import scratch_path

CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table written to the shared folder: computed once, safe from lost executors.

    A written table also has a known size, so Spark broadcasts it only below its own threshold.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widened(df: DataFrame, **added: str) -> T.StructType:
    """The schema of ``df`` with further columns, given as name and SQL type."""
    more = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in added.items()]
    return T.StructType([*df.schema.fields, *more])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8; null is empty.

    A slice holds ``CHUNK_BYTES`` of text, or one longer text, so a task's memory does
    not grow with the rows of a batch.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        first, held, held_bytes = 0, [], 0
        for i in range(batch.num_rows):
            text = texts[i].as_py() or b""
            if held and held_bytes + len(text) > CHUNK_BYTES:
                yield batch.slice(first, len(held)), held
                first, held, held_bytes = i, [], 0
            held.append(text)
            held_bytes += len(text)
        if held:
            yield batch.slice(first, len(held)), held
