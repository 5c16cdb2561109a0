"""Schemas of parquet files, read from their footers by tasks and grouped there."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.sources.stores import stored

#: How Spark reads a column of an Arrow type. Nanoseconds are read as the integers they are stored as.
KINDS = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int",
    "uint32": "bigint", "float": "float", "double": "double", "string": "string", "large_string": "string",
    "bool": "boolean", "date32[day]": "date", "binary": "binary",
}


def spark_kind(kind: pa.DataType) -> str | None:
    """The SQL type, or None for one that no bronze column has."""
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    if pa.types.is_timestamp(kind):
        return "bigint" if kind.unit == "ns" else "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return KINDS.get(str(kind))


def _schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, found = batch.column(0).to_pylist(), []
        for path in paths:
            system, name = stored(path)
            with system.open_input_file(name) as handle:
                fields = [(f.name, spark_kind(f.type)) for f in pq.read_schema(handle)]
            found.append(", ".join(f"`{c}` {kind}" for c, kind in fields if kind))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], names=["path", "columns"])


def files_by_schema(files: DataFrame) -> list[tuple[str, list[str]]]:
    """The distinct schemas of the files in column ``path``, as DDL, each with its paths in order.

    Footers are read and compared by tasks; the driver gets a row per schema and the names it has to scan.
    """
    for module in (sys.modules[__name__], sys.modules[stored.__module__]):
        cloudpickle.register_pickle_by_value(module)
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = files.select("path").repartition(tasks).mapInArrow(_schemas, "path string, columns string")
    groups = read.groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [(r["columns"], r["paths"]) for r in groups.orderBy("columns").collect()]
