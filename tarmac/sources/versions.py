"""Which files readers see. A build writes new folders; one appended file makes them current.

A table lies in folders by the build that wrote them, its months below:
``gold/fct_flights/build=7/ym=202502``. The list of current folders is appended to
``state/builds`` as the last step of a build. Until then, and if that never comes,
readers see the build before.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "ym"  # yyyymm as an int
_ROWS = "build long, layer string, name string, ym int, version long, stamp string, months array<int>"
Key = tuple[str, str, int]


@dataclass(frozen=True)
class Entry:
    """The build that wrote a folder. ``stamp``: of the table its schema (month 0), of bronze its files.

    ``months`` of a bronze month are the months its rows are dated in.
    """

    version: int
    stamp: str = ""
    months: tuple[int, ...] = ()

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.stamp))


@dataclass
class Snapshot:
    """One consistent state of a lake: an entry per table (month 0) and per month of a table."""

    build: int
    entries: dict[Key, Entry] = field(default_factory=dict)

    def months(self, layer: str, name: str) -> dict[int, Entry]:
        return {ym: e for (l, n, ym), e in self.entries.items() if (l, n) == (layer, name) and ym}

    def next(self) -> Snapshot:
        return Snapshot(self.build + 1, dict(self.entries))


def table_path(lake: str, layer: str, name: str) -> str:
    return f"{lake}/{layer}/{name}"


def read_snapshot(spark: SparkSession, lake: str, before: int | None = None) -> Snapshot | None:
    """The last complete state (of those before a build); None before the first one."""
    try:
        states = spark.read.schema(_ROWS).parquet(f"{lake}/state/builds")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        states = states.filter(F.col("build") < before)
    newest = states.agg(F.max("build")).first()[0]
    if newest is None:
        return None
    rows = states.filter(F.col("build") == newest).collect()  # tables x months
    return Snapshot(newest, {(r.layer, r.name, r.ym): Entry(r.version, r.stamp, tuple(r.months)) for r in rows})


def append_snapshot(spark: SparkSession, lake: str, snapshot: Snapshot) -> None:
    rows = [(snapshot.build, *key, e.version, e.stamp, list(e.months)) for key, e in sorted(snapshot.entries.items())]
    states = spark.createDataFrame(rows, _ROWS).coalesce(1)
    states.write.mode("append").partitionBy("build").parquet(f"{lake}/state/builds")  # a reader opens the newest only


def read_version(
    spark: SparkSession, lake: str, snapshot: Snapshot, layer: str, name: str, months: set[int] | None = None,
) -> DataFrame:
    """A table as of a snapshot; tables by month keep the column ``ym``, and ``months`` picks their folders."""
    base = table_path(lake, layer, name)
    table = snapshot.entries[layer, name, 0]
    schema = table.schema()
    if MONTH not in schema.names:
        return spark.read.schema(schema).parquet(f"{base}/build={table.version}")
    found = snapshot.months(layer, name)
    paths = [f"{base}/build={e.version}/{MONTH}={ym}" for ym, e in sorted(found.items()) if months is None or ym in months]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def partition_months(spark: SparkSession, path: str) -> list[int]:
    """The months a build has written below ``path``; a listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if MONTH not in files.columns:
        return []
    return sorted(r[0] for r in files.select(F.col(MONTH).cast("int")).distinct().collect())


@contextmanager
def sole_writer(spark: SparkSession, lake: str) -> Iterator[None]:
    """Holds ``state/writer`` while a build runs; a second writer meets an error.

    The file is created at once or not at all. A driver that was killed leaves it; it names the application, and
    is removed by hand when that has ended.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{lake}/state/writer")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path.getParent())
    try:
        out = system.create(path, False)
    except Py4JJavaError as error:
        raise RuntimeError(f"{lake} is being built by another run: {path.toString()} is there") from error
    out.writeBytes(spark.sparkContext.applicationId)
    out.close()
    try:
        yield
    finally:
        drop_path(spark, path.toString())


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is; nothing if it is not there."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def drop_unused(spark: SparkSession, lake: str, current: Snapshot) -> None:
    """Remove the folders that only builds before the last one list; its readers may still be at work."""
    last = read_snapshot(spark, lake, current.build)
    older = None if last is None else read_snapshot(spark, lake, last.build)
    if last is None or older is None:
        return

    def folders(snapshot: Snapshot) -> set[str]:
        out = set()
        for (layer, name, ym), e in snapshot.entries.items():
            if layer in ("bronze", "seed"):
                continue
            base = f"{table_path(lake, layer, name)}/build={e.version}"
            if ym:
                out.add(f"{base}/{MONTH}={ym}")
            elif MONTH not in e.schema().names:
                out.add(base)
        return out

    for folder in sorted(folders(older) - folders(last) - folders(current)):
        drop_path(spark, folder)
