"""Zipped extracts as a Spark data source: ``spark.read.format("zipped_extracts").load(folder)``.

A partition is an archive. Its first delimited member is read through a file handle, block by block
as Arrow batches, so neither an archive nor its member is ever whole in a worker, and their size has
no bound. The columns are those of the schema the reader is given (all wanted ones without).
As a stream the source brings every archive once: an offset is the list of the archives seen.

Paths are opened by ``pyarrow.fs``: local and mounted folders, and the stores Arrow knows by their scheme.
"""

from __future__ import annotations

import json
import sys
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tarmac.schemas import RAW_EXTRACT
from tarmac.sources.stores import stored

FORMAT = "zipped_extracts"
SOURCE_FILE = "_source_file"
BLOCK_BYTES = 8 << 20


def archives(locations: Sequence[str]) -> list[str]:
    """The zip files at or below the locations, in order; those that are not there count as empty. A listing."""
    found = []
    for location in locations:
        system, path = stored(location)
        scheme = location.split("://")[0] + "://" if "://" in location and not location.startswith("file:") else ""
        infos = [system.get_file_info(path)]
        if infos[0].type == fs.FileType.Directory:
            infos = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        found += [scheme + i.path for i in infos if i.type == fs.FileType.File and i.path.lower().endswith(".zip")]
    return sorted(set(found))


def member_rows(path: str, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The columns of an archive's first delimited member as text, block by block."""
    system, name = stored(path)
    wanted = [c for c in columns if c != SOURCE_FILE] or [RAW_EXTRACT.names[0]]
    with system.open_input_file(name) as handle, zipfile.ZipFile(handle) as archive:
        members = [n for n in archive.namelist() if n.lower().endswith(".csv")]
        if not members:
            raise ValueError(f"no delimited member in {path}")
        with archive.open(members[0]) as member:
            blocks = csv.open_csv(
                member,
                read_options=csv.ReadOptions(encoding="latin-1", block_size=BLOCK_BYTES),
                parse_options=csv.ParseOptions(newlines_in_values=True),
                convert_options=csv.ConvertOptions(
                    include_columns=wanted, column_types={c: pa.string() for c in wanted}, strings_can_be_null=False),
            )
            for block in blocks:
                source = pa.array([PurePosixPath(name).name] * block.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [source if c == SOURCE_FILE else block.column(c) for c in columns], names=list(columns))


@dataclass
class Archive(InputPartition):
    path: str


class ArchiveReader(DataSourceReader):
    def __init__(self, locations: list[str], schema: T.StructType):
        self.locations = locations
        self.columns = schema.names

    def partitions(self) -> list[InputPartition]:
        return [Archive(path) for path in archives(self.locations)] or [Archive("")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from member_rows(partition.path, self.columns)


class ArchiveStream(ArchiveReader, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {"seen": "[]"}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"seen": json.dumps(archives(self.locations))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before = set(json.loads(start["seen"]))
        return [Archive(path) for path in json.loads(end["seen"]) if path not in before]


class ZippedExtracts(DataSource):
    """Options: ``path``, or ``paths`` as a JSON list."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return RAW_EXTRACT

    def locations(self) -> list[str]:
        return json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(self.locations(), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return ArchiveStream(self.locations(), schema)


def register(spark: SparkSession) -> None:
    """Make the format known to the session; the code travels with the job."""
    from tarmac import schemas
    from tarmac.sources import stores

    for module in (sys.modules[__name__], schemas, stores):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(ZippedExtracts)


def read_zips(spark: SparkSession, paths: str | Sequence[str], *columns: str) -> DataFrame:
    """Raw text rows of the archives at or below the paths; given columns only, or all."""
    register(spark)
    locations = [paths] if isinstance(paths, str) else list(paths)
    wanted = T.StructType([f for f in RAW_EXTRACT if not columns or f.name in columns])
    return spark.read.format(FORMAT).schema(wanted).option("paths", json.dumps(locations)).load()


def stream_zips(spark: SparkSession, landing: str) -> DataFrame:
    register(spark)
    return spark.readStream.format(FORMAT).option("paths", json.dumps([landing])).load()
