"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def builder(app: str = "tarmac") -> SparkSession.Builder:
    """A session builder with the settings the jobs are tuned for.

    No expression in the package depends on the session time zone, so a session
    owned by somebody else gives the same results.
    """
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` has processes of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a
    temporary folder, which is set on the context so later calls agree.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_seen: set[str] = set()


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps what it derives; removed when it ends."""
    app = spark.sparkContext.applicationId
    folder = os.path.join(shared_folder(spark), "tarmac", app)
    if app not in _seen:
        _seen.add(app)
        atexit.register(clear_scratch, spark, folder)
    return folder


def clear_scratch(spark: SparkSession, folder: str | None = None) -> None:
    """Remove the application's folder, on whatever file system it is; a stopped session leaves it."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder or application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path in the application's folder."""
    return os.path.join(application_folder(spark), f"{name}-{uuid.uuid4().hex}")


#: How many folders of a partitioned table a task writes side by side; one that meets more sorts the rest of its rows.
SIDE_BY_SIDE = "spark.sql.maxConcurrentOutputFileWriters"
_FOLDERS = 4
#: The bytecode of a generated method beyond which an operator is compiled in pieces; the JVM leaves methods above 8,000 uncompiled.
METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"
_COMPILED = 8000
_uses: dict[tuple[str, str], tuple[int, str | None]] = {}
_guard = threading.Lock()


@contextmanager
def _held(spark: SparkSession, setting: str, value: Callable[[str | None], int]) -> Iterator[None]:
    """The session setting has ``value`` of its own one; users at the same time share it, and the last one gives the session its own back."""
    use = spark._jsparkSession.sessionUUID(), setting
    with _guard:
        uses, own = _uses.get(use, (0, spark.conf.get(setting, None)))
        _uses[use] = (uses + 1, own)
        spark.conf.set(setting, str(value(own)))
    try:
        yield
    finally:
        with _guard:
            uses, own = _uses.pop(use)
            if uses > 1:
                _uses[use] = (uses - 1, own)
            elif own is None:
                spark.conf.unset(setting)
            else:
                spark.conf.set(setting, own)


def side_by_side(spark: SparkSession) -> AbstractContextManager[None]:
    """Partitioned writes in it do not sort a task's whole rows by folder, for rows that come by few folders a task."""
    return _held(spark, SIDE_BY_SIDE, lambda own: max(_FOLDERS, int(own or 0)))


def compiled(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs in it run wide projections, such as every column of an extract, as methods that the JVM compiles."""
    return _held(spark, METHOD_BYTES, lambda own: min(_COMPILED, int(own or _COMPILED)))
