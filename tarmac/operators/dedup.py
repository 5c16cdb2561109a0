"""Latest-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The slots that the hashes of repeated keys are marked in: 16 MB of bits, whatever the number of rows.
SLOTS = 1 << 27


def fingerprint(df: DataFrame) -> Column:
    """A hash of every column: a stable last tie-breaker that shuffles as eight bytes."""
    return F.xxhash64(*df.columns)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``.

    Catalyst turns the filter into a group limit on both sides of the shuffle, so a
    key with very many copies leaves every map task as one row. A hash of the keys
    leads the partitioning: it gives the sort a 64-bit prefix that nearly always
    decides, while filters on any of ``keys`` still pass below the window.
    """
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_hash", F.xxhash64(*keys))
        .withColumn("_row", F.row_number().over(window))
        .filter(F.col("_row") == 1)
        .drop("_hash", "_row")
    )


def latest_where_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows of ``latest_by``, for keys of which most occur once: only rows whose key may repeat move.

    Hashes of keys are counted, and those that repeat are marked in a bitmap of fixed size that every
    task gets. Rows in unmarked slots are alone with their key and stay where they are; the others, among them
    the few that share a slot by chance, go through the window.
    """
    slot = F.col("_hash").bitwiseAND(F.lit(SLOTS - 1)) + 1
    bucket, place = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    marks = repeated.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("_marks"))
    placed = hashed.select("*", bucket.alias("_bucket"), place.alias("_place")).join(F.broadcast(marks), "_bucket", "left")
    eight = F.conv(F.hex(F.expr("substring(_marks, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(eight, (F.col("_place") % 8).cast("int")) == 1, F.lit(False))
    alone, others = (placed.filter(which).select(*df.columns) for which in (~marked, marked))
    return latest_by(others, keys, order).union(alone)
