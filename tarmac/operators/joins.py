"""Joins that broadcast only what was measured to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What every executor can hold beside its work, and what a row of a narrow lookup takes at most.
BROADCAST_BYTES = 128 << 20
ROW_BYTES = 128


def fits_broadcast(keys: DataFrame, limit: int = BROADCAST_BYTES, row_bytes: int = ROW_BYTES) -> bool:
    """Whether a lookup with these (possibly repeated) keys and rows of ``row_bytes`` takes at most ``limit`` bytes.

    Runs a job over the key columns alone; repeats are combined before the shuffle.
    """
    return keys.distinct().count() * row_bytes <= limit


def join_lookup(
    left: DataFrame, lookup: DataFrame, on: Sequence[str] | Column, how: str, small: bool
) -> DataFrame:
    """Join a lookup side: broadcast when measured ``small``, else left to the optimizer.

    The other way is a shuffled join whose hot keys the adaptive skew join splits.
    """
    return left.join(F.broadcast(lookup) if small else lookup, on, how)
