"""Unpivot, pivot and flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_named(
    df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], name: str, value: str
) -> DataFrame:
    """Columns to rows under given labels; rows with a NULL value are dropped."""
    wide = df.select(*ids, *[F.col(c).alias(label) for label, c in columns.items()])
    return wide.unpivot(list(ids), [F.col(f"`{c}`") for c in columns], name, value).filter(
        F.col(value).isNotNull()
    )


def pivot_fixed(
    df: DataFrame, index: str, header: str, values: Sequence[str], aggregate: Column
) -> DataFrame:
    """Rows to columns with a fixed header list, so no job runs to discover it."""
    return df.groupBy(index).pivot(header, list(values)).agg(aggregate)


def both_ends(df: DataFrame, first: Mapping[str, str], second: Mapping[str, str]) -> DataFrame:
    """One row per end of each input row, in one pass over the input.

    Both mappings give the output column and the input column it comes from.
    """
    ends = [
        F.struct(*[F.col(source).alias(out) for out, source in end.items()]) for end in (first, second)
    ]
    return df.select(F.inline(F.array(*ends)))


def zip_arrays(names: Sequence[str], arrays: Sequence[Column]) -> Column:
    """Parallel arrays to an array of structs; unequal lengths are an error, not padding."""
    first, *rest = arrays
    same = F.lit(True)
    for other in rest:
        same = same & (F.size(other) == F.size(first))
    zipped = F.arrays_zip(*[a.alias(n) for n, a in zip(names, arrays)])
    return F.when(same, zipped).otherwise(F.raise_error(F.lit("parallel arrays differ in length")))
