"""Line de-duplication by overlapping windows of three lines.

Every run of three consecutive lines is hashed; a text of fewer lines has one window of
all its lines; windows of blank lines do not count. A window that occurs again anywhere
keeps its first place, in the order of document and line, and loses the later ones: the
lines that later places cover, merged, are cut out of their texts.

Hashes have 128 bits. First places are found by a combined minimum, so a window that a
third of all documents share costs a row per task. Rows with equal ``doc_id`` and text are
one document and share its result; a null ``doc_id`` comes last. Null texts stay null,
texts without repeated windows stay as they are, byte for byte.
An empty table gives an empty table. The lines of a long text are one row's array. Other columns pass through;
``n_lines`` and ``n_removed`` replace the caller's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import settle

WINDOW = 3


def _document() -> Column:
    return F.xxhash64("doc_id", "text")


def windows(docs: DataFrame) -> DataFrame:
    """One row per window: document, first line (from 0), lines, and hash."""
    lines = F.col("lines")
    starts = F.sequence(F.lit(0), F.greatest(F.size(lines) - WINDOW, F.lit(0)))
    line = lambda i, k: F.get(lines, i + k)  # noqa: E731  null beyond the end
    window = lambda i: F.struct(
        i.alias("line"),
        F.xxhash64(F.lit(1), *[F.coalesce(line(i, k), F.lit("\n")) for k in range(WINDOW)]).alias("h1"),
        F.xxhash64(*[F.coalesce(line(i, k), F.lit("\n")) for k in range(WINDOW)], F.lit(2)).alias("h2"),
        F.trim(F.concat_ws("", *[line(i, k) for k in range(WINDOW)])).alias("words") != "",
    )
    return (
        docs.filter(F.col("text").isNotNull())
        .select("doc_id", _document().alias("document"), F.split("text", "\n", -1).alias("lines"))
        .select("doc_id", "document", F.inline(F.transform(starts, window)))
        .toDF("doc_id", "document", "line", "h1", "h2", "counts")
        .filter("counts").drop("counts")
    )


def repeated(docs: DataFrame) -> DataFrame:
    """Per document the first lines of its windows that occurred before: ``document``, ``doc_id``, ``starts``."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "document", "line")
    found = windows(docs).distinct()
    groups = (
        found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("places"))
        .filter("places > 1").drop("places")
    )
    later = found.join(settle(groups, "windows"), ["h1", "h2"]).filter(
        (F.col("document") != F.col("first.document")) | (F.col("line") != F.col("first.line"))
        | ~F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    return later.groupBy("document", "doc_id").agg(F.collect_list("line").alias("starts"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines`` and ``n_removed`` of each text (0 for null).

    ``doc_id`` and ``text`` are used; the other columns, whatever their names, pass through.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")])
    rows = docs.select(held.alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                       _document().alias("_document"))
    cut = repeated(docs.select("doc_id", "text")).select(
        F.col("document").alias("_cut_document"), F.col("doc_id").alias("_cut_id"), "starts")
    joined = rows.join(
        cut, (F.col("_document") == F.col("_cut_document")) & F.col("_id").eqNullSafe(F.col("_cut_id")), "left")
    lines = F.split("_text", "\n", -1)
    covered = F.flatten(F.transform("starts", lambda i: F.sequence(i, i + WINDOW - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    text = F.when(F.col("starts").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    n_lines = F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines))
    removed = F.when(F.col("starts").isNull(), 0).otherwise(F.size(lines) - F.size(left))
    return joined.select(
        "_row.*", text.alias("text"), n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))
