"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

1. *Targets.* Each source's share of all words follows its weight, at most
   ``max_copies`` times its own words; what a full source cannot take is reshared.
2. *Expected copies* of a document: its source's ratio of target to words, moved up for
   documents with more than the source's usual preference and down for others, so that
   the expected words stay the target and no document exceeds ``max_copies``.
3. The whole part of the expected copies is certain. The rest is the document's inclusion
   probability p in a Pareto order sample: documents are ranked by u/(1-u) : p/(1-p) with
   u from a hash of the document, and taken in that order while their words fit. The
   sample's size is fixed in words: it ends at the document nearest to what is left.

The order within a source is never sorted in one task: the rank is a number in [0, 2^30),
and three rounds of grouping by 1,024 bins narrow down the rank at which the sample
ends. Only sums per source and bin are shuffled. Equal rows share rank and fate.

Nulls: no text has size 0; rows without a source form a source of their own, last in
order. An empty table gives an empty mix; so does one without any word (target 0).
Columns other than ``doc_id``, ``text`` and ``source`` pass through ``mix`` as they are; ``taken`` does not read them.
Of a long text only its number of words is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import settle

WORD = r"[^\x20\x09-\x0D]+"
BITS = 10
ROUNDS = 3
FULL_PREFERENCE = 1_000
USUAL_SIZE = 300


def prefer_longer(size: Column) -> Column:
    """A preference from 0 to ``FULL_PREFERENCE`` that grows with the words of a document, and levels off."""
    return F.floor(size * F.lit(FULL_PREFERENCE) / (size + F.lit(USUAL_SIZE))).cast("long")


def draw(seed: int) -> Column:
    """48 random bits of a document, from a digest of its ``doc_id`` and text: the same in every run and engine."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), "text"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, max_copies: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Per source: its words and its target. One row per source; sources weigh ``weights`` in turn, null last.

    A source is full if its limit per weight lies below the level at which the others share
    what is left. With the sources in the order of limit per weight, the level after k full
    ones is (all - their limits) / (weights of the rest).
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "weight", F.col("source").isNull(), "source")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_source = (
        sizes.select("source", "source_size", "source_preference")
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
        .withColumn("limit", F.col("source_size") * max_copies)
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("full", F.coalesce(
            F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
        .withColumn("open", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")).cast("double") / F.col("open"))
    )
    fits = F.when(F.col("weight") * F.col("level") <= F.col("limit"), F.col("level"))
    return (
        per_source.withColumn("level", F.first(fits, ignorenulls=True).over(
            by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.least(F.col("limit").cast("double"),
                                      F.coalesce(F.col("weight") * F.col("level"), F.col("limit").cast("double"))))
        .select("source", "source_size", "source_preference", "target")
    )


def _same_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on the source, null with null. ``right`` is a written table of a row per source: Spark
    broadcasts it below its threshold, and otherwise splits a hot source's rows (skew join)."""
    renamed = right.withColumnRenamed("source", "_source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def plan(docs: DataFrame, max_copies: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7,
         preference=prefer_longer) -> tuple[DataFrame, DataFrame]:
    """Sized documents and, per source, target and the rank below which a document gets one copy more."""
    sized = (
        docs.select(
            "doc_id", "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            draw(seed).alias("draw"),
        )
        .withColumn("preference", preference(F.col("size")))
    )
    sized = settle(sized, "mix-sizes")
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("preference")).alias("source_preference"))
    aims = settle(targets(settle(sums, "mix-sources"), max_copies, weights), "mix-targets")
    ranked = _same_source(sized, aims).select("doc_id", "source", "size", *rank_columns(max_copies))
    cuts = settle(
        aims.select("source", "source_size", "target", F.lit(0).cast("long").alias("prefix"),
                    F.lit(0.0).alias("before")), "mix-cuts-0")
    for level in range(ROUNDS):
        cuts = settle(_narrowed(ranked, cuts, level), f"mix-cuts-{level + 1}")
    return sized, settle(aims.join(
        cuts.select(F.col("source").alias("_source"), F.col("prefix").alias("cut")),
        F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "mix-plan")


def rank_columns(max_copies: int) -> list[Column]:
    """Certain copies, and the Pareto rank of the rest, from size, preference, draw and the source's figures."""
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    room = F.least(ratio, F.lit(float(max_copies)) - ratio)
    usual = F.coalesce(F.try_divide("source_preference", "source_size"), F.lit(0.0))
    expected = ratio + room * (F.col("preference") - usual) / FULL_PREFERENCE
    expected = F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), expected))
    whole = F.floor(expected + F.lit(1e-9))
    p = F.greatest(F.lit(0.0), expected - whole)
    u = (F.col("draw") + 0.5) / float(1 << 48)
    odds = u / (1 - u) * F.try_divide(1 - p, p)
    last = (1 << (BITS * ROUNDS)) - 1
    rank = F.when(p > 0, F.least(F.lit(last), F.floor(odds / (1 + odds) * (last + 1)))).otherwise(F.lit(last + 1))
    return [whole.cast("long").alias("certain"), rank.cast("long").alias("rank")]


def _narrowed(ranked: DataFrame, cuts: DataFrame, level: int) -> DataFrame:
    """One round: within each source's current bin, the finer bin at which the words are used up.

    ``prefix`` holds the bits of the rank found so far, ``before`` the words of lower ranks.
    After the last round it is the first rank that no longer fits.
    """
    shift = BITS * (ROUNDS - 1 - level)
    known = _same_source(ranked, cuts.select("source", "target", "prefix", "before"))
    if level:
        known = known.filter(F.shiftright("rank", shift + BITS) == F.col("prefix"))
    sums = settle(known.groupBy("source", F.shiftright("rank", shift).alias("bin")).agg(
        F.sum("size").alias("words"), F.sum(F.col("certain") * F.col("size")).alias("certain_words")), "mix-bins")
    if not level:
        totals = sums.groupBy("source").agg(F.sum("certain_words").cast("double").alias("before"))
        cuts = _same_source(cuts.drop("before"), totals).select(*cuts.columns)
    bins = _same_source(sums.filter(F.col("bin") < F.lit(1 << (BITS * (level + 1)))).select("source", "bin", "words"),
                        cuts)
    in_order = Window.partitionBy("source").orderBy("bin")
    upto = bins.withColumn("upto", F.col("before") + F.sum("words").over(in_order))
    last_round = level == ROUNDS - 1
    # A bin is inside as a whole; at last, whatever lies nearer to the target with the documents of the rank.
    fits = F.col("upto") - (F.col("words") / 2 if last_round else F.lit(0.0)) <= F.col("target")
    inside = upto.groupBy("source").agg(
        F.max(F.when(fits, F.col("bin"))).alias("last"), F.max(F.when(fits, F.col("upto"))).alias("used"),
        F.min(F.when(~fits, F.col("bin"))).alias("next"))
    after, following = F.col("last") + 1, F.col("next")
    prefix = F.coalesce(after, following) if last_round else F.coalesce(following, after)
    found = inside.select(F.col("source").alias("_source"), prefix.alias("found"), "used")
    base = F.shiftleft("prefix", BITS) if level else F.lit(0).cast("long")
    return (
        cuts.join(found, F.col("source").eqNullSafe(F.col("_source")), "left")
        .select("source", "source_size", "target", F.coalesce("found", base).alias("prefix"),
                F.coalesce("used", "before").alias("before"))
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per document: ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes of it."""
    sized, cuts = plan(docs, **options)
    return _copies(sized, cuts, options.get("max_copies", 3)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def _copies(sized: DataFrame, cuts: DataFrame, max_copies: int) -> DataFrame:
    joined = _same_source(sized, cuts)
    ranked = joined.select(*sized.columns, "source_size", "target", "cut", *rank_columns(max_copies))
    return ranked.withColumn("copies", F.col("certain") + F.when(F.col("rank") < F.col("cut"), 1).otherwise(0))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, in the columns of ``docs``.

    Sizes and draws are worked out anew for each row, so no document has to be matched with its decision.
    """
    max_copies, seed = options.get("max_copies", 3), options.get("seed", 7)
    preference = options.get("preference", prefer_longer)
    _, cuts = plan(docs, **options)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    sized = (
        docs.select(held, F.col("source"), size.alias("size"),
                    draw(seed).alias("draw"))
        .withColumn("preference", preference(F.col("size")))
    )
    copies = _copies(sized, cuts, max_copies).filter("copies > 0")
    return copies.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("_row.*")
