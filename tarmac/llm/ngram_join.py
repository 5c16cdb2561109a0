"""Near-duplicate classes by a grouped prefix join over word n-grams.

Two texts link when the Jaccard similarity of their sets of n-grams reaches a percentage,
compared in whole numbers. For a set of n n-grams in one global order, any partner shares
one of the first n - ceil(p n / 100) + 1: the prefix. Sets with the same prefix and size
form one group; the join runs over groups, filters pairs by size and by the place of the shared
n-gram, and expands and verifies their members, whole texts against whole texts.

*Order.* N-grams met often stand last, so that passages many texts share are in no
prefix unless little else is there. The frequent ones are found over all texts: repeated within
a task's share, summed over tasks, and kept while at most ``MAX_FREQUENT`` (their table
travels to the tasks; the least count rises until it fits). The order decides how much
there is to compare, never what links.

*No all-pairs.* Only connections matter. First every set is compared with one pivot, the
set with the fewest n-grams before one they share, in a class of copies the least changed:
trees that hold nearly all of a class. Then, per n-gram whose sets lie in several trees, the sets outside the
n-gram's main tree are compared with the sets of other trees. Pairs within a tree are never made.

Null, empty and blank texts have an empty set and link with nothing. Equal sets are one set,
known by 64 bits of a digest. Rows may repeat; without ``doc_id`` a row joins its text's class.
Words are compared by 64 bits of a hash that mixes eight bytes at a time. An empty table gives an empty table. Columns
other than ``doc_id`` and ``text`` are not read. A long text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import components
from tarmac.llm.tables import chunks, settle
from tarmac.llm.words import shingle_sets

MAX_FREQUENT = 1 << 20
LEAST_FREQUENT = 16
HELD_HASHES = 1 << 22
FILTER_WORDS = 1 << 18


@dataclass(frozen=True)
class Rule:
    """N-grams of ``width`` words; a link at 100 * shared >= ``percent`` * all."""

    width: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        return n + (-self.percent * n // 100) + 1 if n else 0

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= self.percent * (len(a) + len(b) - shared)


def _digest(values: np.ndarray, tag: bytes = b"") -> int:
    return int.from_bytes(blake2b(values.tobytes(), digest_size=8, key=tag).digest(), "little", signed=True)


def frequent(docs: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of most sets, sorted, and their counts; ``MAX_FREQUENT`` at most."""
    kind = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def repeated(values: np.ndarray) -> pa.RecordBatch:
        """Sorted in place, as the hashes are the largest thing a task holds."""
        values.sort()
        same = np.zeros(len(values) + 1, np.int8)
        same[1:-1] = values[1:] == values[:-1]
        step = np.diff(same, prepend=np.int8(0))
        starts, ends = np.flatnonzero(step == 1) - 1, np.flatnonzero(step == -1) - 1
        return pa.RecordBatch.from_arrays([pa.array(values[starts].view(np.int64)), pa.array(ends - starts + 1)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = np.empty(HELD_HASHES, np.uint64), 0, set()
        for _, texts in chunks(batches):
            for values in shingle_sets(texts, rule.width):
                digest = _digest(values)
                if digest in seen or len(values) > HELD_HASHES:  # a set alone repeats nothing
                    continue
                if size + len(values) > HELD_HASHES:
                    yield repeated(held[:size])
                    size, seen = 0, set()
                seen.add(digest)
                held[size:size + len(values)] = values
                size += len(values)
        if size:
            yield repeated(held[:size])

    counted = settle(
        docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_FREQUENT), "frequent")
    least = LEAST_FREQUENT
    while counted.filter(F.col("n") >= least).count() > MAX_FREQUENT:
        least *= 2
    table = counted.filter(F.col("n") >= least).toArrow()
    grams = table.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], table.column("n").to_numpy()[order]


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, set size ``n``, digest of the set, group, and prefix."""
    grams, counts = frequent(docs, rule)
    shared = docs.sparkSession.sparkContext.broadcast((grams, counts))
    kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("grp", pa.int64()),
                      ("prefix", pa.list_(pa.int64()))])

    def in_order(values: np.ndarray, wanted: int, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(grams):
            return values[:wanted]
        at = np.minimum(np.searchsorted(grams, values), len(grams) - 1)
        often = grams[at] == values
        rare = values[~often][:wanted]
        if len(rare) == wanted:
            return rare
        common, n = values[often], counts[at[often]]
        return np.concatenate([rare, common[np.lexsort((common, n))][:wanted - len(rare)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = shared.value
        for batch, texts in chunks(batches):
            sets = shingle_sets(texts, rule.width)
            prefixes = [in_order(s, rule.prefix(len(s)), grams, counts) for s in sets]
            sizes = np.array([len(s) for s in sets], np.int64)
            groups = [_digest(np.append(p, np.uint64(len(s))), b"prefix") for p, s in zip(prefixes, sets)]
            offsets = np.cumsum([0] + [len(p) for p in prefixes])
            flat = np.concatenate([np.zeros(0, np.uint64), *prefixes]).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array([_digest(s) for s in sets]),
                pa.array(groups), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
            ], schema=kind)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, digest long, grp long, prefix array<long>")


def _bits(ids: DataFrame) -> np.ndarray:
    """A one-hash filter of ``FILTER_WORDS`` words of 64 bits over the ids: a bounded table that lets all of them pass."""
    word = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS))
    bit = F.pmod(F.shiftright(F.xxhash64("doc_id"), 40), F.lit(64)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    found = ids.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(FILTER_WORDS, np.int64)
    bits[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return bits


def _texts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``digest`` and ``text`` of the given sets' first documents.

    The bounded filter drops most other rows before the shuffle of the join; what passes it
    by chance, the join drops.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_bits(sets))

    @F.pandas_udf("boolean")
    def may_be(h: pd.Series) -> pd.Series:
        h = h.to_numpy()
        return pd.Series((bits.value[h % FILTER_WORDS] >> ((h >> 40) % 64)) & 1 == 1)

    rows = docs.select("doc_id", "text").filter(may_be(F.xxhash64("doc_id")))
    wanted = sets.select(F.col("doc_id").alias("_id"), "digest")
    return rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select("digest", "text")


def _verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of digests whose whole texts link."""
    left = pairs.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b")
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text_a"):
            others = [t or "" for t in batch.column("text_b").to_pylist()]
            ours, theirs = shingle_sets(texts, rule.width), shingle_sets([t.encode() for t in others], rule.width)
            keep = [
                _digest(x) == a and _digest(y) == b and rule.linked(x, y)
                for a, b, x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), ours, theirs)
            ]
            some = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(some.columns, schema=kind)

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _may_link(rule: Rule) -> Column:
    """Whether two sets of ``n`` and ``m`` n-grams can link that share one at the places ``pos`` and ``pos_b``.

    Sizes have to be near. At the first n-gram they share, all they share lies from there on in
    both, so what is left in either bounds it. Linked sets pass at their first shared n-gram.
    """
    p, n, m = rule.percent, F.col("n"), F.col("m")
    sizes = (n * 100 >= m * p) & (m * 100 >= n * p)
    return sizes & ((100 + p) * F.least(n - F.col("pos"), m - F.col("pos_b")) >= p * (n + m))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, and ``component_id``, the smallest ``doc_id`` of its class."""
    rows = settle(signatures(docs, rule), "signatures")
    some = rows.filter("n > 0")
    sets = settle(some.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("grp").alias("grp")), "distinct-sets")

    # The join over groups: n-grams in the prefixes of several groups.
    postings = some.select("grp", F.posexplode("prefix").alias("pos", "gram"))
    meeting = postings.groupBy("gram").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter(
        "low < high").select("gram")
    joined = postings.join(settle(meeting, "meeting"), "gram").distinct()

    # Expanded to their sets; the sets of one group meet under the group's own name.
    members = sets.select("grp", "digest", "n")
    fellows = members.groupBy("grp").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter(
        "low < high").select("grp")
    expanded = settle(
        joined.join(members, "grp").select("gram", "digest", "n", "pos").union(
            members.join(fellows, "grp").select(F.col("grp").alias("gram"), "digest", "n", F.lit(0).alias("pos"))),
        "postings")
    met = settle(sets.join(expanded.select("digest").distinct(), "digest", "left_semi"), "sets")
    texts = settle(_texts(docs, met), "texts")

    # One pivot for every set: the one with the fewest n-grams before one they share.
    pivots = settle(expanded.groupBy("gram").agg(
        F.min(F.struct("pos", "digest", "n")).alias("pivot")).select("gram", "pivot.*").toDF(
            "gram", "pos_b", "b", "m"), "pivots")
    first = expanded.join(pivots, "gram").filter((F.col("digest") != F.col("b")) & _may_link(rule))
    chosen = first.groupBy(F.col("digest").alias("a")).agg(F.min(F.struct("pos_b", "b"))["b"].alias("b"))
    trees = components(_verified(settle(chosen, "chosen"), texts, rule), "trees")

    # Sets of other trees than the main one of an n-gram they share.
    placed = settle(
        expanded.join(trees, F.col("digest") == F.col("node"), "left")
        .select("gram", "digest", "n", "pos", F.coalesce("component", "digest").alias("tree")), "placed")
    per_tree = placed.groupBy("gram", "tree").agg(F.count("*").alias("size"))
    open_grams = per_tree.groupBy("gram").agg(
        F.max(F.struct("size", "tree"))["tree"].alias("main"), F.count("*").alias("trees")).filter("trees > 1")
    opened = settle(placed.join(settle(open_grams.drop("trees"), "open"), "gram"), "opened")
    strays = opened.filter("tree != main").select("gram", F.col("digest").alias("a"), "n", "pos", F.col("tree").alias("tree_a"))
    others = opened.select(
        "gram", F.col("digest").alias("b"), F.col("n").alias("m"), F.col("pos").alias("pos_b"), F.col("tree").alias("tree_b"),
        (F.col("tree") == F.col("main")).alias("in_main"))
    crossing = (
        strays.join(others, "gram")
        .filter((F.col("tree_a") != F.col("tree_b")) & (F.col("in_main") | (F.col("a") < F.col("b"))) & _may_link(rule))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    bridges = _verified(settle(crossing, "crossing"), texts, rule)
    links = trees.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a != b").union(bridges)
    classes = components(links, "classes").select(F.col("node").alias("digest"), "component")

    known = sets.select("digest", "doc_id").join(classes, "digest", "left").select(
        "digest", "doc_id", F.coalesce("component", "digest").alias("component"))
    least = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = known.join(least, "component").select("digest", "component_id")
    return rows.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
