"""Near-duplicate vectors by a pivot-permutation index.

Each vector is described by its nearest of M reference points, nearest first. The points
are a sample of the vectors; M grows with the root of their number, which keeps the inverted lists
short. A list belongs to two points: it holds the vectors that have both among their nearest, so vectors
that meet in a list share at least two pivots. A pair is looked at in one of its lists, that of the two
smallest shared pivots, and verified by its cosine in double precision. Pairs below the threshold never
link; a close pair is missed only if it shares fewer than two pivots (the recall is measured
against brute force in the tests).

Vectors that have a direction in common are told apart by what is left without it: points and
vectors are centred for the index, never for the verification. How many pivots describe a vector
(``PLANS``) is fitted on the sample: as many as let pairs right at the threshold share two. Where
that would compare more than all pairs, because the table is small or nearly all of it is close, there
is one list of all vectors and every pair is looked at once.

Each length of vectors has an index of its own; a length of fewer than ``FEW`` vectors has one list.
Equal vectors are one, with a weight. Lists longer than ``BLOCK`` are dealt in blocks by a hash, and every two
blocks meet in a task of their own, so no list is gathered in one place. A task reports per vector its
number of links and one edge to its local class, not pairs.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing.
Rows may repeat: each is a vector of its own. Other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import components
from tarmac.llm.tables import settle, widened

MAX_POINTS = 1 << 14
FEW = 1_024
BLOCK = 512
#: Pivots that describe a vector, and the length of lists that the number of points aims at.
PLANS = [(6, 24), (7, 18), (8, 14), (9, 12), (10, 10), (12, 8), (14, 7), (16, 6), (20, 5), (24, 5)]
FITTED_RECALL = 0.96
FITTED_PAIRS = 1_000
POINT_BYTES = 64 << 20


def unit_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 in double precision, and which rows have one."""
    lists = column.cast(pa.large_list(pa.float64()))
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width))
    fits = lengths == width
    if width and fits.any():
        picked = lists.filter(pa.array(fits))
        out[fits] = picked.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    with np.errstate(all="ignore"):
        out /= np.abs(out).max(axis=1, initial=0)[:, None]  # no overflow in the squares
        out /= np.sqrt((out * out).sum(axis=1))[:, None]
    fits &= np.isfinite(out).all(axis=1)
    out[~fits] = 0
    return out, fits


def points_wanted(n: int, kept: int, length: int, width: int) -> int:
    """As many points as keep the lists of ``n`` vectors about ``length`` long; what tasks hold of them is bounded."""
    return int(min(MAX_POINTS, POINT_BYTES // (8 * width), max(24, np.sqrt(n * kept * (kept - 1) / length))))


def directions(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Unit vectors seen from the centre; those in it have none and get zeros."""
    rest = vectors - centre
    size = np.sqrt((rest * rest).sum(axis=1))[:, None]
    return np.divide(rest, size, out=np.zeros_like(rest), where=size > 1e-9)


def spread(points: np.ndarray, wanted: int) -> np.ndarray:
    """The first points in order that are not nearly equal to one before: those tell nothing apart."""
    kept, n = np.empty((min(wanted, len(points)), points.shape[1])), 0
    for at in range(0, len(points), 256):
        block = points[at:at + 256]
        block = block[block.any(axis=1)]
        block = block[(block @ kept[:n].T).max(axis=1, initial=-1) < 0.8]
        alike = block @ block.T >= 0.8
        own: list[int] = []
        for i in range(len(block)):
            if not alike[i, own].any():
                own.append(i)
        own = own[:len(kept) - n]
        kept[n:n + len(own)] = block[own]
        n += len(own)
        if n == len(kept):
            break
    return kept[:n]


def at_threshold(sample: np.ndarray, centre: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors with a cosine just at the threshold, from the centre in directions the sample has."""
    n = len(sample) // 2
    ours, others = sample[:n], directions(sample[n:2 * n], centre)
    own = directions(ours, centre)
    others -= (others * own).sum(axis=1)[:, None] * own
    others = directions(others, np.zeros_like(centre))
    size = np.sqrt(((ours - centre) ** 2).sum(axis=1))[:, None]
    best = ours.copy()
    for share in np.linspace(1, 0, 41):
        moved = centre + size * (share * own + np.sqrt(1 - share * share) * others)
        moved /= np.maximum(np.sqrt((moved * moved).sum(axis=1)), 1e-12)[:, None]
        near = (ours * moved).sum(axis=1) >= threshold
        best[near] = moved[near]
    return ours, best


@dataclass
class Space:
    """How the vectors of one length are described: by ``kept`` of the points, or, without points, all alike."""

    first: int
    kept: int = 2
    centre: np.ndarray | None = None
    points: np.ndarray | None = None

    def nearest(self, units: np.ndarray) -> np.ndarray:
        if self.points is None:
            return np.tile(np.arange(self.first, self.first + 2, dtype=np.int32), (len(units), 1))
        out = np.empty((len(units), self.kept), np.int32)
        step = max(1, (4 << 20) // len(self.points))
        for at in range(0, len(units), step):
            likeness = directions(units[at:at + step], self.centre) @ self.points.T
            out[at:at + step] = np.argsort(-likeness, axis=1, kind="stable")[:, :self.kept] + self.first
        return out


def fitted(sample: np.ndarray, n: int, threshold: float, first: int) -> Space:
    """The cheapest plan by which pairs at the threshold share two pivots; one list if it compares more than all pairs."""
    if not len(sample):
        return Space(first)
    centre = sample.mean(axis=0)
    tried = min(2 * FITTED_PAIRS, len(sample) // 3)  # no points: a point would find what is near to it too well
    pairs = at_threshold(sample[:tried], centre, threshold)
    wanted = [points_wanted(n, kept, length, sample.shape[1]) for kept, length in PLANS]
    apart = spread(directions(sample[tried:], centre), max(wanted))
    for (kept, length), most in zip(PLANS, wanted):
        if kept * (kept - 1) * length >= n:  # half the lists' cells a vector, and as much again for lists of unlike length
            break
        points = apart[:most]
        if len(points) <= kept:
            break
        space = Space(first, kept, centre, points)
        ours, theirs = (space.nearest(side) for side in pairs)
        shared = (ours[:, :, None] == theirs[:, None, :]).any(axis=2).sum(axis=1)
        if len(shared) and (shared >= 2).mean() >= FITTED_RECALL:
            return space
    return Space(first)


def fit(vectors: DataFrame, threshold: float) -> dict[int, Space]:
    """A space for every length of vectors, from a sample by a hash of their values, at most ``2 * (MAX_POINTS + FITTED_PAIRS)`` each."""
    sizes = vectors.filter(F.size("embedding") > 0).groupBy(F.size("embedding").alias("width")).count().collect()
    spaces, first = {}, 0
    for width, n in sorted((r["width"], r["count"]) for r in sizes):
        sample = np.zeros((0, width))
        if n >= FEW:
            wanted = max(2 * points_wanted(n, kept, length, width) for kept, length in PLANS) + 2 * FITTED_PAIRS
            some = vectors.filter(F.size("embedding") == width).orderBy(F.xxhash64("embedding"), "uid").limit(wanted)
            sample, fits = unit_vectors(some.select("embedding").toArrow().column(0).combine_chunks(), width)
            sample = sample[fits]
        spaces[width] = fitted(sample, n, threshold, first)
        first += 2 if spaces[width].points is None else len(spaces[width].points)
    return spaces


def index(vectors: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """``uid``, ``copies``, ``embedding`` and ``nearest``, the pivots of every vector that has a direction; nearest first."""
    shared = vectors.sparkSession.sparkContext.broadcast(spaces)
    names = ["uid", "copies", "embedding", "nearest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("embedding")), 0).to_numpy(zero_copy_only=False)
            for width in np.unique(lengths[lengths > 0]).tolist():
                part = batch.filter(pa.array(lengths == width))
                units, fits = unit_vectors(part.column("embedding"), width)
                nearest = shared.value[width].nearest(units[fits])
                offsets = np.arange(len(nearest) + 1) * nearest.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(nearest.ravel()))
                some = part.filter(pa.array(fits))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=names)

    rows = vectors.select(*names[:3])
    return rows.mapInArrow(run, widened(rows, nearest="array<int>"))


def lists(indexed: DataFrame) -> DataFrame:
    """The inverted lists in blocks: a row per vector and block pair (``i`` <= ``j``) it takes part in."""
    ordered = F.array_sort("nearest")
    pair = lambda a: F.transform(F.filter(ordered, lambda b: b > a), lambda b: F.struct(a.alias("p"), b.alias("q")))
    postings = indexed.select("uid", F.explode(F.flatten(F.transform(ordered, pair))).alias("list")).select(
        "uid", "list.p", "list.q")
    lengths = postings.groupBy("p", "q").agg(F.count("*").alias("length")).filter("length > 1")
    placed = (
        postings.join(settle(lengths, "lists"), ["p", "q"])
        .withColumn("blocks", F.ceil(F.col("length") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("uid", "p", "q"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    dealt = placed.select("uid", "p", "q", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    return dealt.join(indexed, "uid")


def local_classes(linked: np.ndarray) -> np.ndarray:
    """For each row the smallest row it is connected with."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def block_links(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block pair of a list: vectors with links, their local class, and their number of links (copies count each)."""
    units, _ = unit_vectors(rows.column("embedding").combine_chunks(), len(rows.column("embedding")[0]))
    pivots = rows.column("nearest").combine_chunks().flatten().to_numpy().reshape(len(units), -1)
    uid, own = rows.column("uid").to_numpy(), rows.column("own").to_numpy()
    i, j, p, q = (rows.column(c)[0].as_py() for c in ("i", "j", "p", "q"))
    close = units @ units.T >= threshold
    np.fill_diagonal(close, False)
    if i != j:
        close &= own[:, None] != own[None, :]
    a, b = np.nonzero(np.triu(close))
    # The pair belongs to this list if its two smallest shared pivots are p and q.
    shared = (pivots[a][:, :, None] == pivots[b][:, None, :]).any(axis=2)
    below = (shared & (pivots[a] < q) & (pivots[a] != p)).any(axis=1)
    a, b = a[~below], b[~below]
    linked = np.zeros_like(close)
    linked[a, b] = linked[b, a] = True
    degree = linked @ rows.column("copies").to_numpy()
    some = degree > 0
    return uid[some], uid[local_classes(linked)][some], degree[some]


def links(dealt: DataFrame, threshold: float) -> DataFrame:
    """Per vector and block pair: ``uid``, a vector of its class there, and its number of links there."""
    names = ["p", "q", "i", "j"]
    kind = pa.schema([("uid", pa.int64()), ("fellow", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in names], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts.tolist()]
            for start, stop in zip(bounds, bounds[1:]):
                yield from found(table.slice(start, stop - start))
            held = table.slice(bounds[-1])
        if held is not None and held.num_rows:
            yield from found(held)

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows > 1:
            uid, fellow, n = block_links(rows, threshold)
            if len(uid):
                yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(fellow), pa.array(n)], schema=kind)

    together = dealt.repartition(*names).sortWithinPartitions(*names)
    return together.mapInArrow(run, "uid long, fellow long, n long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per row of ``vectors`` (``vec_id``, ``embedding``): ``n_links``, ``component_id`` and ``kept``."""
    rows = settle(vectors.select("vec_id", "embedding").withColumn("uid", F.monotonically_increasing_id()), "vectors")
    keys = [F.xxhash64(F.lit(i), "embedding").alias(f"k{i}") for i in (1, 2)]
    equal = settle(rows.select("uid", *keys).groupBy("k1", "k2").agg(
        F.min("uid").alias("one"), F.count("*").alias("copies")), "equal-vectors")
    distinct = settle(rows.select("uid", "embedding").join(
        equal.select(F.col("one").alias("uid"), "copies"), "uid"), "distinct-vectors")
    indexed = settle(index(distinct, fit(distinct, threshold)), "index")
    found = settle(links(lists(indexed), threshold), "links")
    classes = components(
        found.filter("uid != fellow").select(F.col("uid").alias("a"), F.col("fellow").alias("b")), "vectors")
    degrees = found.groupBy("uid").agg(F.sum("n").alias("n"))
    able = (
        indexed.select("uid", "copies")
        .join(classes.select(F.col("node").alias("uid"), "component"), "uid", "left")
        .join(degrees, "uid", "left")
        .select(F.col("uid").alias("one"), F.coalesce("component", "uid").alias("component"),
                (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    )
    placed = (
        rows.select("uid", "vec_id", *keys)
        .join(equal.select("k1", "k2", "one").join(able, "one"), ["k1", "k2"], "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "uid").alias("component"))
    )
    least = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(least, "component").select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
