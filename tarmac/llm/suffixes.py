"""Removal of repeated strings of 400 bytes by blockwise suffix sorting with a difference cover.

A byte goes when it is covered by a string of ``WIDTH`` bytes that also starts elsewhere, in
the same text or another. Suffixes are sorted bucket by bucket, each bucket in one task:

* **Buckets.** The bucket of a suffix is the least hash of the ``GRAM``-byte strings within its
  first ``WIDTH`` bytes, so equal strings meet, and neighbouring suffixes mostly share a bucket
  and travel together as one piece of text. A bucket with one piece only, in which that hash
  occurs once, has nothing to repeat and is left out. This takes 24 bytes for some 185 suffixes.
* **Blocks.** Equal pieces become one row with a count before they move. A task reads its pieces
  in the order of the buckets and sorts about ``BLOCK`` bytes at a time. A bucket beyond that is
  dealt to several blocks by a hash of each suffix's first ``WIDTH`` bytes, so that equal ones still meet.
* **Sorting.** The suffixes at the places of a difference cover modulo ``PERIOD`` (6 of 31) are ranked
  first, by doubling. Then all suffixes are sorted by 32 bytes, and of two that tie, the ranks at
  the next places that are in the cover for both decide. Neighbours in that order are compared
  byte for byte up to ``WIDTH`` where the ranks differ.

Equal texts are one: they share their key (128 bits of hash), are searched once, and are removed
whole if they have ``WIDTH`` bytes. Null counts as empty. Repeated rows, null or repeated ``doc_id``
play no part, as rows are told apart by text. An empty table gives an empty table. Long texts are
searched in slices of ``SLICE`` suffixes. What is kept is bytes: a cut may fall within a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import settle, widened
from tarmac.llm.words import mixed

WIDTH = 400
GRAM = 32
SLICE = 1 << 20
PIECE = 2048
BLOCK = 2 << 20
#: A perfect difference set, every difference modulo 31 occurs once.
PERIOD, COVER = 31, np.array([1, 5, 11, 24, 25, 27])
SORTED_BYTES = 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_NOT_COVERED = -1
_COLUMN = np.full(PERIOD, _NOT_COVERED)
_COLUMN[COVER] = np.arange(len(COVER))
#: By the two residues, the least step after which both suffixes are in the cover.
_STEP = np.array([[next(d for d in range(PERIOD) if _COLUMN[(r + d) % PERIOD] >= 0 <= _COLUMN[(s + d) % PERIOD])
                   for s in range(PERIOD)] for r in range(PERIOD)])

Spans = "array<struct<first:long,last:long>>"


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from every place."""
    steps = np.full(len(data) + 1, _BASE)
    steps[0] = 1
    up = np.multiply.accumulate(steps)
    back = np.full(len(data) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    back[0] = 1
    down = np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:len(data)])])
    return mixed((sums[width:] - sums[:-width]) * down[:len(data) - width + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: prefix and suffix minima of blocks of that width."""
    padded = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def bucket_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, first suffix and length of each run of suffixes of one bucket, and whether its hash occurs twice in it."""
    wide = WIDTH - GRAM + 1
    hashes = gram_hashes(data, GRAM)
    least = sliding_least(hashes, wide)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    size = np.diff(np.concatenate([first, [len(least)]]))
    spans = size + wide - 1
    ends = np.cumsum(spans)
    place = np.arange(ends[-1]) + np.repeat(first - (ends - spans), spans)
    again = np.add.reduceat(hashes[place] == np.repeat(least[first], spans), ends - spans, dtype=np.int64) > 1
    return least[first], first, size, again


def _key() -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(2), "text").alias("k2")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k1, k2, text in zip(*(batch.column(i) for i in range(3))):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for at in range(0, len(data) - WIDTH + 1, SLICE):
                bucket, first, size, again = bucket_runs(data[at:at + SLICE + WIDTH - 1])
                parts = -(-size // PIECE)
                nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                own = np.repeat(np.arange(len(size)), parts)
                start = at + first[own] + nth * PIECE
                yield pa.RecordBatch.from_pydict({
                    "k1": pa.array(np.full(len(own), k1.as_py())), "k2": pa.array(np.full(len(own), k2.as_py())),
                    "bucket": pa.array(bucket[own].view(np.int64)), "start": pa.array(start),
                    "size": pa.array(np.minimum(size[own] - nth * PIECE, PIECE)), "again": pa.array(again[own])})


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["k1", "k2", "bucket", "start", "size", "name", "piece"]
    for batch in batches:
        for k1, k2, text, runs in zip(*(batch.column(c) for c in ("k1", "k2", "text", "runs"))):
            view = memoryview(text.as_buffer())
            found = runs.values
            buckets, starts, sizes = (found.field(c).to_pylist() for c in ("bucket", "start", "size"))
            for at in range(0, len(starts), 4096):
                part = slice(at, at + 4096)
                pieces = [view[s:s + n + WIDTH - 1] for s, n in zip(starts[part], sizes[part])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k1.as_py()] * len(pieces)), pa.array([k2.as_py()] * len(pieces)),
                    pa.array(buckets[part]), pa.array(starts[part]), pa.array(sizes[part]),
                    pa.array([blake2b(p, digest_size=16).digest() for p in pieces], pa.binary()),
                    pa.array([bytes(p) for p in pieces], pa.binary())], names=names)


def pieces(docs: DataFrame) -> DataFrame:
    """The pieces of text whose suffixes may repeat: key of the text, bucket, place, suffixes, name and bytes."""
    texts = docs.select(*_key(), "text").filter(F.octet_length("text") >= WIDTH)
    runs = settle(texts.select("k1", "k2", F.col("text").cast("binary")).mapInArrow(
        _runs, "k1 long, k2 long, bucket long, start long, size long, again boolean"), "suffix-runs")
    place = F.xxhash64("k1", "k2", "start")
    shared = runs.groupBy("bucket").agg(
        F.min(place).alias("one"), F.max(place).alias("other"), F.bool_or("again").alias("again")
    ).filter("again or one <> other").select("bucket")
    wanted = runs.join(shared, "bucket").groupBy("k1", "k2").agg(
        F.collect_set(F.struct("bucket", "start", "size")).alias("runs"))
    one = texts.groupBy("k1", "k2").agg(F.first("text").cast("binary").alias("text"))
    return settle(one.join(wanted, ["k1", "k2"]).mapInArrow(
        _cut_pieces, "k1 long, k2 long, bucket long, start long, size long, name binary, piece binary"), "suffix-pieces")


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 0; equal keys share theirs."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), np.uint64)
    ranks[order] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ordered[1:] != ordered[:-1], dtype=np.uint64)])
    return ranks


def _paired(ranks: np.ndarray, step: int) -> np.ndarray:
    """Ranks by twice the bytes: a rank and the one ``step`` places on, where the end is least."""
    later = np.zeros(len(ranks), np.uint64)
    later[:max(0, len(ranks) - step)] = ranks[step:] + np.uint64(1)
    return _dense((ranks << np.uint64(32)) | later)


class Block:
    """A text whose suffixes are compared by their first bytes and by the ranks of the cover's suffixes."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(8 + -len(data) % PERIOD, np.uint8)])
        n = len(padded) - 8
        words = np.zeros(n, np.uint64)
        for k in range(8):
            words = (words << np.uint64(8)) | padded[k:k + n]
        self.ranks = _paired(_paired(_dense(words), 8), 16)
        self.cover = self.ranks.reshape(-1, PERIOD)[:, COVER].ravel()
        covered = SORTED_BYTES
        while covered < WIDTH:
            periods = covered // PERIOD
            self.cover = _paired(self.cover, periods * len(COVER))
            covered += periods * PERIOD

    def tied_ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For suffixes that tie in their first bytes: the cover's ranks that order them, equal only if ``WIDTH`` bytes are."""
        step = _STEP[a % PERIOD, b % PERIOD]
        rank = lambda p: self.cover[p // PERIOD * len(COVER) + _COLUMN[p % PERIOD]]
        return rank(a + step), rank(b + step)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``WIDTH`` bytes from ``a`` and from ``b``, which tie in their first bytes, are equal."""
        left = np.arange(len(a))
        for at in [*range(SORTED_BYTES, WIDTH - SORTED_BYTES, SORTED_BYTES), WIDTH - SORTED_BYTES]:
            left = left[self.ranks[a[left] + at] == self.ranks[b[left] + at]]
        out = np.zeros(len(a), bool)
        out[left] = True
        return out

    def sort(self, groups: np.ndarray) -> np.ndarray:
        """Each row's suffixes in order, by a bitonic network over the columns; -1 fills rows and comes last."""
        columns = np.arange(groups.shape[1])
        size = 2
        while size <= len(columns):
            step = size // 2
            while step:
                low = columns[(columns & step) == 0]
                rising = (low & size) == 0
                low, high = np.where(rising, low, low | step), np.where(rising, low | step, low)
                a, b = groups[:, low], groups[:, high]
                ahead, behind = self.tied_ranks(a, b)
                swap = (b >= 0) & ((a < 0) | (ahead > behind))
                groups[:, low], groups[:, high] = np.where(swap, b, a), np.where(swap, a, b)
                step //= 2
            size *= 2
        return groups

    def repeated(self, starts: np.ndarray) -> np.ndarray:
        """Per start whether its ``WIDTH`` bytes stand at another start too."""
        found = np.zeros(len(self.ranks), bool)
        keys = self.ranks[starts]
        order = np.argsort(keys)
        ordered = starts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
        sizes = np.diff(np.concatenate([first, [len(starts)]]))
        bits = np.ceil(np.log2(sizes)).astype(int)
        for k in np.unique(bits[sizes > 1]).tolist():
            of_size = np.flatnonzero((bits == k) & (sizes > 1))
            held = max(1, (1 << 18) >> k)
            for at in range(0, len(of_size), held):
                own = of_size[at:at + held]
                column = np.arange(1 << k)
                inside = column < sizes[own][:, None]
                groups = np.where(inside, ordered[np.minimum(first[own][:, None] + column, len(starts) - 1)], -1)
                groups = self.sort(groups)
                a, b = groups[:, :-1][inside[:, 1:]], groups[:, 1:][inside[:, 1:]]
                ahead, behind = self.tied_ranks(a, b)
                equal = ahead == behind
                unsure = np.flatnonzero(~equal)
                equal[unsure] = self.same(a[unsure], b[unsure])
                found[a[equal]] = found[b[equal]] = True
        return found[starts]


def _sort_block(rows: list[tuple]) -> pa.RecordBatch:
    """Per piece of a block the spans of its suffixes that repeat within the block."""
    texts = [r[3] for r in rows]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    sizes = np.array([len(t) - WIDTH + 1 for t in texts])
    owner = np.repeat(np.arange(len(rows)), sizes)
    starts = np.arange(len(owner)) + np.repeat(offsets[:-1] - (np.cumsum(sizes) - sizes), sizes)
    parts = np.array([r[5] for r in rows])
    if (parts > 1).any():
        part = np.array([r[4] for r in rows])
        mine = gram_hashes(data, WIDTH)[starts] % parts[owner].astype(np.uint64) == part[owner].astype(np.uint64)
        starts, owner = starts[mine], owner[mine]
    found = Block(data).repeated(starts)
    starts, owner = starts[found], owner[found]
    breaks = (np.diff(starts) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(starts)), bool), breaks]))
    last = np.concatenate([first[1:], [len(starts)]])[:len(first)] - 1
    whose = owner[first]
    shift = np.array([r[2] for r in rows], np.int64)[whose] - offsets[:-1][whose]
    spans = pa.StructArray.from_arrays(
        [pa.array(starts[first] + shift, pa.int64()), pa.array(starts[last] + shift, pa.int64())], ["first", "last"])
    bounds = np.searchsorted(whose, np.arange(len(rows) + 1))
    some = np.flatnonzero(np.diff(bounds))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans).take(pa.array(some))
    return pa.RecordBatch.from_arrays([
        pa.array([rows[i][0] for i in some], pa.int64()), pa.array([rows[i][1] for i in some], pa.binary()), lists],
        names=["bucket", "name", "spans"])


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, held_bytes, last = [], 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "name", "shift", "piece", "part", "parts")]
        for row in zip(*columns):
            bucket = (row[0], row[4])
            if held_bytes >= BLOCK and bucket != last:
                yield _sort_block(held)
                held, held_bytes = [], 0
            held.append(row)
            held_bytes += len(row[3])
            last = bucket
    if held:
        yield _sort_block(held)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A piece of a large bucket, to every part that has suffixes of it, cut to those."""
    schema = pa.schema([("bucket", pa.int64()), ("name", pa.binary()), ("shift", pa.int64()), ("piece", pa.binary()),
                        ("part", pa.int64()), ("parts", pa.int64())])
    for batch in batches:
        out = []
        for bucket, name, piece, parts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "name", "piece", "parts"))):
            part = (gram_hashes(np.frombuffer(piece, np.uint8), WIDTH) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0, [True]]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                first, last = int(order[a]), int(order[b - 1])
                out.append((bucket, name, first, piece[first:last + WIDTH], int(part[first]), parts))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def repeated_spans(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per bucket and name of a piece the spans of its suffixes that repeat: ``bucket``, ``name``, ``spans``."""
    one = settle(found.groupBy("bucket", "name").agg(
        F.first("piece").alias("piece"), F.count("*").alias("copies")), "suffix-distinct")
    weights = one.groupBy("bucket").agg(F.sum(F.octet_length("piece")).alias("weight"))
    large = weights.filter(F.col("weight") > block).select(
        F.col("bucket"), F.ceil(F.col("weight") / block).cast("long").alias("parts"))
    placed = one.join(settle(large, "suffix-large"), "bucket", "left")
    schema = "bucket long, name binary, shift long, piece binary, part long, parts long"
    small = placed.filter("parts is null").select(
        "bucket", "name", F.lit(0).cast("long").alias("shift"), "piece",
        F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"))
    dealt = small.union(placed.filter("parts is not null").select("bucket", "name", "piece", "parts").mapInArrow(_deal, schema))
    total = one.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    tasks = max(1, int(one.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * block)))
    sorted_blocks = dealt.repartition(tasks, "bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(
        _sort_blocks, f"bucket long, name binary, spans {Spans}")
    whole = one.filter("copies > 1").select("bucket", "name", F.array(F.struct(
        F.lit(0).cast("long").alias("first"), (F.octet_length("piece") - WIDTH).cast("long").alias("last"))).alias("spans"))
    return sorted_blocks.union(whole)


def cuts(docs: DataFrame) -> DataFrame:
    """Per key of a text the spans of its suffixes that repeat: ``k1``, ``k2``, ``spans``."""
    found = pieces(docs)
    spans = settle(repeated_spans(found), "suffix-spans")
    own = found.select("k1", "k2", "bucket", "name", "start").join(spans, ["bucket", "name"])
    moved = F.transform("spans", lambda s: F.struct(
        (F.col("start") + s["first"]).alias("first"), (F.col("start") + s["last"]).alias("last")))
    copies = docs.select(*_key(), F.octet_length("text").alias("n")).filter(F.col("n") >= WIDTH).groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.first("n").alias("n")).filter("copies > 1")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("n") - WIDTH).cast("long").alias("last")))
    return own.select("k1", "k2", moved.alias("spans")).union(copies.select("k1", "k2", whole)).groupBy("k1", "k2").agg(
        F.flatten(F.collect_list("spans")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The bytes that the suffixes of the spans cover, as disjoint runs that do not touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + WIDTH))
        else:
            out.append((first, last + WIDTH))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):  # a slice's texts are held twice
            part = batch.slice(at, 64)
            kept, sizes, removed, runs = [], [], [], []
            for text, spans in zip(part.column("_text"), part.column("_spans")):
                data = text.as_py() or b""
                gone = merged([(s["first"], s["last"]) for s in spans.as_py() or ()])
                edges = [0, *(x for run in gone for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                runs.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (sizes, removed, runs))],
                names=["_row", "kept", "n_bytes", "n_removed", "n_spans"])


ADDED = ("kept", "n_bytes", "n_removed", "n_spans")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with the bytes ``kept`` of it, ``n_bytes``, ``n_removed`` and ``n_spans`` (runs removed).

    Only ``text`` is used; the other columns, whatever their names, pass through (those named as an added one go).
    """
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("text", *ADDED)])
    found = cuts(docs.select("text")).toDF("_k1", "_k2", "_spans")
    k1, k2 = _key()
    rows = docs.select(row.alias("_row"), F.col("text").cast("binary").alias("_text"), k1.alias("_k1"), k2.alias("_k2"))
    joined = rows.join(found, ["_k1", "_k2"], "left").select("_row", "_text", "_spans")
    kept = joined.mapInArrow(_remove, widened(
        joined.select("_row"), kept="binary", n_bytes="bigint", n_removed="bigint", n_spans="bigint"))
    return kept.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in ("text", *ADDED)], *ADDED)
