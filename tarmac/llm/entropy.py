"""Cross-entropy difference between a target and a background n-gram model.

Both models are interpolated n-gram models of order 1 to ``ORDER`` over one vocabulary,
the bytes of the lower-cased text, with the same weights: they differ in what was counted
only. The target counts the documents labelled good and not held out, the background
counts every document. A document's score is its mean loss per byte under the target less
that under the background: the lower, the more it reads like the target.

Counting covers all whole texts. An n-gram is a row whose key is the n-gram itself, its
bytes as a number; no two share a count, and their rows grow with the corpus. Tasks add up what
they meet, a shuffle sums the rows into a written table. A place's n-gram of the highest order
holds those of all lower orders, so their counts are sums of that table, and a place's loss is a
function of that n-gram: the losses are a second table, with a row per distinct n-gram.

Scoring joins by shuffle. Texts are packed in blocks of ``BLOCK_BYTES``; a block asks once for
each n-gram it holds (so even the most usual one has a row per block, not per place), the answers
meet the block again, and its texts are scored there. No table is collected or broadcast.
Null and empty texts have no tokens, losses 0. Without any target text both losses come
from the background, and the difference is 0.

Rows may repeat: they count again and are scored alike. An empty table gives an empty table. A text beyond a block is a
block of its own. Tokens are bytes, not words, so that spelling and foreign scripts need no cut of the vocabulary; the
weights of the orders are fixed, as both models use the same and only their difference counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import chunks, settle, widened

ORDER = 5
WEIGHTS = (0.02, 0.08, 0.15, 0.25, 0.25, 0.25)  # of the uniform share and of orders 1 to ORDER
PART_BYTES = 1 << 18
BLOCK_BYTES = 16 << 20
HELD_GRAMS = 1 << 20
FIRST = 1 << 8 * ORDER  # marks the n-gram of a text's first byte, which has nothing before it
BLANKS = int.from_bytes(b" " * ORDER, "big")


def grams(symbols: np.ndarray) -> np.ndarray:
    """The n-gram of the highest order that ends at every symbol, its bytes as a number; a text's start is led by blanks."""
    led = np.concatenate([np.full(ORDER - 1, 32, np.uint8), symbols]).astype(np.int64)
    code = np.zeros(len(symbols), np.int64)
    for k in range(ORDER):
        code = code << 8 | led[k:k + len(symbols)]
    return code


def cells(symbols: np.ndarray) -> list[np.ndarray]:
    """For each order, the n-gram that ends at every symbol."""
    code = grams(symbols)
    return [code & (1 << 8 * (k + 1)) - 1 for k in range(ORDER)]


def parts(text: bytes) -> Iterator[np.ndarray]:
    """A text in pieces, each led by the ``ORDER`` bytes before it."""
    data = np.frombuffer(text.lower(), np.uint8)
    for at in range(0, len(data), PART_BYTES):
        yield data[max(0, at - ORDER):at + PART_BYTES]


def places(text: bytes) -> Iterator[np.ndarray]:
    """The n-grams of all places of a text in pieces; that of the first is marked."""
    for k, piece in enumerate(parts(text)):
        code = grams(piece)
        if k == 0:
            code[:1] |= FIRST
        yield code if k == 0 else code[ORDER:]


def distinct(codes: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes with their numbers, added up until ``HELD_GRAMS`` are held; a code may come again after that."""
    known, counts, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(held), return_counts=True)
        both, at = np.unique(np.concatenate([known, new]), return_inverse=True)
        return both, np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)

    for code in codes:
        held.append(code)
        size += len(code)
        if size > 1 << 20:
            known, counts = added()
            held, size = [], 0
            if len(known) > HELD_GRAMS:
                yield known, counts
                known, counts = known[:0], counts[:0]
    if held:
        known, counts = added()
    if len(known):
        yield known, counts


class Counts:
    """A written table of n-grams with their counts in all documents (``n``) and in the target (``good``); one of the two."""

    def __init__(self, rows: DataFrame, column: str):
        self.rows, self.column = rows, column

    def any(self) -> bool:
        return not self.rows.filter(F.col(self.column) > 0).isEmpty()


def counts(docs: DataFrame, labels: DataFrame, held_out) -> tuple[Counts, Counts]:
    """Counts of all n-grams in the documents, and of those in the target."""
    good = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("good_id")).distinct()
    )
    # The labels grow with the documents: a shuffled join at every size, not a broadcast while they are few.
    marked = docs.select("doc_id", "text").join(
        good.hint("merge"), F.col("doc_id") == F.col("good_id"), "left").select(
        "text", F.col("good_id").isNotNull().alias("good"))
    kind = pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("good", pa.int64())])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch, texts in chunks(batches):
            for text, is_good in zip(texts, batch.column("good").to_pylist()):
                for code in places(text):
                    yield (code & FIRST - 1) << 1 | is_good

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, n in distinct(met(batches)):
            for at in range(0, len(codes), 1 << 16):
                code, some = codes[at:at + (1 << 16)], n[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code >> 1), pa.array(some), pa.array(some * (code & 1))], schema=kind)

    rows = marked.mapInArrow(run, "gram long, n long, good long")
    sums = settle(rows.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "grams")
    return Counts(sums, "n"), Counts(sums, "good")


def _low(gram: Column, order: int) -> Column:
    """The last ``order`` bytes of an n-gram."""
    return gram.bitwiseAND(F.lit((1 << 8 * order) - 1).cast("long"))


def losses(background: Counts, target: Counts, asked: DataFrame) -> DataFrame:
    """``gram`` with its loss under both models (``theirs``, ``ours``), marked first places too; a written table.

    N-grams that are only in ``asked`` have the count 0. The share of an n-gram of any order is that of its last
    bytes, one order lower, and its own: its count by that of the bytes before its last one.
    """
    names, none = ("theirs", "ours"), F.lit(0).cast("long")
    rows = (
        background.rows.select("gram", F.col(background.column).alias("theirs"), none.alias("ours"))
        .union(target.rows.select("gram", none, F.col(target.column)))
        .union(asked.select(_low(F.col("gram"), ORDER), none, none))
    )
    summed = [F.sum(name).alias(name) for name in names]
    orders = {ORDER: settle(rows.groupBy("gram").agg(*summed), "grams")}
    for order in range(ORDER - 1, 0, -1):
        orders[order] = settle(orders[order + 1].groupBy(_low(F.col("gram"), order).alias("gram")).agg(*summed), "grams")
    totals = orders[1].agg(*summed).first()
    total = {name: float(max(1, totals[name] or 0)) for name in names}
    own = lambda order, name, before: F.lit(WEIGHTS[order]) * F.least(F.col(name) / before, F.lit(1.0))
    uniform = F.lit(WEIGHTS[0] / 256)
    shares = orders[1].select("gram", *names, *[
        (uniform + own(1, name, F.lit(total[name]))).alias(f"{kind}_{name}") for kind in ("p", "first") for name in names])
    for order in range(2, ORDER + 1):
        shares = settle(shares, "shares")
        ends = shares.select(F.col("gram").alias("_end"), *[
            F.col(f"{kind}_{name}").alias(f"_{kind}_{name}") for kind in ("p", "first") for name in names])
        starts = shares.select(F.col("gram").alias("_start"), *[F.col(name).alias(f"_{name}") for name in names])
        shares = (
            orders[order].join(ends.hint("merge"), _low(F.col("gram"), order - 1) == F.col("_end"))
            .join(starts.hint("merge"), F.shiftright("gram", 8) == F.col("_start"), "left")
            .select("gram", *names, *[
                (F.col(f"_p_{name}") + own(order, name, F.greatest(F.coalesce(f"_{name}", none), F.lit(1)))).alias(f"p_{name}")
                for name in names
            ], *[(F.col(f"_first_{name}") + own(order, name, F.lit(total[name]))).alias(f"first_{name}") for name in names])
        )
    shares = settle(shares, "shares")
    ours = "ours" if totals["ours"] else "theirs"
    loss = lambda kind, name: (-F.log2(f"{kind}_{name}")).cast("float")
    usual = shares.select("gram", loss("p", "theirs").alias("theirs"), loss("p", ours).alias("ours"))
    first = shares.filter(F.shiftright("gram", 8) == (BLANKS >> 8)).select(
        F.col("gram").bitwiseOR(F.lit(FIRST)), loss("first", "theirs"), loss("first", ours))
    return settle(usual.union(first), "losses")


def packed(docs: DataFrame) -> DataFrame:
    """``block``, its ``rows`` as compressed Arrow data, and the distinct ``grams`` of their texts; a written table."""
    kind = pa.schema([("rows", pa.binary()), ("grams", pa.list_(pa.int64()))])

    def block(held: list[tuple[pa.RecordBatch, list[bytes]]]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0][0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for rows, _ in held:
                out.write_batch(rows)
        met = [codes for codes, _ in distinct(code for _, texts in held for text in texts for code in places(text))]
        codes = np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([sink.getvalue().to_pybytes()], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(codes))], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, texts in chunks(batches):
            held.append((rows, texts))
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield block(held)
                held, size = [], 0
        if held:
            yield block(held)

    rows = docs.mapInArrow(run, "rows binary, grams array<bigint>")
    return settle(rows.withColumn("block", F.monotonically_increasing_id()), "blocks")


def score(docs: DataFrame, background: Counts, target: Counts) -> DataFrame:
    """``docs`` with ``n_tokens``, ``target_loss``, ``background_loss`` (bits a byte) and their ``difference``."""
    added = ("n_tokens", "target_loss", "background_loss", "difference")
    kept = docs.drop(*added)
    names = [*kept.columns, *added]
    blocks = packed(kept)
    asked = blocks.select(F.col("block").alias("asker"), F.explode("grams").alias("gram"))
    answers = asked.join(losses(background, target, asked).hint("merge"), "gram")

    def scored(rows: pa.RecordBatch, texts: list[bytes], grams: np.ndarray, both: np.ndarray) -> pa.RecordBatch:
        sums = np.zeros((3, len(texts)))
        for row, text in enumerate(texts):
            for code in places(text):
                ours, theirs = both[:, np.searchsorted(grams, code)].sum(axis=1)
                sums[:, row] += len(code), ours, theirs
        n = np.maximum(sums[0], 1)
        ours, theirs = sums[1] / n, sums[2] / n
        columns = [pa.array(sums[0].astype(np.int64)), *map(pa.array, (ours, theirs, ours - theirs))]
        return pa.RecordBatch.from_arrays([*rows.columns, *columns], names=names)

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        grams = found.column("gram").to_numpy()
        order = np.argsort(grams)
        grams = grams[order]
        both = np.stack([found.column(c).to_numpy().astype(np.float64)[order] for c in ("ours", "theirs")])
        out = []
        for data in block.column("rows"):
            with pa.ipc.open_stream(data.as_buffer()) as held:
                out += [scored(rows, texts, grams, both) for rows, texts in chunks(held)]
        return pa.Table.from_batches(out)

    return (
        blocks.select("block", "rows").groupBy("block")
        .cogroup(answers.select("asker", "gram", "ours", "theirs").groupBy("asker"))
        .applyInArrow(run, widened(kept, **{name: "double" if i else "long" for i, name in enumerate(added)}))
    )
