"""Document fingerprints from spots: chains of content words that follow common words.

Every occurrence of a common word (an anchor) makes a signature of the anchor and the next
``CHAIN`` content words of the text, that is words that are no anchors. A fingerprint is the
set of a text's signatures; text without any is known by all its words, or by its bytes if
it has none. An empty (or null) text has an empty set, alike only to another empty one.

``near_pairs`` is the join over a collection: sets are partitioned by their length, so that
a set only meets its own partition and the next one, and within them only sets that share
one of their first signatures, rarest first; pairs are verified by their Jaccard likeness.
``with_next`` compares every text with its successor and with an edited form of itself.
Rows may repeat: each is a row of its own, and equal texts have equal fingerprints. An empty table gives an
empty table. Columns other than ``doc_id`` and ``text`` are not read. Texts of any length are whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import CHUNK_BYTES, chunks, settle
from tarmac.llm.words import PLAIN, flat_words, hashed, mixed

# Common words of English, French, German and Spanish.
ANCHORS = (
    "the a an of to and in is it that for on was with as by this are be or at from "
    "le la les de des du un une et est que qui dans pour par sur au en "
    "der die das und ein eine den dem zu von mit ist auf im nicht sich "
    "el los las y una del se no lo con su es al"
).split()
CHAIN = 2
_STEPS = [np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _anchor_hashes() -> np.ndarray:
    data, starts, ends, _ = flat_words([" ".join(ANCHORS).encode()], PLAIN)
    return np.unique(hashed(data, starts, ends))


def signatures(texts: list[bytes]) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its spots."""
    data, starts, ends, text = flat_words(texts, PLAIN)
    words = hashed(data, starts, ends)
    common = np.isin(words, _anchor_hashes())
    anchors, content = np.flatnonzero(common), np.flatnonzero(~common)
    first = np.searchsorted(content, anchors)
    whole = first + CHAIN <= len(content)
    anchors, first = anchors[whole], first[whole]
    same = text[anchors] == text[content[first + CHAIN - 1]] if len(anchors) else np.zeros(0, bool)
    anchors, first = anchors[same], first[same]
    value = words[anchors] * _STEPS[0]
    for k in range(CHAIN):
        value = mixed(value) + words[content[first + k]] * _STEPS[k + 1]
    value, owner = mixed(value), text[anchors]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
        value, owner = value[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    return [value[a:b] if b > a else _without_spots(t) for a, b, t in zip(bounds, bounds[1:], texts)]


def _without_spots(text: bytes) -> np.ndarray:
    known = b" ".join(text.translate(PLAIN).split()) or text
    return np.frombuffer(hashlib.blake2b(known, digest_size=8).digest(), np.uint64) if known else np.zeros(0, np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 without a look if their lengths alone keep it below ``least``."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) <= least * max(len(a), len(b)) - 1e-9 or not len(a) or not len(b):
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def name(values: np.ndarray) -> str:
    """A fingerprint as text: its length and a digest of its signatures."""
    return f"{len(values)}:{hashlib.blake2b(values.tobytes(), digest_size=16).hexdigest()}"


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` and ``spots``, the signatures, of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, text):
            sets = signatures(texts)
            offsets = pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32())
            flat = pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(map(name, sets), pa.string()), pa.ListArray.from_arrays(offsets, flat)],
                names=[key, "fingerprint", "spots"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fingerprint string, spots array<long>")


def near_pairs(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs of different fingerprints with a likeness of ``least`` or more: ``a``, ``b`` (a < b), ``likeness``.

    Equal fingerprints are one class, and pairs are between classes. Length partition k holds
    lengths from (1/least)^k on; a length's partners lie in its own or a neighbouring partition. Signatures
    are ordered by their number of classes, then by hash; of n the first n - ceil(least n) + 1 are looked up.
    """
    part = F.floor(F.log(F.size("spots").cast("double")) / F.lit(math.log(1 / least)) + 1e-9)
    sets = settle(
        prints.filter(F.size("spots") > 0).groupBy("fingerprint").agg(F.min("spots").alias("spots"))
        .withColumn("part", part), "spot-classes")
    spots = sets.select("fingerprint", F.size("spots").alias("n"), "part", F.explode("spots").alias("spot"))
    often = spots.groupBy("spot").agg(F.count("*").alias("classes")).filter("classes > 1")
    wanted = F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9)) + 1
    ranked = spots.join(often, "spot", "left").groupBy("fingerprint", "n", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("classes", F.lit(1)).alias("classes"), "spot"))).alias("spots"))
    prefix = settle(
        ranked.select("fingerprint", "n", "part", F.explode(F.slice("spots", F.lit(1), wanted.cast("int"))).alias("s"))
        .filter("s.classes > 1").select("fingerprint", "n", "part", F.col("s.spot").alias("spot")), "spot-prefixes")
    left = prefix.select("spot", F.col("fingerprint").alias("a"), F.col("n").alias("n_a"),
                         F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    right = prefix.select("spot", F.col("fingerprint").alias("b"), F.col("n").alias("n_b"), "part")
    pairs = left.join(right, ["spot", "part"]).filter(
        (F.col("a") < F.col("b")) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(least) - F.lit(1e-9))
    ).select("a", "b").distinct()
    ours = sets.select(F.col("fingerprint").alias("a"), F.col("spots").alias("spots_a"))
    theirs = sets.select(F.col("fingerprint").alias("b"), F.col("spots").alias("spots_b"))
    shared = F.size(F.array_intersect("spots_a", "spots_b"))
    return (
        pairs.join(ours, "a").join(theirs, "b")
        .select("a", "b", (shared / (F.size("spots_a") + F.size("spots_b") - shared)).alias("likeness"))
        .filter(F.col("likeness") >= F.lit(least) - F.lit(1e-12))
    )


def _buckets(docs: DataFrame, n: int) -> tuple[Column, list[int]]:
    """A column with a row's place in the order of descending ``doc_id``, cut into about ``n`` even buckets.

    Rows without ``doc_id`` come after all others, spread by their text.
    """
    shares = [i / n for i in range(1, n)]
    found = docs.filter(F.col("doc_id").isNotNull()).approxQuantile("doc_id", shares, 0.25 / n) if n > 1 else []
    bounds = np.array(sorted({math.floor(x) for x in found}), np.int64)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series, missing: pd.Series, order: pd.Series) -> pd.Series:
        known = len(bounds) - np.searchsorted(bounds, ids.to_numpy(), side="right")
        return pd.Series(np.where(missing, len(bounds) + 1 + order.to_numpy() % n, known).astype(np.int32))

    return bucket(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), F.col("doc_id").isNull(), F.col("order"))


def with_next(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and their likeness, and that of the next text.

    The next document is that of the next lower ``doc_id`` (after the last: the first; of equal ids, by a hash
    of the text). The edited text has the last third of its code points replaced by the first as many
    of the next text. One shuffle deals the texts out by even ranges of ``doc_id``; each range also
    gets the first document of the next one, so a task reads its rows in order, once.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text").withColumn("order", F.xxhash64("text"))
    rows = rows.withColumn("bucket", _buckets(docs.select("doc_id"), n))
    place = F.struct(F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "order")
    heads = rows.drop("text").groupBy("bucket").agg(F.max(place).alias("head")).orderBy("bucket").collect()  # <= 2 n rows
    before = [h["bucket"] for h in heads[-1:] + heads[:-1]]
    first = spark.createDataFrame(
        [(h["bucket"], h["head"]["doc_id"], h["head"]["order"], b) for h, b in zip(heads, before)],
        "_bucket int, _id long, _order long, reader int")
    guests = rows.join(F.broadcast(first), (F.col("bucket") == F.col("_bucket")) & (F.col("order") == F.col("_order"))
                       & (F.coalesce("doc_id", F.lit(0).cast("long")) == F.col("_id")))
    guests = guests.groupBy("reader").agg(F.first(F.struct("doc_id", "text", "order")).alias("row")).select(
        "row.doc_id", "row.text", "row.order", F.col("reader").alias("bucket"), F.lit(True).alias("guest"))
    dealt = (
        rows.withColumn("guest", F.lit(False)).unionByName(guests)
        .repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc("doc_id"), F.desc("order"))
    )
    return dealt.mapInArrow(_compare, ", ".join(f"{f.name} {t}" for f, t in zip(_COMPARED, (
        "long", "long", "string", "string", "string", "double", "double"))))


_COMPARED = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each is compared with its follower, and a guest only ends its bucket."""
    held: list[tuple[int | None, bool, str]] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c) for c in ("doc_id", "guest", "text")]
        for i in range(batch.num_rows):
            doc_id, guest, text = (c[i].as_py() for c in columns)
            held.append((doc_id, guest, text or ""))
            size += len(held[-1][2])
            if size > CHUNK_BYTES // 2 and len(held) > 1:
                yield _compared(held)
                held, size = held[-1:], len(held[-1][2])
    if len(held) > 1:
        yield _compared(held)


def _compared(rows: list[tuple[int | None, bool, str]]) -> pa.RecordBatch:
    whole = signatures([text.encode() for _, _, text in rows])
    own = [i for i in range(len(rows) - 1) if not rows[i][1]]
    edited = []
    for i in own:
        text, cut = rows[i][2], len(rows[i][2]) // 3
        edited.append((text[:len(text) - cut] + rows[i + 1][2][:cut]).encode())
    changed = signatures(edited)
    columns = [
        [rows[i][0] for i in own],
        [len(rows[i][2]) for i in own],
        [hashlib.sha256(e).hexdigest() for e in edited],
        [name(whole[i]) for i in own],
        [name(c) for c in changed],
        [likeness(whole[i], c) for i, c in zip(own, changed)],
        [likeness(whole[i], whole[i + 1]) for i in own],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COMPARED)], schema=_COMPARED)
