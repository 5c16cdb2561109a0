"""Toxicity by compression distance: which dictionary makes a text's windows shorter.

Two dictionaries are trained by zstandard: one on ordinary texts, and one on toxic text, that is on
the stretches of toxic texts that are far more usual there than in ordinary ones (trained on whole toxic
texts, which are mostly ordinary, it told the classes apart at an area under the curve of 0.72 instead of 0.99).
A window is compressed with the first alone and with both. Windows that toxic text helps to compress
get shorter with the second; the gains of a text's windows are summed up in a few figures, and a
logistic curve, calibrated on labelled rows that no dictionary has seen, turns them
into a score whose threshold is 0.3.

The fit uses a bounded sample of labelled rows: up to half of ``MAX_FIT_ROWS`` of either class, the first in the order
of a hash, without the texts that do not fit into ``MAX_FIT_BYTES``; every whole text is scored. The calibration
gives the classes the weight they have among all labels, so rare toxic labels are all used and shift nothing.
Null counts as empty. With labels of one kind only there is nothing to tell apart, and every score is 0. Equal texts
score alike; an empty table gives an empty table; other columns pass through (but for one named ``score``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import chunks, settle, widened

MAX_FIT_ROWS = 8_000
MAX_FIT_BYTES = 48 << 20
WINDOW, STEP = 48, 36
GRAM = 6
MAX_GRAMS = 1_000
TOXIC_DICTIONARY = 4 << 10
BASE_DICTIONARY = 16 << 10
LEVEL = 3
THRESHOLD = 0.3


def lowered(texts: list[bytes]) -> list[bytes]:
    return [t.lower() for t in texts]


def windows(text: bytes) -> list[bytes]:
    return [text[i:i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STEP), STEP)]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)


def gram_codes(text: bytes) -> np.ndarray:
    """Every run of ``GRAM`` bytes as a number, in order."""
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    codes = np.zeros(max(0, len(data) - GRAM + 1), np.int64)
    for k in range(GRAM):
        codes = codes * 256 + data[k:k + len(codes)]
    return codes


def documents_with(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of bytes and the number of texts that hold them, combined every few megabytes."""
    codes, counts, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    for i, text in enumerate(texts):
        held.append(np.unique(gram_codes(text)))
        size += len(held[-1])
        if size > 2_000_000 or i + 1 == len(texts):
            new, n = np.unique(np.concatenate(held), return_counts=True)
            both, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
            codes, held, size = both, [], 0
    return codes, counts


def telling_grams(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Runs of bytes far more usual in toxic than in ordinary texts, the most telling first kept."""
    codes, seen = documents_with(toxic)
    other_codes, other = documents_with(ordinary)
    at = np.minimum(np.searchsorted(other_codes, codes), max(0, len(other_codes) - 1))
    there = np.where(other_codes[at] == codes, other[at], 0) if len(other_codes) else np.zeros(len(codes))
    rate, base = seen / len(toxic), (there + 0.5) / (len(ordinary) + 1)
    least = max(2, min(8, len(toxic) // 40))
    good = (seen >= least) & (rate > 10 * base)
    weight = rate * np.log(np.maximum(rate / base, 1e-9))
    order = np.lexsort((codes, -weight))
    return np.sort(codes[order[good[order]][:MAX_GRAMS]])


def stretches(toxic: list[bytes], grams: np.ndarray) -> list[bytes]:
    """The stretches of toxic text made of telling runs."""
    out = []
    for text in toxic:
        hit = np.isin(gram_codes(text), grams)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        out += [text[a:b + GRAM - 1] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on the samples; of too little text to train on, its most usual samples, those last."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        counts = Counter(samples)
        return b"".join(sorted((s for s, n in counts.items() if n > 1 or len(s) > WINDOW), key=lambda s: (counts[s], s)))[-size:]


def gains(text: bytes, plain, toxic) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each window."""
    cut = windows(text)
    return np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in cut], float)


def figures(saved: np.ndarray) -> list[float]:
    top = np.sort(saved)[-3:]
    return [1.0, top[-1], top.mean(), saved.mean(), np.log1p(np.maximum(saved - 1, 0).sum()),
            np.sqrt((saved >= 2).mean())]


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    ridge[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


class Model:
    """Two dictionaries and a calibrated curve; some tens of kilobytes whatever the data.

    ``ordinary_weight`` is how many ordinary texts one of the sample stands for, if a toxic one stands for one.
    """

    def __init__(self, texts: list[bytes], toxic: list[bool], ordinary_weight: float = 1.0):
        rows = lowered(texts)
        learn = [i for i in range(len(rows)) if i % 2 == 0]
        bad = [rows[i] for i in learn if toxic[i]]
        good = [rows[i] for i in learn if not toxic[i]]
        rest = [i for i in range(len(rows)) if i % 2]
        y = np.array([toxic[i] for i in rest], float)
        self.weights = None
        if not bad or not good or not 0 < y.sum() < len(y):
            return
        samples = [t[i:i + 2 * WINDOW] for t in good for i in range(0, len(t), 8 * WINDOW)]
        self.plain = trained(samples, BASE_DICTIONARY)
        self.toxic = self.plain + trained(stretches(bad, telling_grams(bad, good)), TOXIC_DICTIONARY)
        x = np.array([figures(g) for g in self.gains([rows[i] for i in rest])])
        self.scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
        self.weights = logistic(x / self.scale, y)
        self.shift = self.calibrated(x / self.scale @ self.weights, y, ordinary_weight)

    @staticmethod
    def calibrated(raw: np.ndarray, y: np.ndarray, ordinary_weight: float = 1.0) -> float:
        """The shift that puts the cut with the best F1 on the calibration rows, weighted, at the threshold."""
        order = np.argsort(-raw, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (hits + ordinary_weight * np.cumsum(1 - y[order]) + y.sum())
        last = np.append(raw[order][1:] < raw[order][:-1], True)
        best = int(np.argmax(np.where(last, f1, -1)))
        after = raw[order][best + 1] if best + 1 < len(y) else raw[order][best] - 1
        return float(np.log(THRESHOLD / (1 - THRESHOLD)) - (raw[order][best] + after) / 2)

    def gains(self, rows: list[bytes]) -> list[np.ndarray]:
        plain, toxic = compressor(self.plain), compressor(self.toxic)
        return [gains(r, plain, toxic) for r in rows]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        x = np.array([figures(g) for g in self.gains(lowered(texts))])
        raw = x / self.scale @ self.weights + self.shift
        return np.round(1 / (1 + np.exp(-np.clip(raw, -30, 30))), 9)


def held_out(doc_id) -> F.Column:
    """Rows whose labels no model may see."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of at most ``MAX_FIT_ROWS`` labelled rows that are not held out, half of either class, chosen by a hash.

    ``labels`` has ``doc_id`` and ``toxic`` (0, 1); a document with two unlike labels counts as toxic.
    """
    marked = settle(
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic")), "marks")
    order = [F.xxhash64("doc_id"), "doc_id"]
    halves = [marked.filter(kind).orderBy(*order).limit(MAX_FIT_ROWS // 2) for kind in (F.col("toxic"), ~F.col("toxic"))]
    chosen = settle(halves[0].union(halves[1]), "fit")
    numbers = [{r["toxic"]: r["count"] for r in df.groupBy("toxic").count().collect()} for df in (marked, chosen)]
    stands_for = [numbers[0].get(kind, 0) / max(1, numbers[1].get(kind, 0)) for kind in (False, True)]
    rows = (
        docs.select("doc_id", "text").filter((F.length("text") > 0) & (F.octet_length("text") <= MAX_FIT_BYTES))
        .join(chosen, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    )
    texts, toxic, size = [], [], 0
    for row in rows.toLocalIterator():
        data = row["text"].encode()
        if size + len(data) > MAX_FIT_BYTES:
            continue  # passed over, so one long text does not end the sample
        size += len(data)
        texts.append(data)
        toxic.append(row["toxic"])
    return Model(texts, toxic, stands_for[0] / max(stands_for[1], 1.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1, higher where toxic text compresses better."""
    kept = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            scores = pa.array(model.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])

    return kept.mapInArrow(run, widened(kept, score="double"))
