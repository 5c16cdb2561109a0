import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import suffixes


def by_hand(texts):
    """Per text its bytes, bytes removed, runs removed and what is kept, from counts of all 400-byte strings."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(t[i:i + 400] for t in data for i in range(len(t) - 399))
    out = []
    for text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - 399):
            if counts[text[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(text), sum(gone), runs, bytes(t for t, g in zip(text, gone) if not g)))
    return out


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    write = lambda n: "".join(draw.choice("abcdé \n漢") for _ in range(n))
    passage, long, core = write(700), write(3000), write(380)
    shared = [write(draw.randint(0, 90)) + core + write(draw.randint(0, 90)) for _ in range(30)]
    return [
        long, long, long, long[:1500] + "X" + long[1501:], write(500) + passage + write(300), passage + write(10),
        write(20) + passage[:396] + "!", "a" * 3000, "a" * 399, "ab" * 200 + "c", "ab" * 400, write(390), None, "", " ",
        write(50) + "a" * 401, "xyz" * 800, long[100:499], long[100:500], *shared, *[passage[:350] + s for s in shared],
    ]


@pytest.mark.parametrize("block", [suffixes.BLOCK, 3000])
def test_removed_bytes_by_hand(spark, documents, texts, block, monkeypatch):
    monkeypatch.setattr(suffixes.repeated_spans, "__defaults__", (block,))
    docs = documents([(i, t) for i, t in enumerate(texts)])
    found = suffixes.remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == by_hand(texts)


def test_block_against_counts():
    draw = np.random.default_rng(2)
    base = draw.integers(97, 99, 6000).astype(np.uint8)
    data = np.concatenate([base, base[50:2500], np.zeros(900, np.uint8), base[3000:3399], [113], base[3000:3402], base])
    starts = np.arange(0, len(data) - 399, 3)
    whole = data.astype(np.uint8).tobytes()
    counts = Counter(whole[i:i + 400] for i in starts.tolist())
    expected = [counts[whole[i:i + 400]] > 1 for i in starts.tolist()]
    assert suffixes.Block(data.astype(np.uint8)).repeated(starts).tolist() == expected


def test_cover_orders_like_the_text():
    """Sorted by 32 bytes and the cover's ranks, suffixes are in the order of their bytes."""
    data = np.frombuffer(b"abab" * 300 + b"abac" * 40 + b"abab" * 200 + b"b", np.uint8)
    block = suffixes.Block(data)
    starts = np.arange(256)
    assert len(set(block.ranks[starts[::2]].tolist())) == 1
    ordered = block.sort(starts[::2].copy().reshape(1, -1))[0].tolist()
    texts = [data.tobytes()[p:p + 400] for p in ordered]
    assert texts == sorted(texts)
    differences = {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}
    assert differences == set(range(suffixes.PERIOD))


def test_slices_and_pieces(spark, documents, monkeypatch):
    draw = random.Random(9)
    text = "".join(draw.choice("ab ") for _ in range(9000))
    monkeypatch.setattr(suffixes, "SLICE", 1000)
    monkeypatch.setattr(suffixes, "PIECE", 64)
    texts = [text, text[:4000], "-" + text[200:5000] + text[100:1100]]
    found = suffixes.remove_repeats(documents(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == by_hand(texts)


def test_odd_rows_clashing_names_and_empty_table(spark, odd):
    rows = [(i, t, f"{i}", 1.5) for i, t in [*odd, (5, "y" * 1_200_000), (None, None)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_sha256 string, n_spans double").withColumn(
        "_row", F.lit(1)).withColumn("bucket", F.lit("b"))
    found = suffixes.remove_repeats(docs)
    assert set(found.columns) == {"doc_id", "kept_sha256", "_row", "bucket", "kept", "n_bytes", "n_removed", "n_spans"}
    out = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in found.collect())
    assert (5, 1_200_000, 1_200_000, 1) in out and (7, 5000, 5000, 1) in out and len(out) == len(rows)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0
