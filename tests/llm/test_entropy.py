import math

import numpy as np
import pytest

from tarmac.llm import entropy, toxicity

LABELS = "doc_id long, quality int, toxic int"


def losses(texts, good, text):
    """Interpolated losses by dictionaries of n-grams, with blanks before a text."""
    from collections import Counter

    def count(some):
        tables = [Counter() for _ in range(entropy.ORDER)]
        for t in some:
            data = [32] * entropy.ORDER + list(t.encode().lower())
            for i in range(entropy.ORDER, len(data)):
                for k in range(entropy.ORDER):
                    tables[k][tuple(data[i - k:i + 1])] += 1
        return tables

    out = []
    for tables in (count(t for t, g in zip(texts, good) if g), count(texts)):
        total, loss = sum(tables[0].values()), 0.0
        data = [32] * entropy.ORDER + list(text.encode().lower())
        for i in range(entropy.ORDER, len(data)):
            p = entropy.WEIGHTS[0] / 256
            for k in range(entropy.ORDER):
                before = total if k == 0 or i == entropy.ORDER else tables[k - 1][tuple(data[i - k:i])]
                p += entropy.WEIGHTS[k + 1] * min(1, tables[k][tuple(data[i - k:i + 1])] / max(1, before))
            loss -= math.log2(p)
        out.append(loss / len(data[entropy.ORDER:]))
    return out


def test_losses_match_brute_force(spark, documents, prose):
    texts = [prose(i, 25) for i in range(8)] + ["###$$$ %%% &&& " * 6] * 2
    docs = documents(list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i < 6), 0) for i in range(10)], LABELS)
    background, target = entropy.counts(docs, labels, toxicity.held_out)
    import zlib
    good = [i < 6 and zlib.crc32(str(i).encode()) % 4 != 2 for i in range(10)]
    for r in entropy.score(docs, background, target).collect():
        assert r.n_tokens == len(r.text)
        ours, theirs = losses(texts, good, r.text)
        assert r.target_loss == pytest.approx(ours, rel=2e-3) and r.background_loss == pytest.approx(theirs, rel=2e-3)
        assert r.difference == pytest.approx(r.target_loss - r.background_loss)
    scored = {r.doc_id: r.difference for r in entropy.score(docs, background, target).collect()}
    assert max(scored[i] for i in range(8)) < min(scored[8], scored[9])


def test_odd_rows(spark, documents, odd):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 0), (77, 1, 0)], LABELS)
    docs = documents(odd)
    background, target = entropy.counts(docs, labels, toxicity.held_out)
    rows = entropy.score(docs, background, target).collect()
    assert len(rows) == len(odd)
    assert all(r.difference == 0 and math.isfinite(r.target_loss) for r in rows)  # no target text at all
    empty = documents([]).limit(0)
    background, target = entropy.counts(empty, labels, toxicity.held_out)
    assert not background.any() and entropy.score(empty, background, target).count() == 0


def test_pieces_of_a_long_text_count_each_byte_once(monkeypatch):
    text = bytes(range(97, 123)) * 40
    whole = np.concatenate(entropy.cells(np.frombuffer(text, np.uint8)))
    monkeypatch.setattr(entropy, "PART_BYTES", 100)
    parts = [entropy.cells(p) for p in entropy.parts(text)]
    cut = [np.concatenate([c[k] if i == 0 else c[k][entropy.ORDER:] for i, c in enumerate(parts)])
           for k in range(entropy.ORDER)]
    assert (np.concatenate(cut) == whole).all()


def test_every_ngram_has_its_own_count(spark, documents):
    """More n-grams than a table of 2^20 cells could tell apart: their rows grow with the text, counts are exact."""
    draw = np.random.default_rng(3)
    texts = ["".join(map(chr, draw.integers(97, 123, 40_000))) for _ in range(32)]
    docs = documents(list(enumerate(texts)))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(32)], LABELS)
    background, target = entropy.counts(docs, labels, toxicity.held_out)
    n = {r.gram: r.n for r in background.rows.select("gram", "n").collect()}
    truth = {}
    for text in texts:
        led = "    " + text
        for i in range(len(text)):
            truth[led[i:i + entropy.ORDER]] = truth.get(led[i:i + entropy.ORDER], 0) + 1
    assert n == {int.from_bytes(gram.encode(), "big"): k for gram, k in truth.items()}
    assert len(n) > 1_000_000


def test_texts_that_were_not_counted(spark, documents, prose, monkeypatch):
    """Unknown n-grams, several blocks and long texts in pieces; columns pass through."""
    monkeypatch.setattr(entropy, "BLOCK_BYTES", 200)
    texts = [prose(i, 25) for i in range(8)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8)], LABELS)
    background, target = entropy.counts(documents(list(enumerate(texts))), labels, toxicity.held_out)
    import zlib
    good = [zlib.crc32(str(i).encode()) % 4 != 2 for i in range(8)]
    other = [prose(50, 30), "@@@ never seen ~~~ " + prose(3, 5), "", prose(1, 3)]
    rows = entropy.score(documents([(i, t) for i, t in enumerate(other)]), background, target).collect()
    assert sorted(r.text for r in rows) == sorted(other) and {r.source for r in rows} == {"src0"}

    for r in rows:
        ours, theirs = losses(texts, good, r.text) if r.text else (0, 0)
        assert r.target_loss == pytest.approx(ours, rel=1e-5) and r.background_loss == pytest.approx(theirs, rel=1e-5)
