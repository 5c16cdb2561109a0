import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_by_hand(rows):
    counts = Counter()
    lower = str.maketrans(variants.UPPER, variants.LOWER)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def by_hand(counts):
    form, near_to = {}, {}
    for word, n in counts.items():
        found = [w for w in counts if near(word, w)]
        near_to[word] = len(found)
        best = min(found, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n, near_to[word], counts.get(form[word])))
    return out


@pytest.fixture(scope="module")
def rows_of_words():
    draw = random.Random(8)
    syllables = ["on", "ti", "ER", "an", "é", "×a", "Ñi", "la", "aa", "a"]
    base = ["".join(draw.choice(syllables) for _ in range(draw.randint(4, 7))) for _ in range(40)] + ["a" * 9, "xy" * 150]
    out = []
    for i in range(400):
        words = []
        for word in draw.choices(base, weights=[300 // (k + 1) + 1 for k in range(len(base))], k=25):
            for _ in range(draw.choices([0, 1, 2], weights=[30, 3, 1])[0]):
                p, kind = draw.randrange(len(word)), draw.random()
                letter = draw.choice("abÿ")
                word = word[:p] + (letter if kind < 0.6 else "") + word[p + (kind < 0.3 or kind > 0.6):]
            words.append(word)
        out.append((i if i % 50 else None, " ".join(words) + draw.choice(["", "\n", " 漢字onti7eran_", "\x00"])))
    return out


@pytest.mark.parametrize("bucket", [variants.BUCKET, 7])
def test_variants_by_hand(spark, rows_of_words, rows, bucket, monkeypatch):
    monkeypatch.setattr(variants.near_words, "__defaults__", (bucket,))
    monkeypatch.setattr(variants, "ASKED_AT_ONCE", 50)
    docs = spark.createDataFrame(rows_of_words, "doc_id long, text string").repartition(3)
    counts = words_by_hand(rows_of_words)
    found = variants.variants(docs)
    assert set(rows(found, "word", "form", "root", "n", "n_near", "form_n")) == by_hand(counts)
    assert sum(form is not None for _, form, *_ in by_hand(counts)) > 20


def test_chain_of_forms(spark, rows):
    words = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "abcdefgx": 10, "zzzzzzz": 1}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {r.word: r for r in variants.near_words(table).collect()}
    assert found["abcdefg"].near == "abcdefgh" and found["abcdefg"].n_near == 2  # ties: the smallest
    forms = spark.createDataFrame(list(zip(list(words)[:3], list(words)[1:4])), "word string, form string")
    assert rows(variants._roots(forms)) == sorted((w, "abcdefghij") for w in list(words)[:3])


@pytest.mark.parametrize("letters, size", [("ab", 150), ("abcé", 400)])
def test_index_against_all_pairs(letters, size):
    draw = random.Random(size)
    words = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(5, 9))).encode("latin-1") for _ in range(size)})
    asked = [*words, b"abababab", b"zzzzzzz", b"abbabba" * 3]
    exact = np.array([len(w) - len(w) // 2 for w in asked])
    q, found = variants.Index(words).near(asked, exact)
    pairs = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words)
             if near(a.decode("latin-1"), b.decode("latin-1")) and b.endswith(a[len(a) // 2:])}
    assert set(zip(q.tolist(), found.tolist())) == pairs and len(q) == len(pairs)


def test_odd_rows_clashing_names_and_empty_table(spark, odd, rows):
    long = "".join(random.Random(1).choice("abc") for _ in range(2_000))
    texts = [*odd, (11, long), (12, long), (13, long[:-1] + "z"), (14, long[:-1] + "z")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    found = {r.word: r for r in variants.variants(docs).collect()}
    assert {w: r.n for w, r in found.items()} == words_by_hand(texts)
    assert variants.variants(docs.limit(0)).count() == 0
