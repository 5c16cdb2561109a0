import hashlib

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import spots


def expected(rows):
    """By definition, in plain Python, over rows with distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        sets = spots.signatures([t.encode() for t in (text, edited, following)])
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), spots.name(sets[0]),
                       spots.name(sets[1]), spots.likeness(sets[0], sets[1]), spots.likeness(sets[0], sets[2]))
    return out


def test_next_and_edited_match_brute_force(documents, prose):
    rows = [(10 * i + 3, prose(i, 30 + 7 * i) + " the end of the lora and more " * (i % 3)) for i in range(25)]
    rows += [(1000, None), (1001, ""), (1002, "é" * 10), (1003, prose(3, 51))]
    found = {r[0]: tuple(r)[1:] for r in spots.with_next(documents(rows, 4)).collect()}
    assert found == expected(rows)


def test_single_and_no_document(documents):
    one = spots.with_next(documents([(4, "the lora mina of the sero lana")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(4, 1.0)]
    assert spots.with_next(documents([]).limit(0)).count() == 0


def test_odd_rows(documents, odd):
    rows = spots.with_next(documents(odd).withColumn("order", F.lit("clash"))).collect()
    assert len(rows) == len(odd)
    assert all(r.near_edited is not None and 0 <= r.near_next <= 1 for r in rows)
    same = {r.fingerprint for r in rows if r.doc_id == 5}
    assert len(same) == 1
    again = spots.with_next(documents(odd, 1)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_spots_follow_common_words():
    a, b = spots.signatures([b"The lora mina, and sero lana.", b"the LORA mina and sero? LANA"])
    assert len(a) == 2 and (a == b).all()
    assert len(spots.signatures([b"the lora the mina"])[0]) == 1  # the first anchor's chain passes the second anchor


def test_near_pairs_match_brute_force(documents, prose):
    texts = [prose(i, 90).replace("ra", " the ") for i in range(12)]
    texts += [t[:int(len(t) * f)] for t in texts[:5] for f in (0.97, 0.9, 0.6)] + [texts[0]] * 4
    docs = documents(list(enumerate(texts)))
    found = {(r.a, r.b): round(r.likeness, 9) for r in spots.near_pairs(spots.fingerprints(docs)).collect()}
    sets = {spots.name(s): s for s in spots.signatures([t.encode() for t in texts])}
    wanted = {(a, b): round(spots.likeness(sets[a], sets[b]), 9) for a in sets for b in sets
              if a < b and spots.likeness(sets[a], sets[b]) >= 0.8}
    assert wanted and found == wanted
    assert spots.likeness(np.arange(4, dtype=np.uint64), np.arange(40, dtype=np.uint64), 0.8) == 0
