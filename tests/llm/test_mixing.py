import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.llm import mixing


def expected_targets(rows, limit=3, weights=(1, 2, 3)):
    """Shares by weight, capped again and again until none is above its limit."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(limit * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        share = {s: limit * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if share[s] > limit * sizes[s] and s not in full}
        if not over:
            return dict(sizes), share
        full |= over


def make(prose, n=160, sources=("b", "a", "é", None, "Z", "c")):
    draw = random.Random(9)
    return [(i, prose(i, draw.randrange(5, 60)), draw.choices(sources, (30, 3, 2, 8, 1, 6))[0]) for i in range(n)]


def test_targets_and_taken(documents, prose):
    rows = make(prose)
    found = mixing.taken(documents(rows)).collect()
    sizes, share = expected_targets(rows)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(share[source[r.doc_id]])
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, target in share.items():
        assert abs(taken[s] - target) <= 31, s  # half of the longest document
    assert sum(share.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.taken(documents(rows, 7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mixed_rows_are_the_taken_words(documents, prose):
    rows = make(prose, 60)
    docs = documents(rows).withColumn("size", F.lit("clash")).withColumn("_row", F.lit(0))
    copies = Counter(r.doc_id for r in mixing.mix(docs).select(*docs.columns).collect())
    for r in mixing.taken(docs).collect():
        assert copies[r.doc_id] * r.size == r.taken


def test_longer_documents_are_preferred(documents, prose):
    rows = [(i, prose(i, 20 if i % 2 else 400), "ab"[i < 30]) for i in range(240)]
    got = {r.doc_id: r.taken / r.size for r in mixing.taken(documents(rows)).collect()}
    rare = [got[i] for i, _, s in rows if s == "a"]
    assert sum(rare[::2]) > sum(rare[1::2])


def test_odd_rows(documents, odd):
    rows = mixing.taken(documents([(*r, None if i % 2 else "s") for i, r in enumerate(odd)])).collect()
    assert len(rows) == len(odd) and all(r.taken <= 3 * r.size and r.target is not None for r in rows)
    assert mixing.taken(documents([]).limit(0)).count() == 0
    blank = mixing.taken(documents([(1, ""), (2, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def test_plan_is_native(documents, prose):
    plan = mixing.taken(documents(make(prose, 20)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
