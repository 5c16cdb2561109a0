import random

import pytest
from pyspark.sql import functions as F

from tarmac.llm import ngram_join
from tarmac.llm.ngram_join import Rule


def expected(rows, rule):
    """All pairs of sets of word tuples, joined by union and find."""
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        k = rule.width
        sets[doc_id] = frozenset([tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else [])
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            shared = len(sets[i] & sets[j])
            if i < j and shared and 100 * shared >= rule.percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def collection(prose):
    """Chains of small edits, copies, and a passage that half of the texts share."""
    draw = random.Random(5)
    rows, passage = [], prose(999, 60)
    for i in range(14):
        words = prose(i, 80).split() if i % 2 else (prose(i, 30) + " " + passage).split()
        for step in range(1 + i % 5):
            rows.append((len(rows) * 3 + 1, " ".join(words)))
            words = list(words)
            words[draw.randrange(len(words))] = f"edit{i}x{step}"
    base = prose(77, 120).split()
    for i in range(40):  # a class of near copies of one text
        words = list(base)
        for k in range(i % 4):
            words[(7 * i + 31 * k) % 120] = f"own{i}x{k}"
        rows.append((len(rows) * 3 + 1, " ".join(words)))
    return rows + [(500, rows[0][1].upper()), (501, "two words"), (502, "Two  words"), (503, ""), (504, None)]


@pytest.mark.parametrize("rule", [Rule(4, 85), Rule(5, 80)])
def test_classes_match_brute_force(documents, prose, rule):
    rows = collection(prose)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(rows, 5), rule).collect()}
    assert found == expected(rows, rule)


def test_order_of_ngrams_does_not_change_the_classes(documents, prose, monkeypatch):
    rows = collection(prose)[:45]
    wanted = expected(rows, Rule(4, 85))
    monkeypatch.setattr(ngram_join, "LEAST_FREQUENT", 2)
    monkeypatch.setattr(ngram_join, "MAX_FREQUENT", 60)
    found = ngram_join.near_duplicates(documents(rows, 2), Rule(4, 85)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_odd_rows(documents, odd):
    rows = ngram_join.near_duplicates(documents(odd).withColumn("digest", F.lit(1)), Rule(4, 85)).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(odd)
    assert (by_id[2].n_shingles, by_id[2].component_id) == (0, 2) and by_id[3].component_id == 3
    assert by_id[5].component_id == 5 and by_id[None].component_id is None


def test_empty_table(documents):
    assert ngram_join.near_duplicates(documents([]).limit(0)).count() == 0


def test_prefix_sizes():
    assert [Rule(4, 85).prefix(n) for n in (0, 1, 6, 7, 100)] == [0, 1, 1, 2, 16]


@pytest.mark.parametrize("letters", [512, 1024, 2048, 4096])
def test_complementary_words_are_different(spark, documents, letters):
    """Words in which the two letters alternate by parity of bits, and their complements: sums of powers collide on them."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(letters))
    other = word.translate(str.maketrans("ab", "ba"))
    found = ngram_join.near_duplicates(documents([(1, word), (2, other), (3, other)]), Rule(width=4, percent=85))
    assert sorted(tuple(r)[:3] for r in found.select("doc_id", "n_shingles", "component_id").collect()) == [(1, 1, 1), (2, 1, 2), (3, 1, 2)]


def test_hash_of_words_depends_on_every_byte_and_the_length():
    from tarmac.llm.words import flat_words, hashed

    texts = [b"a" * n for n in range(1, 40)] + [b"b" * i + b"c" + b"b" * (23 - i) for i in range(24)] + [b"a\0", b"a\0\0", b"x" * 9]
    data, starts, ends, _ = flat_words([b" ".join(texts), b"  " + texts[5]])
    values = hashed(data, starts, ends)
    assert len(set(values[:-1].tolist())) == len(texts) and values[-1] == values[5]
