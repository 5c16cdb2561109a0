"""One text of more than a chunk, and columns whose names clash, through every operator over documents."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import bpe, entropy, licenses, lines, mixing, ngram_join, pii, spots, suffixes, tables, toxicity, variants
from tarmac.llm.queries import tokenizer_path

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def long_text():
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdefgé") for _ in range(draw.randint(2, 9))) for _ in range(3000)]
    text = "\n".join(" ".join(draw.choices(words, k=12)) for _ in range(19_000))
    assert len(text.encode()) > tables.CHUNK_BYTES
    return text + " released under the mit license mail me@example.org now"


@pytest.fixture(scope="module")
def docs(spark, long_text):
    rows = [(1, long_text, "a"), (2, long_text[:-9], "a"), (3, "short words here", "b"), (4, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for name in ("score", "n_words", "spans", "ids", "decoded", "base", "other", "n_lines", "n_removed", "_row", "k1", "k2", "digest"):
        table = table.withColumn(name, F.lit("mine"))
    return table.repartition(2)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_spots(docs):
    found = by_id(spots.with_next(docs))
    assert len(found) == 4 and found[1].near_edited < 1 and found[2].near_next == 1  # cut within the last words


def test_ngram_join(docs):
    found = by_id(ngram_join.near_duplicates(docs))
    assert [found[i].component_id for i in (1, 2, 3, 4)] == [1, 1, 3, 4] and found[1].n_shingles > 200_000


def test_licenses(docs, long_text):
    found = by_id(licenses.scan(docs))
    words = len(re.findall("[a-zé0-9]+", long_text))
    assert found[1].n_words == words and [s.label for s in found[1].spans if s.exact] == ["mit"] and found[1].score == "mine"


def test_bpe(docs, long_text):
    found = by_id(bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()))
    assert found[1].decoded == long_text and found[4].decoded == "" and found[1].score == "mine"


def test_mixing(docs, long_text):
    found = by_id(mixing.taken(docs))
    assert found[1].size == len(long_text.split()) and found[4].size == 0


def test_entropy_and_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 1)], LABELS)
    background, target = entropy.counts(docs, labels, toxicity.held_out)
    assert set(by_id(entropy.score(docs.select("doc_id", "text"), background, target))) == {1, 2, 3, 4}
    scored = by_id(toxicity.score(docs, toxicity.fit(docs, labels)))
    assert all(0 <= r.score <= 1 and r.n_words == "mine" for r in scored.values())


def test_personal_data(docs, long_text):
    found = by_id(pii.report(docs, "doc_id", "score"))
    at = long_text.index("me@")
    assert found[1].n_email == 1 and f"email:{at}:{at + 14}" in found[1].spans and found[1].score == "mine"


def test_lines_and_suffixes(docs, long_text):
    found = by_id(lines.dedup_lines(docs))
    assert found[1].n_lines == long_text.count("\n") + 1 and found[2].n_removed > 18_000 and found[1].k1 == "mine"
    left = by_id(suffixes.remove_repeats(docs))
    size = len(long_text.encode())
    assert left[1].n_bytes == size and left[1].n_removed == left[2].n_removed == size - 9 and left[1].k1 == "mine"


def test_variants(docs, long_text):
    found = {r.word: r.n for r in variants.variants(docs).collect()}
    assert found and all(len(w) >= 7 for w in found)
    run = next(w for w in long_text.split() if len(w) == 9 and all(zlib.crc32(f"{i}:{w}".encode()) % 31 for i in (1, 2)))
    assert found[run] >= long_text.split().count(run)
