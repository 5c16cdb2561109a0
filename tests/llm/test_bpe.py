import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import bpe
from tarmac.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path()
ENCODER = bpe.Encoder(bpe.Vocabulary(PATH))
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=4))
def test_any_text_as_in_the_library(texts):
    ids = ENCODER.encode(texts).to_pylist()
    assert ids == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", [
    "", " ", "aaaaaaaaaaaaaaaaaaaa", "it's  we'll\n\n  x ", "<|endoftext|>a<|endoftext|><|endoftext|> b", "<|endof", "  x",
    "ab" * 3000, "12345678901234567890", "日本語のテキスト", "\x00\x1c\x85", "Zoë ça ß", "a\U0001f600b", "the" * 500 + " " * 99,
])
def test_hard_texts(text):
    ids = ENCODER.encode([text]).to_pylist()[0]
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    flat = ENCODER.encode([text]).values.to_numpy()
    assert ENCODER.vocabulary.decode(flat, [len(flat)]) == [LIBRARY.decode(ids, skip_special_tokens=False)]


def test_memory_is_forgotten_without_a_trace(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    for text in ("one two three", "four five two", "one six"):
        assert encoder.encode([text]).to_pylist()[0] == LIBRARY.encode(text).ids


def test_digests_and_round_trip(documents, odd, prose):
    rows = odd + [(20, prose(1, 400)), (21, "a<|endoftext|>b")]
    docs = documents(rows).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    wanted = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        shown = LIBRARY.decode(ids, skip_special_tokens=False)
        wanted.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(shown.encode()).hexdigest()))
    found = [tuple(r) for r in bpe.digests(docs, PATH, "doc_id").collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    back = bpe.decode(bpe.encode(docs, PATH), PATH).select("text", "decoded").collect()
    assert all((r.text or "") == r.decoded for r in back)
    assert bpe.digests(documents([]).limit(0), PATH, "doc_id").count() == 0


def test_both_ways_in_one_worker_a_task(spark):
    docs = spark.createDataFrame(
        [(1, "Hello wörld  the 123"), (2, None), (3, ""), (4, "aaa " * 500), (1, "again")], "doc_id long, text string")
    path = tokenizer_path()
    apart = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    both = bpe.round_trip(docs, path)
    assert both.columns == apart.columns and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    plan = bpe.digests(docs, path, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
