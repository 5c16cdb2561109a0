import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import lines, mixing, toxicity
from tarmac.llm.queries import QUERIES
from tarmac.llm.tables import read

HERE = "/root/testdata/sf0.001"


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram join", "mixing", "bpe"]


def test_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(HERE), reason="needs the driver's tables")
def test_decisions_of_each_stage_take_effect(spark):
    docs = read(spark, HERE, "documents")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = at.get("rows", docs)
        at["rows"] = after = stage(spark, before, HERE).cache()
        ids, left = [Counter(r.doc_id for r in df.select("doc_id").collect()) for df in (before, after)]
        if name != "bpe":
            assert after.columns == columns
        if name == "toxicity":
            scored = toxicity.score(before, toxicity.fit(before, read(spark, HERE, "labels")))
            bad = {r.doc_id for r in scored.filter(F.col("score") >= 0.3).collect()}
            assert set(left) == set(ids) - bad
        elif name == "line dedup":
            kept = {r.doc_id: r.text for r in lines.dedup_lines(before).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == {i: kept[i] for i in left}
        elif name == "n-gram join":
            assert set(left) <= set(ids) and len(left) >= 0.5 * len(ids)
        elif name == "mixing":
            words = {r.doc_id: (r.size, r.taken) for r in mixing.taken(before).collect()}
            assert all(left[i] * words[i][0] == words[i][1] for i in ids)
        else:
            assert left == ids and set(after.columns) == {
                "doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_odd_rows_pass_all_stages(spark, documents, odd, tmp_path):
    for table, df in (("documents", documents([(*r, None if i % 2 else "s") for i, r in enumerate(odd)])),
                      ("labels", spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int"))):
        df.write.parquet(f"{tmp_path}/{table}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and all(r.ids_sha256 for r in rows)


def test_empty_tables_pass_all_stages(spark, documents, tmp_path):
    empty = documents([]).limit(0)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


ROWS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines string, _gone int, _row int"


def test_columns_of_the_caller_stay(spark, prose, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, prose(i, 40), "en", "s", 9, "good", "many", i, -i) for i in range(1, 9)], ROWS)
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, str(tmp_path))
        assert after.schema == docs.schema or [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in docs.schema], name
        if name != "mixing":
            assert sorted(map(tuple, after.collect())) == sorted(map(tuple, docs.collect())), name


def test_one_of_each_class_stays_whatever_the_ids(spark, prose, documents):
    a, b, c, d = (prose(i, 60) for i in range(4))
    rows = [(None, a), (None, a), (None, a + " more"), (7, b), (None, b), (5, c), (5, d), (5, c), (9, c + " more"),
            (None, None), (None, None), (3, ""), (3, "")]
    left = corpus_pipeline.drop_near_copies(spark, documents(rows), "").select("doc_id", "text").collect()
    texts = [(r.text or "").removesuffix(" more") for r in left]
    assert sorted(t for t in texts if t) == sorted([a, b, c, d]) and len(texts) == 8  # rows without words stay
    assert {r.doc_id for r in left if r.text and r.text.startswith(b)} == {7}
    assert {r.doc_id for r in left if r.text and r.text.startswith(c)} == {9}
    assert [r.doc_id for r in left if r.text == d] == [5]
