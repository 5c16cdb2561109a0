import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def labelled(prose, n=240):
    """A tenth of the texts holds words that no other text has."""
    rows, marks = [], []
    for i in range(n):
        words, bad = prose(i, 80).split(), i % 6 == 0
        if bad:
            for k in range(3):
                words[(11 * i + 17 * k) % len(words)] = ("wretched", "filthy", "scoundrel")[(i // 6 + k) % 3]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_held_out_accuracy(spark, documents, prose):
    rows, marks = labelled(prose)
    docs, labels = documents(rows), spark.createDataFrame(marks, LABELS)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    bad = {i for i, _, t in marks if t}
    fresh = [r for r in scored if r.held_out]
    right = sum((r.score >= toxicity.THRESHOLD) == (r.doc_id in bad) for r in fresh)
    assert len(fresh) > 40 and right / len(fresh) > 0.9
    assert all(0 <= r.score <= 1 for r in scored)


def test_held_out_labels_do_not_matter(spark, documents, prose):
    rows, marks = labelled(prose, 90)
    docs, labels = documents(rows), spark.createDataFrame(marks, LABELS)
    turned = labels.withColumn("toxic", (labels.toxic + toxicity.held_out(labels.doc_id).cast("int")) % 2)
    one, two = (toxicity.fit(docs, x) for x in (labels, turned.select("doc_id", "quality", turned.toxic.cast("int").alias("toxic"))))
    texts = [t.encode() for _, t in rows[:20]]
    assert (one.scores(texts) == two.scores(texts)).all()


def test_odd_rows_and_labels_of_one_kind(spark, documents, odd):
    docs = documents(odd)
    for marks in ([], [(1, 1, None), (None, 1, 1)], [(i, 1, 0) for i in range(10)]):
        model = toxicity.fit(docs, spark.createDataFrame(marks, LABELS))
        assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0] * len(odd)
    assert toxicity.score(documents([]).limit(0), model).count() == 0


def test_windows_cover_the_text():
    for n in (0, 1, 47, 48, 49, 84, 85, 300):
        text = bytes(i % 251 for i in range(n))
        cut = toxicity.windows(text)
        assert cut[0] == text[:48] and cut[-1] == text[toxicity.STEP * (len(cut) - 1):]
        assert toxicity.STEP * (len(cut) - 1) + toxicity.WINDOW >= n


def test_calibration_puts_the_best_cut_at_the_threshold():
    raw, y = np.array([3.0, 2, 1, 0, -1]), np.array([1.0, 1, 0, 0, 0])
    shift = toxicity.Model.calibrated(raw, y)
    assert ((1 / (1 + np.exp(-raw - shift)) >= toxicity.THRESHOLD) == y.astype(bool)).all()


def test_long_texts_do_not_end_the_sample(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_FIT_BYTES", 400_000)
    rows, marks = labelled(prose, 120)
    assert sum(len(t) for _, t in rows) < toxicity.MAX_FIT_BYTES
    long = [(1000 + i, "long " * 90_000) for i in range(20)]
    plain = toxicity.fit(documents(rows), spark.createDataFrame(marks, LABELS))
    mixed = toxicity.fit(documents(rows + long), spark.createDataFrame(marks + [(i, 1, 0) for i, _ in long], LABELS))
    texts = [t.encode() for _, t in rows]
    assert plain.weights is not None and (plain.scores(texts) == mixed.scores(texts)).all()


def test_scores_from_plain_zstandard_calls(spark, documents, prose):
    """Scores recomputed from the two trained dictionaries, window by window."""
    import zstandard

    rows, marks = labelled(prose)
    model = toxicity.fit(documents(rows), spark.createDataFrame(marks, LABELS))
    assert model.toxic.startswith(model.plain) and 0 < len(model.toxic) - len(model.plain) <= toxicity.TOXIC_DICTIONARY
    assert any(word in model.toxic[len(model.plain):] for word in (b"wretched", b"filthy", b"scoundrel"))
    assert not any(word in model.plain for word in (b"wretched", b"filthy", b"scoundrel"))

    def length(window, words):
        kind = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=3, dict_data=kind, write_content_size=False, write_checksum=False,
                                            write_dict_id=False).compress(window))

    for _, text in rows[:8]:
        data = text.lower().encode()
        saved = np.array([length(w, model.plain) - length(w, model.toxic)
                          for w in (data[i:i + 48] for i in range(0, max(1, len(data) - 12), 36))], float)
        top = np.sort(saved)[-3:]
        x = np.array([1, top[-1], top.mean(), saved.mean(), np.log1p(np.maximum(saved - 1, 0).sum()), np.sqrt((saved >= 2).mean())])
        score = 1 / (1 + np.exp(-(x / model.scale @ model.weights + model.shift)))
        assert abs(model.scores([text.encode()])[0] - score) < 1e-8


def test_rare_toxic_labels_still_score(spark, documents, prose, monkeypatch):
    """One text in 60 is toxic, more than the sample would hold if it took rows as they come."""
    monkeypatch.setattr(toxicity, "MAX_FIT_ROWS", 120)
    rows, marks = [], []
    for i in range(1800):
        words, bad = prose(i, 40).split(), i % 60 == 0
        if bad:
            for k in range(3):
                words[(11 * i + 17 * k) % len(words)] = ("wretched", "filthy", "scoundrel")[(i // 60 + k) % 3]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    docs = documents(rows)
    scored = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(marks, LABELS)))
    found = {r.doc_id for r in scored.filter(F.col("score") >= toxicity.THRESHOLD).collect()}
    bad = {i for i, _, t in marks if t}
    assert len(found & bad) >= 0.8 * len(bad) and len(found - bad) <= 0.01 * len(rows)
