"""Language identification: held-out accuracy and odd inputs."""

from __future__ import annotations

import zlib

import numpy as np

from rateweave.llm import language_id as L
from rateweave.llm import queries

SF1 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = queries.op5_language_id(spark, SF1).toPandas()
    docs = spark.read.parquet(f"{SF1}/documents.parquet").select("doc_id", "lang").toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]).all()
    held = got[got["held_out"]].merge(docs, on="doc_id")
    assert (held["lang_pred"] == held["lang"]).mean() > 0.99


def test_matrix_is_naive_bayes_by_hand(docs_of):
    rows = [(i, "ab ab" if i % 2 else "ba c", "xx" if i % 2 else "yy") for i in range(40)]
    rows = [(i, t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    model = L.train(docs_of(rows))
    assert model.languages == ["xx", "yy"]
    for at, text in enumerate(["ab ab", "ba c"]):
        counts = np.zeros(1 << L.BUCKET_BITS)
        n = sum(r[2] == model.languages[at] for r in rows)
        for found in L.buckets(text):
            np.add.at(counts, found.astype(int), n)
        want = np.log((counts + L.SMOOTHING) / (counts + L.SMOOTHING).sum())
        assert np.allclose(model.matrix[:, at], want, rtol=1e-5)
    assert np.allclose(np.exp(model.priors), [sum(r[2] == c for r in rows) / len(rows) for c in ("xx", "yy")])
    texts = ["AB!", "ab", None, "c", "1"]
    languages, scores = model.predict(texts)
    assert languages == ["xx", "xx", "und", "yy", "und"] and scores[0] == scores[1] and scores[2] == scores[4] == 0
    for text, language, score in zip(texts, languages, scores):  # alone or in a batch, in plain arithmetic
        assert model.predict([text]) == ([language], [score])
        if language != "und":
            logs = model.priors + sum(model.matrix[int(b)].astype(float) for found in L.buckets(text) for b in found)
            assert np.isclose(score, 1 / np.exp(logs - logs.max()).sum())


def test_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "²"), (5, "e " * 100_000), (5, "e"), (None, "e"), (6, "o", None)]
    docs = docs_of(rows + [(i, "hello there", "en") for i in range(10, 40)])
    model = L.train(docs)
    got = {}
    for r in L.identify(docs.drop("score"), model).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert [got[i][0][0] for i in (1, 2, 3, 4)] == ["und"] * 4
    assert got[5] == [("en", 1.0)] * 2 and got[None] == [("en", 1.0)] and got[6][0][0] == "en"


def test_without_any_training_row(docs_of):
    docs = docs_of([(1, "text", None), (None, "text", "en")])
    model = L.train(docs)
    assert {(r["lang_pred"], r["score"]) for r in L.identify(docs.drop("score"), model).collect()} == {("und", 0.0)}
    assert L.identify(docs_of([]).drop("score"), L.train(docs_of([]))).count() == 0


def test_no_language_takes_more_than_its_share(docs_of):
    docs = docs_of([(i, "a", "en") for i in range(300)] + [(i, "b", "fr") for i in range(300, 312)])
    model = L.train(docs, max_rows=5)
    assert np.allclose(np.exp(model.priors), [0.5, 0.5])


def test_slices_do_not_change_counts(monkeypatch):
    text = "Some wörds, with ÄÖ and numbers 12 in  between."
    whole = np.sort(np.concatenate(list(L.buckets(text))))
    monkeypatch.setattr(L, "CHUNK", 5)
    assert (np.sort(np.concatenate(list(L.buckets(text)))) == whole).all()
    rng = np.random.default_rng(1)
    model = L.Model(["a", "b"], np.log([0.5, 0.5]), rng.normal(size=(1 << L.BUCKET_BITS, 2)).astype(np.float32))
    sliced = model.predict([text, "", text[:9], "x"])
    monkeypatch.undo()
    again = model.predict([text, "", text[:9], "x"])
    assert sliced[0] == again[0] and np.allclose(sliced[1], again[1])
