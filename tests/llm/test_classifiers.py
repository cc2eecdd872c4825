"""Language and quality: held-out accuracy, codewords, odd rows."""

import zlib

import numpy as np
import pytest

from tidetable.llm import language, quality


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 20])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
    assert min(apart, default=1) >= (code.shape[1] // 4 if n > 2 else 1)
    if n > 1:
        assert (np.abs(code.astype(int).sum(axis=0)) < n).all()


def test_one_wrong_bit_is_corrected():
    code = language.codewords(4)
    model = language.LanguageModel(("a", "b", "c", "d"), code, None, None, np.full(7, 1 / 7), 0.02)
    margins = 2.0 * code.astype(float)
    margins[:, 3] *= -1
    best, score, doubt = model.decode(margins)
    assert best.tolist() == [0, 1, 2, 3] and not doubt.any() and (score > 0.5).all()
    assert model.decode(np.zeros((1, 7)))[2].all()


def test_language_query(result, documents):
    rows = result("op1_language_codes")
    assert len(rows) == len(documents)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held]) >= 0.9


def test_language_of_odd_rows(odd_docs, no_docs, odd_rows):
    model = language.fit(odd_docs, "text", "lang", "doc_id")
    rows = language.predict(odd_docs, model).collect()
    assert len(rows) == len(odd_rows) and model.languages == ("en", "fr")
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        assert r["ambiguous"] or r["lang_pred"] != "und"
    same = {r["text"]: set() for r in rows}
    for r in rows:
        same[r["text"]].add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in same.values())
    nothing = language.fit(no_docs, "text", "lang", "doc_id")
    assert {r["lang_pred"] for r in language.predict(odd_docs, nothing).collect()} == {"und"}
    assert language.predict(no_docs, model).count() == 0


def test_a_fit_is_repeatable(odd_docs):
    a, b = (language.fit(odd_docs.repartition(n), "text", "lang", "doc_id") for n in (2, 5))
    assert np.allclose(a.weights, b.weights)


def test_quality_query(result, documents, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    rows = result("op7_quality_ftrl")
    assert len(rows) == len(documents)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["predicted"] == 1 for r in rows if labels.get(r["doc_id"]) == 1]) >= 0.95


def test_quality_learns_repetition_and_noise(spark):
    rng = np.random.default_rng(0)
    words = ["w%d" % i for i in range(500)]
    good = [" ".join(rng.choice(words, 40)) for _ in range(150)]
    noise = [" ".join(x + "$$$" for x in rng.choice(words, 40)) for _ in range(75)]
    again = [" ".join([x for x in rng.choice(words, 5) for _ in range(8)]) for _ in range(75)]
    rows = [(i, t, int(i < 150)) for i, t in enumerate(good + noise + again)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    model = quality.fit(docs, docs.where("doc_id % 3 <> 0").select("doc_id", "quality"), "doc_id", "quality")
    held = quality.score(docs, model).where("doc_id % 3 = 0").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95


def test_quality_of_odd_rows(odd_docs, no_docs, odd_rows, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(5, None), (None, 1), (3, 0)], "doc_id bigint, quality int")
    model = quality.fit(odd_docs, labels, "doc_id", "quality")
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == len(odd_rows)
    bias = 1 / (1 + np.exp(-model.bias))
    assert all(abs(r["score"] - bias) < 1e-12 for r in rows if not (r["text"] or "").strip())
    unlabelled = quality.fit(odd_docs, labels.where("false"), "doc_id", "quality")
    assert {r["score"] for r in quality.score(odd_docs, unlabelled).collect()} == {0.5}
    assert quality.score(no_docs, model).count() == 0
