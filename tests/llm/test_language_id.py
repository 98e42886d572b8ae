"""Language ID: bundles against a direct sum, held-out accuracy, awkward rows."""

import numpy as np
import unicodedata
from fixtures import awkward_texts, documents, empty
from pyspark.sql import functions as F

from airwave.llm import language_id
from airwave.llm.common import table
from airwave.llm.language_id import DIM, Grams, held_out, learn, letter_vector, pieces, predict


def direct(text):
    symbols = [ord(c) if unicodedata.category(c)[0] == "L" else 0 for c in f"\n{text.lower()}\n"]
    out = np.zeros(DIM)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        if b:
            out += np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)
    return out


def test_bundles_are_sums_of_bound_vectors(monkeypatch):
    monkeypatch.setattr(language_id, "GRAM_BLOCK", 7)
    texts = ["That and onesen.", "Été à l'œuvre 12", "", "日本 語x", "a"]
    got, counts = Grams().bundles(texts, np.arange(5), 5)
    assert (got == np.stack([direct(t) for t in texts])).all()
    assert counts[2] == 0 and counts[4] == 1


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    text = "alpha beta, gamma " * 30
    whole, _ = Grams().bundles([text], np.zeros(1, int), 1)
    monkeypatch.setattr(language_id, "CHUNK_CHARS", 50)
    parts = pieces(text)
    cut, _ = Grams().bundles(parts, np.zeros(len(parts), int), 1)
    assert len(parts) > 5 and "".join(parts) == text and (whole == cut).all()


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = learn(docs.where(~out))
    got = predict(docs.where(out), model).where("length(row.text) > 20")
    right = got.agg(F.avg((F.col("lang_pred") == F.col("row.lang")).cast("double"))).first()[0]
    assert right >= 0.98


def test_awkward_rows(spark):
    texts = awkward_texts()
    docs = documents(spark, texts, clashing=True)
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(docs, learn(docs)).collect()}
    for i, t in enumerate(texts):
        lettered = any(unicodedata.category(c)[0] == "L" for c in t or "")
        assert got[i][0] == ("en" if lettered else "und")
        assert 0 <= got[i][1] <= 1 and (lettered or got[i][1] == 0)


def test_ties_and_no_model(spark):
    docs = documents(spark, ["some text"])
    v = learn(docs)["en"]
    assert predict(docs, {"zz": v, "aa": v}).first()["lang_pred"] == "aa"
    assert predict(docs, {}).first()["lang_pred"] == "und"
    assert learn(empty(spark)) == {} and predict(empty(spark), {}).count() == 0


def test_fold_of_a_null_id_is_learning(spark):
    df = spark.createDataFrame([(None,), (3,)], "i long")
    assert [r[0] for r in df.select(held_out(F.col("i"), 1, 0)).collect()] == [False, True]
