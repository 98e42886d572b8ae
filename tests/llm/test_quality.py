"""Quality classifier: parts against direct computation, held-out accuracy, awkward rows."""

import numpy as np
from fixtures import awkward_texts, documents, empty
from pyspark.sql import functions as F

from airwave.llm.common import table
from airwave.llm.language_id import held_out
from airwave.llm.quality import FEATURES, Fourier, classify, features, isotonic, normal_equations


def test_fourier_features_approximate_the_kernel():
    x = np.random.default_rng(1).standard_normal((40, 5))
    z = Fourier(np.zeros(5), np.ones(5), 20_000, 2.0)(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x) ** 2).sum(-1) / (2 * 2.0 ** 2))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_normal_equations_are_sums_over_partitions(spark):
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((300, 4)), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(40)
    mapping = Fourier(np.zeros(4), np.ones(4), 16, 1.0)
    a, v = normal_equations(df, mapping)
    z = mapping(x)
    assert np.allclose(a, z.T @ z) and np.allclose(v, z.T @ y)


def test_isotonic_is_the_least_squares_fit():
    at, share = isotonic(np.arange(6.0), np.array([1, 0, 1, 3, 2, 4]), np.array([2, 2, 2, 4, 4, 4]))
    assert (np.diff(share) > 0).all() and np.allclose(share[0], 0.25)
    assert np.allclose(share, [0.25, 0.5, 0.625, 1.0])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    got = classify(docs, labels, lambda i: ~held_out(i, 5, 0)).select(F.col("row.doc_id").alias("doc_id"), "score")
    known = got.join(labels, "doc_id").where(held_out(F.col("doc_id"), 5, 0)).toPandas()
    assert ((known.score >= 0.3) == (known.quality == 1)).mean() > 0.97
    good, bad = known.score[known.quality == 1].values, known.score[known.quality == 0].values
    assert ((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean() > 0.98


def test_awkward_rows(spark):
    docs = documents(spark, clashing=True)
    labels = spark.createDataFrame([(0, 1), (0, 1), (4, 1), (14, 0), (19, 0), (7, 0), (3, None), (2, 7), (None, 1)],
                                   "doc_id long, quality int")
    got = classify(docs, labels, lambda i: F.lit(True)).collect()
    assert len(got) == len(awkward_texts()) and all(0 <= r["score"] <= 1 for r in got)


def test_no_labels_or_one_class(spark):
    docs = documents(spark, ["a b", None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    assert [r["score"] for r in classify(docs, none, lambda i: F.lit(True)).collect()] == [0.5, 0.5]
    assert [r["score"] for r in classify(docs, one, lambda i: F.lit(True)).collect()] == [1.0, 1.0]
    assert classify(empty(spark), none, lambda i: F.lit(True)).count() == 0


def test_statistics_of_empty_texts_are_finite(spark):
    rows = features(documents(spark, [None, "", " ", "x"])).collect()
    assert all(len(r["x"]) == len(FEATURES) and np.isfinite(r["x"]).all() for r in rows)
