"""Which labelled rows a model may see, and the small fits."""

import numpy as np
from pyspark.sql import functions as F

from layerflow.llm.training import (
    SparseRows,
    fit_logistic,
    fit_sparse_logistic,
    labelled_sample,
    sigmoid,
)


def test_labelled_sample(spark):
    docs = spark.range(500).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), F.col("id").cast("int")).alias("text")
    )
    docs = docs.union(docs).withColumn("label", F.lit("mine"))
    docs = docs.unionByName(
        spark.createDataFrame([(None, "x", "m"), (900, None, "m")], "doc_id long, text string, label string")
    )
    labels = spark.range(0, 500, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("good"))
    labels = labels.union(spark.createDataFrame([(0, 0), (None, 1), (900, 1), (4, 7), (6, None)], "doc_id long, good int"))
    whole = labelled_sample(docs, labels, "good", 10_000).collect()
    assert len(whole) == 251 and len({r.doc_id for r in whole}) == 251
    assert {r.doc_id: r.label for r in whole}[0] == 1
    assert all(r.text == "ab" * r.doc_id for r in whole if r.doc_id != 900)
    some = {r.doc_id for r in labelled_sample(docs.repartition(7), labels, "good", 40).collect()}
    assert len(some) == 40
    assert some == {r.doc_id for r in labelled_sample(docs.coalesce(1), labels, "good", 40).collect()}
    even = labelled_sample(docs, labels, "good", 40, F.col("doc_id") % 3 == 0).collect()
    assert all(r.doc_id % 3 == 0 for r in even)
    short = labelled_sample(docs, labels, "good", 10_000, max_chars=8000).collect()
    assert sum(len(r.text) for r in short) <= 8000 and max(len(r.text) for r in short) <= 400
    assert labelled_sample(docs, labels.limit(0), "good", 10).count() == 0


def test_fits():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < sigmoid(2 * x[:, 0] - x[:, 1] + 0.5)).astype(float)
    assert np.allclose(fit_logistic(x, y, l2=1e-6), [2, -1, 0.5], atol=0.2)
    rows = [(np.array([int(a > 0), 2 + int(b > 0)]), np.ones(2)) for a, b in x]
    weights, bias = fit_sparse_logistic(SparseRows(rows, 4), y, l2=1e-6)
    assert weights[1] - weights[0] > 1 and weights[3] - weights[2] < -0.5
    assert np.array_equal(weights, fit_sparse_logistic(SparseRows(rows, 4), y, l2=1e-6)[0])
