"""Toxic spans: the chain against enumeration, scores on rows never learnt from."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import toxicity
from layerflow.llm.queries import QUERIES


def enumerated(emission, moves, begin):
    """Marginals of state 1 and expected moves of one text, over all labellings."""
    n = len(emission)
    total, ones, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for path in itertools.product([0, 1], repeat=n):
        weight = begin * path[0] + sum(e * s for e, s in zip(emission, path, strict=True))
        weight += sum(moves[a, b] for a, b in zip(path, path[1:], strict=False))
        weight = np.exp(weight)
        total += weight
        ones += weight * np.array(path)
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += weight
    return ones / total, pairs / total


@pytest.mark.parametrize("segment", [1, 2, 5, 128])
def test_forward_backward(monkeypatch, segment):
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    lengths = [1, 7, 2, 9, 1, 1, 4]
    emission = rng.normal(size=sum(lengths), scale=2)
    moves, begin = rng.normal(size=(2, 2)), -0.7
    first = np.zeros(len(emission), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    p, counts = toxicity._forward_backward(emission, first, moves, begin)
    expected = np.zeros((2, 2))
    at = 0
    for n in lengths:
        ones, pairs = enumerated(emission[at : at + n], moves, begin)
        assert np.allclose(p[at : at + n], ones)
        expected += pairs
        at += n
    assert np.allclose(counts, expected)


def test_rows_never_learnt_from(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf_dir)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = rows.toPandas()
    assert len(rows) == 10_000 and rows["doc_id"].is_unique
    assert all(
        h == (zlib.crc32(str(i).encode()) % 4 == 2)
        for i, h in zip(rows["doc_id"], rows["held_out"], strict=True)
    )
    assert rows["score"].between(0, 1).all()
    assert ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    unseen = rows[rows["held_out"]].merge(labels, on="doc_id")
    hits = (unseen["predicted"] == 1) & (unseen["toxic"] == 1)
    assert hits.sum() >= 0.93 * (unseen["toxic"] == 1).sum()
    assert ((unseen["predicted"] == 1) & (unseen["toxic"] == 0)).sum() <= 5


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    held = toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(docs, x, usable=~held, max_rows=300) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and np.array_equal(one.score, two.score)


def model():
    random.seed(9)
    vocabulary = [f"word{c}{d}" for c in "abcdefghijklmnop" for d in "qrstuvwxyz"] + ["a", "boat"]
    texts, toxic = [], []
    for i in range(400):
        words = random.choices(vocabulary, k=random.randint(3, 40))
        toxic.append(i % 4 == 0)
        for _ in range(random.randint(1, 3) * toxic[-1]):
            words.insert(random.randint(0, len(words)), random.choice(["dunce", "knave"]))
        texts.append(" ".join(words))
    return toxicity.fit(texts, np.array(toxic, float))


def test_chunks_give_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    emission, moves = rng.normal(size=500), rng.normal(size=(2, 2))
    first = rng.random(500) < 0.1
    first[0] = True
    p, counts = toxicity._forward_backward(emission, first, moves, 0.3)
    for chunk in (1, 7, 100, 499, 500, 501):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        q, more = toxicity._chunked(emission, first, moves, 0.3)
        assert np.allclose(p, q) and np.allclose(counts, more)


def test_edge_rows(spark):
    fitted = model()
    long = "wordaq wordbr wordcs " * 40_000
    rows = [
        (1, None), (2, ""), (3, "wordaq a Dunce, DUNCE wordbr"), (3, "wordaq a Dunce, DUNCE wordbr"),
        (None, "wordaq wordbr boat"), (4, long), (5, "?!"), (6, "wordes dunce"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(0))
    with pytest.raises(ValueError):
        toxicity.score_toxicity(docs, fitted)
    got = toxicity.score_toxicity(docs, fitted, prefix="t_", keep=["doc_id", "text", "spans"])
    got = sorted(got.collect(), key=lambda r: r.doc_id or 0)
    assert [r.t_predicted for r in got] == [0, 0, 0, 1, 1, 0, 0, 1]
    for r in got[3:5]:
        assert [r.text[s.start : s.end].lower() for s in r.t_spans] == ["dunce, dunce"]
    assert got[1].t_score == got[2].t_score == got[6].t_score < 0.3
    assert [r.spans for r in got] == [0] * len(rows)
    none = toxicity.score_toxicity(docs, None, prefix="t_").collect()
    assert all(r.t_score == 0 and r.t_predicted == 0 and r.t_spans == [] for r in none)
    assert toxicity.score_toxicity(docs.limit(0), fitted, prefix="t_").count() == 0
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(docs, empty) is None
    assert toxicity.fit(["", ""], np.array([0, 1])) is None
