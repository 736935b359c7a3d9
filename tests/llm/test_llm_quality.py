"""Quality rules against brute force, and the classifier on rows it has not seen."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import quality
from layerflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": len(words) < 20 or 100 * len(inside) > 30 * len(words),
    }


TEXT = st.one_of(
    st.text(alphabet="ab \n\t\x0b\x85 #|é\U0001f642", max_size=120),
    st.lists(st.sampled_from(["a", "b", "c\n", "#d"]), max_size=60).map(" ".join),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_counts(texts):
    found = quality.measure(texts, None)
    for i, text in enumerate(texts):
        assert {name: found[name][i] for name in brute(text)} == brute(text)


def test_whole_table_against_brute_force(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op2_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = brute(texts[row.doc_id])
        assert {name: row[name] for name in expected} == expected
        assert not (row.kept and row.base_failed)
        assert 0 <= row.quality <= 1


def test_unseen_rows_and_clean_documents(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    unseen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = quality.train(docs, labels.where(~unseen))
    rows = quality.quality_rules(docs.where(unseen), model, prefix="q_").join(labels, "doc_id")
    found = {
        (r.quality, r.q_kept): r["count"]
        for r in rows.where("NOT q_base_failed").groupBy("quality", "q_kept").count().collect()
    }
    assert found[1, True] > 900 and found.get((1, False), 0) <= 2
    assert found[0, False] > 80 and found.get((0, True), 0) <= 3


def test_edge_rows(spark):
    words = " ".join(f"w{i}" for i in range(25))
    rows = [(1, None), (2, ""), (3, words), (3, words), (None, words), (4, "ab " * 60_000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("mine"))
    with pytest.raises(ValueError):
        quality.quality_rules(docs, None)
    got = quality.quality_rules(docs, None, prefix="q_").collect()
    assert sorted((r.doc_id or 0, r.q_n_words, r.q_kept, r.n_words) for r in got) == sorted(
        [
            (1, 0, False, "mine"),
            (2, 0, False, "mine"),
            (3, 25, True, "mine"),
            (3, 25, True, "mine"),
            (0, 25, True, "mine"),
            (4, 60_000, False, "mine"),
        ]
    )
    assert quality.keep_good(docs, None).columns == docs.columns
    assert quality.keep_good(docs, None).count() == 3
    assert quality.keep_good(docs.limit(0), None).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, empty) is None
    one_sided = spark.createDataFrame([(3, 1), (None, 0)], "doc_id long, quality int")
    assert quality.train(docs, one_sided) is None


def test_same_model_for_rows_in_any_order():
    random.seed(3)
    texts = ["good words here " * 8 + str(i) for i in range(40)]
    texts += ["*** | ### $$$ " * 8 + str(i) for i in range(40)]
    rows = [quality.sparse_row(t) for t in texts]
    column, value = rows[0]
    assert np.isclose(value.sum(), quality.SCALE * quality.KINDS)
    points = quality.Points(texts)
    weights = np.zeros(quality.KINDS << quality.BUCKET_BITS, np.float32)
    weights[column] = 1
    got = quality.margins(points, points.words(), weights)
    expected = [v[np.isin(c, column)].sum() for c, v in rows]
    assert np.allclose(got, expected, atol=1e-3)


def test_slices_bound_a_tasks_memory():
    """Words of a batch of four million code points are hashed in little memory."""
    import tracemalloc

    import pyarrow as pa

    from layerflow.llm import text

    column = pa.array(["some words of a text " * 50] * 4000)
    text.tables(), text._cache.clear()
    tracemalloc.start()
    try:
        n = 0
        for _, _, texts in text.text_slices(column):
            points = text.Points(texts)
            n += len(points.words().hashes(points.lowered()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 4000 * 50 * 5 and peak < 80e6
