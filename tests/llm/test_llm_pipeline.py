"""The pipeline on whole tables against its stages by brute force, and on awkward rows."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import TESTDATA
from layerflow.llm import sentencepiece
from test_llm_decontaminate import words
from test_llm_quality import brute
from test_llm_simhash import slow_classes, slow_fingerprint


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_against_brute_force(spark, tmp_path):
    sf_dir = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r for r in docs.collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        rows = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(rows)
        if n < 4:
            assert docs.columns == columns
        if name == "quality rules":
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
            for i in texts:
                assert not (i in rows and brute(texts[i].text)["base_failed"])
            sound = {l.doc_id for l in labels if l.quality and not brute(texts[l.doc_id].text)["base_failed"]}
            junk = {l.doc_id for l in labels if not l.quality}
            assert len(sound - set(rows)) <= 1 and len(junk & set(rows)) <= 2
            assert all(rows[i] == texts[i] for i in rows)
        elif name == "simhash near-dedup":
            prints = {i: slow_fingerprint(r.text) for i, r in texts.items()}
            classes = slow_classes(prints.values(), 2)
            first = {}
            for i in sorted(prints):
                first.setdefault(classes[prints[i]], i)
            assert set(rows) == set(first.values())
            assert all(rows[i] == texts[i] for i in rows)
        elif name == "benchmark decontamination":
            items = [f" {' '.join(words(r.text))} " for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            held = {i for i, r in texts.items() if any(x in f" {' '.join(words(r.text))} " for x in items)}
            assert held and set(rows) == set(texts) - held
        elif name == "personal data":
            assert set(rows) == set(texts)
            pattern = re.compile(r"[\w.]+@[\w.]+\w|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b(?:\d{1,3}\.){3}\d+\b|\b(?:[0-9a-f]{32,}|[0-9A-F]{32,})\b")
            for i, r in rows.items():
                assert r.n_chars == len(r.text)
                assert pattern.sub("_", r.text) == pattern.sub("_", texts[i].text)
                assert not set(pattern.findall(r.text)) & set(pattern.findall(texts[i].text))
        else:
            pieces = sentencepiece.load_pieces()
            assert set(rows) == set(texts)
            for i, r in rows.items():
                assert sentencepiece.decode_ids(r.ids, pieces) == texts[i].text
        texts = rows


@pytest.fixture
def awkward(spark, tmp_path):
    line = " ".join(f"word{i} sits here" for i in range(12))
    rows = [
        (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, line, None, None, 5), (3, line, None, None, 5),
        (None, line + " a@b.cc", "en", "s", 1), (4, "and then " * 30_000, "en", "s", 1), (5, "short", "en", "s", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("item_id", F.lit(1)).withColumn("label", F.lit(2)).withColumn("word", F.lit("w"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(3, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_awkward_rows(spark, awkward):
    got = corpus_pipeline.run(spark, awkward).collect()
    assert sorted((r.doc_id or 0, r.word, r.label) for r in got) == [(0, "w", 2), (3, "w", 2)]
    assert all(r.n_chars == len(r.text) and r.ids for r in got)


def test_empty_tables(spark, awkward, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        empty = spark.read.parquet(f"{awkward}/{table}.parquet").limit(0)
        empty.write.parquet(f"{tmp_path}/empty/{table}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
