"""Licence notices: families, unknown ones, and whole tables against plain search."""

import re
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import licenses
from layerflow.llm.queries import QUERIES
from layerflow.llm.training import stored


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return licenses.train(docs)


def test_whole_table(spark):
    """The notices that these tables hold are lines of their own."""
    sf_dir = f"{TESTDATA}/sf0.1"
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    patterns = {
        "Apache-2.0": r"under\W+the\W+apache\W+license",
        "MIT": r"under\W+the\W+mit\W+license",
        "GPL": r"gnu\W+general\W+public\W+license",
        "CC-BY-NC": r"under\W+cc\W+by\W+nc",
    }
    expected = {
        (doc_id, n, family)
        for doc_id, text in texts
        for n, line in enumerate(text.split("\n"))
        for family, pattern in patterns.items()
        if re.search(pattern, line.lower())
    }
    got = QUERIES["op5_license_scan"](spark, sf_dir).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got if r.confirmed} == expected
    assert len(got) == len({(r.doc_id, r.paragraph) for r in got})


def test_families_and_unknown(spark, model):
    known = {
        "Apache-2.0": "This file is licensed under the Apache License, Version 2.0, as you can see.",
        "MIT": "All code here is released under the MIT License.",
        "GPL": "The tool is licensed under the GNU General Public License, version 3.",
        "BSD": "REDISTRIBUTION AND USE IN SOURCE AND BINARY FORMS, with or without modification, "
        "are permitted provided that the following conditions are met:",
        "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
        "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    }
    unknown = [
        "He lost his driving license on the public road in version 3 of the story.",
        "Licensed under the terms of our customer agreement.",
        "The software was general and the public went home under the trees.",
        "A copy of the book was given to the author.",
    ]
    rows = [(text, family) for family, text in known.items()] + [(t, None) for t in unknown]
    frame = spark.createDataFrame(rows, "text string, wanted string")
    got = licenses.scan(frame, model).collect()
    assert {r.wanted: r.family for r in got if r.confirmed} == {f: f for f in known}
    assert not [r for r in got if r.wanted is None and r.confirmed]


def confirmed(spark, model, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = licenses.scan(frame, model).where("confirmed").collect()
    return {texts[r.i]: r.family for r in got}


def test_siblings_are_not_confused(spark, model):
    """Every notice of every family, alone and framed, is confirmed as its own family or as none."""
    cases = [(f, t) for f, notices in licenses.TEMPLATES.items() for t in notices]
    cases += [(f, f"This file is {t[0].lower()}{t[1:]}") for f, t in cases]
    got = confirmed(spark, model, [t for _, t in cases])
    for family, text in cases:
        assert got.get(text, family) == family, text
    missed = [(f, t) for f, t in cases if t not in got]
    assert len(missed) <= len(cases) // 20, missed


def test_verdicts_near_a_notice(spark, model):
    known = {
        "This file is licensed under the GNU Affero General Public License, version 3.": "AGPL",
        "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.": "CC-BY-SA",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
        "License.": "CC-BY-ND",
        "All contents here are licensed under CC BY-SA 4.0.": "CC-BY-SA",
        "Released under the ISC License.": "ISC",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 2 of "
        "the License, or (at your option) any later version.": "GPL",
    }
    unknown = [
        "This work is not licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU Verbatim Public License, version 3.",
        "This file is not released under the MIT License.",
        "Licensed under CC BY-XY 4.0.",
    ]
    got = confirmed(spark, model, [*known, *unknown])
    assert got == known


def test_cues_meet_every_weight(model):
    counter, regression = model.pipeline.stages
    weighted = regression.coefficientMatrix.toArray().any(axis=0)
    for gram, used in zip(counter.vocabulary, weighted, strict=True):
        assert not used or set(gram.split()) & set(model.cues)
    assert 0.5 <= model.threshold < 1


def test_scan_of_all_lines_gives_the_same(spark, docs, model):
    """Leaving out lines without a cue changes nothing: without a weight a line is unknown."""
    every = licenses.LicenseModel(model.pipeline, sorted({w for t in licenses.TEMPLATES.values() for x in t for w in licenses._split(x)}), model.threshold)
    one, two = (
        {(r.doc_id, r.paragraph, r.family) for r in licenses.scan(docs, m).collect()} for m in (model, every)
    )
    assert one == two


def test_edge_rows(spark, model):
    notice = "Released under the MIT License."
    rows = [
        (1, None), (2, ""), (3, f"\n\n{notice}\n"), (3, f"\n\n{notice}\n"), (None, notice),
        (4, "the license " * 30_000), (5, f"{'word ' * 40_000}\n{notice}"), (6, " \t"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("w"))
    got = licenses.scan(frame, model).collect()
    assert sorted((r.doc_id or 0, r.paragraph, r.words) for r in got if r.confirmed) == [
        (0, 0, "w"), (3, 2, "w"), (3, 2, "w"), (5, 1, "w"),
    ]
    assert licenses.scan(frame.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(frame.withColumn("family", F.lit(1)), model)
    assert licenses.scan(frame, licenses.train(frame.limit(0))).where("confirmed").count() == 4


def test_no_python_in_the_plan(spark, docs, model):
    plan = licenses.scan(docs, model)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_wrapped_notices(spark, model):
    """Notices as source files have them: wrapped, behind comment marks, among other lines."""
    texts = [(family, max(licenses.TEMPLATES[family], key=len)) for family in licenses.TEMPLATES]
    texts += [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t) > 100]
    rows = []
    for family, notice in texts:
        for width, mark in ((72, " * "), (60, "# "), (40, "// "), (72, "")):
            if len(notice) <= width:
                continue
            body = [mark + line for line in textwrap.wrap(notice, width)]
            text = ["Some words before.", mark.rstrip(), *body, mark.rstrip(), "int main() {", "}"]
            rows.append((len(rows), "\n".join(text), family))
    frame = spark.createDataFrame(rows, "doc_id long, text string, wanted string")
    got = licenses.scan(frame, model).where("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got} >= {(i, 2, f) for i, _, f in rows}
    assert {(r.doc_id, r.family) for r in got} == {(i, f) for i, _, f in rows}
    assert len(got) == len({(r.doc_id, r.paragraph) for r in got})


def test_training_takes_every_paragraph(spark, monkeypatch):
    """The fit and the threshold come from all distinct paragraphs, however many there are."""
    kept = []
    monkeypatch.setattr(
        licenses, "stored", lambda df, label: kept.append(stored(df, label)) or kept[-1]
    )
    lines = ["under the software", "A notice of conditions", "nothing here"]
    texts = ["\n".join(f"{lines[i % 3]} w{d}x{i}" for i in range(150)) for d in range(40)]
    rows = list(enumerate([*texts, *texts, None, ""]))
    licenses.train(spark.createDataFrame(rows, "doc_id int, text string"))
    rows = kept[0].groupBy("fold").agg(F.sum("n").alias("n")).collect()
    assert sum(r.n for r in rows) == 6000
    assert {r.fold for r in rows} == {0, 1, 2}
    assert kept[0].count() <= 9  # equal n-grams are one row


def test_only_grams_of_notices_are_put_together(spark):
    """Words, pairs and triples that no notice has are no n-grams of a row; the others all are."""
    texts = ["", "the", "Licensed under the Zebra", "under the MIT license the the MIT", "zebra MIT; license zebra of"]
    rows = spark.createDataFrame([(licenses._split(t),) for t in texts], "words array<string>")
    vocabulary = set(licenses._vocabulary())
    for words, grams in licenses._grams(rows).collect():
        every = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        assert sorted(grams) == sorted(g for g in every if g in vocabulary)
