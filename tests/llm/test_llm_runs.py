"""Periodic runs against all periods and stretches."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow.llm import runs
from layerflow.llm.queries import planted_text


def slow_runs(words, min_length=6, min_exponent=4):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, min_exponent * q):
                found.setdefault((start, i + q), q)  # periods come in ascending order
    listed = [(start, end - start, q) for (start, end), q in found.items()]
    return sorted(listed, key=lambda r: (r[0], r[2]))


words_lists = st.lists(st.integers(0, 2), max_size=40)


@settings(max_examples=300, deadline=None)
@given(words_lists, st.integers(1, 9), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_any_cut_of_the_stream(words, step, least):
    catcher = runs.SquareCatcher(*least)
    for i in range(0, len(words), step):
        catcher.append(np.array(words[i : i + step]))
        assert catcher.runs() == slow_runs(words[: i + step], *least)


@pytest.mark.parametrize("seed", range(5))
def test_long_streams(seed):
    random.seed(seed)
    words = []
    while len(words) < 3000:
        root = [random.randrange(4) for _ in range(random.choice([1, 2, 3, 17, 64, 200]))]
        words += (root * random.randint(1, 9))[: random.randint(1, 900)]
    catcher = runs.SquareCatcher()
    catcher.append(np.array(words[:1777]))
    catcher.append(np.array(words[1777:]))
    assert catcher.runs() == slow_runs(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(words_lists, max_size=6))
def test_texts_share_a_catcher(lists):
    texts = [[b"%d" % w for w in words] for words in lists]
    assert runs.runs_of_texts(texts) == [slow_runs(words) for words in texts]


def test_one_word_many_times():
    assert runs.runs_of_texts([[b"a"] * 50_000, [b"b"] * 3]) == [[(0, 50_000, 1)], []]


def test_exponent_below_two():
    with pytest.raises(ValueError):
        runs.SquareCatcher(6, 1)


def test_edge_rows(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \n\t ", "x"),
        (None, "a a a a a a", None),
        (5, "A b\tA b  A b\nA b c", "x"),
        (5, "A b\tA b  A b\nA b c", "x"),
        (6, "é\x85 " * 7, "x"),
        (7, "w " * 200_000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, [], ""),
            (2, [], ""),
            (3, [], ""),
            (None, [(0, 6, 1)], "a"),
            (5, [(0, 8, 2)], "A b c"),
            (5, [(0, 8, 2)], "A b c"),
            (6, [(0, 7, 1)], "é\x85"),
            (7, [(0, 200_000, 1)], "w"),
        ],
        key=str,
    )
    assert runs.find_runs(docs.limit(0)).columns == ["doc_id", "text", "start", "runs", "collapsed"]
    with pytest.raises(ValueError):
        runs.find_runs(docs, runs_col="start")


def slow_planted(doc_id, text):
    words = (text or "").split(" ") if text else []
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_text(spark):
    texts = [None, "", *(" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 5, 40, 333))]
    rows = [(i, texts[i % len(texts)]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = docs.select("doc_id", planted_text(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert {r.doc_id: (r.t or "").split() for r in got} == {i: slow_planted(i, t) for i, t in rows}
