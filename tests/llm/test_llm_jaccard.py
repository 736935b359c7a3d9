"""Jaccard classes against all pairs and union-find."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerflow.llm import jaccard


def slow_set(text, shingle=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)}


def linked(a, b, percent=80):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= percent * (len(a) + len(b) - common)


def slow_labels(sets, percent=80):
    """For each set the first one that links connect it with."""
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(sets))]


def edited_texts(seed, n, edits=4):
    random.seed(seed)
    word = lambda: random.choice("abcdefgh") + str(random.randrange(30))
    bases = [[word() for _ in range(random.choice([1, 3, 5, 8, 40, 150]))] for _ in range(6)]
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(n):
        words = list(random.choice(bases))
        for _ in range(random.randint(0, edits)):
            words[random.randrange(len(words))] = word()
        if random.random() < 0.2:
            words = [word() for _ in range(30)] + passage + [word() for _ in range(30)]
        texts.append(" ".join(words))
    return texts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbBé \n\t\x85", max_size=40), min_size=1, max_size=5))
def test_token_sets(texts):
    token, first = jaccard.token_sets(texts, 5)
    sets = [slow_set(t) for t in texts]
    assert [b - a for a, b in zip(first, first[1:], strict=False)] == [len(s) for s in sets]
    got = [set(token[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
    for x, p in zip(sets, got, strict=True):
        for y, q in zip(sets, got, strict=True):
            assert len(x & y) == len(p & q)


@pytest.mark.parametrize("percent", [50, 80, 100])
@pytest.mark.parametrize("seed", range(4))
def test_trees(seed, percent):
    texts = edited_texts(seed, 120)
    token, first = jaccard.token_sets(texts, 5)
    sets = [token[a:b] for a, b in zip(first, first[1:], strict=False)]
    slow = [slow_set(t) for t in texts]
    assert jaccard.exact_labels(sets, percent).tolist() == slow_labels(slow, percent)

    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    bitmaps = []
    for o in order:
        bits = np.zeros(jaccard.width_of(sizes[[o]])[0], bool)
        bits[(sets[o] & np.uint64(len(bits) - 1)).astype(int)] = True
        bitmaps.append(np.packbits(bits, bitorder="little").tobytes())
    for part in (np.zeros(120, int), (np.arange(120) >= 50).astype(int)):
        label = jaccard.candidate_labels(sizes[order], bitmaps, part, percent)
        for i in range(120):
            for j in range(i):
                meet = part.max() == 0 or part[i] != part[j]
                if meet and linked(slow[order[i]], slow[order[j]], percent):
                    assert label[i] == label[j]


@pytest.mark.parametrize("chunk,hot_from", [(512, 64), (16, 2)])
def test_classes(spark, monkeypatch, chunk, hot_from):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "HOT_FROM", hot_from)
    texts = edited_texts(9, 400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(docs).collect()}
    sets = [slow_set(t) for t in texts]
    labels = slow_labels(sets)
    assert got == {i: (len(sets[i]), labels[i]) for i in range(len(texts))}
    assert len(set(labels)) < 350


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (5, "one two three", "x"),
        (4, "ONE two\tthree", "x"),
        (4, "ONE two\tthree", "x"),
        (6, "one two", "x"),
        (7, None, "x"),
        (8, "", "x"),
        (9, " \n", "x"),
        (None, long, None),
        (11, long + " more", "x"),
        (None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted((tuple(r) for r in jaccard.jaccard_classes(docs).collect()), key=str)
    assert got == sorted(
        [
            (5, 1, 4),
            (4, 1, 4),
            (4, 1, 4),
            (6, 1, 6),
            (7, 0, 7),
            (8, 0, 8),
            (9, 0, 9),
            (None, 29_996, 11),
            (11, 29_997, 11),
            (None, 0, None),
        ],
        key=str,
    )
    empty = jaccard.jaccard_classes(docs.limit(0))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0


def test_wide_bitmaps_meet_a_few_at_a_time(monkeypatch):
    """What a task holds at once does not grow with the width of the bitmaps."""
    most, may_link = [0], jaccard._may_link

    def watched(a, b, i, j, percent):
        most[0] = max(most[0], len(i) * a[0][:1].nbytes)
        return may_link(a, b, i, j, percent)

    monkeypatch.setattr(jaccard, "_may_link", watched)
    rng = np.random.default_rng(5)
    base = rng.integers(1, 1 << 62, 20000, dtype=np.uint64)
    sets = [np.sort(np.delete(base, rng.integers(0, 20000, 40))) for _ in range(300)]
    assert jaccard.exact_labels(sets, 80).tolist() == [0] * 300
    assert most[0] <= 1 << 23
