"""Ranked search against scores of all documents for all items."""

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from layerflow.llm import search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def slow_search(docs, items, k=20):
    """{item: [(doc_id, score)]}, each item's best first; ids are never null here."""
    parsed = [(i, slow_terms(t)) for i, t in docs]
    n_docs = sum(bool(t) for _, t in parsed)
    total = sum(len(t) for _, t in parsed)
    df = Counter(term for _, t in parsed for term in set(t))
    out = {}
    for item, text in items:
        scored = []
        for doc_id, terms in parsed:
            tf, score = Counter(terms), 0
            for term in slow_terms(text):
                if term in tf:
                    m = 75 + 25 * len(terms) * n_docs // total
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * tf[term] // (1000 * tf[term] + 12 * m))
            if score:
                scored.append((-score, doc_id))
        if scored:
            out[item] = [(doc_id, -s) for s, doc_id in sorted(scored)[:k]]
    return out


def ranked(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.item_id, r.rank)):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAzZ09@[`{ \x00\x7f\x80éİ\n", max_size=30))
def test_terms(text):
    assert [t.decode() for t in search.terms_of(text)] == slow_terms(text)


def random_corpus(n_docs, n_words, seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(n_words)]
    weights = [1 / (i + 1) for i in range(n_words)]
    text = lambda n: " ".join(random.choices(vocabulary, weights, k=n))
    docs = [(i, text(random.choice([1, 5, 40, 300]))) for i in range(n_docs)]
    return docs, [(i, text(random.randint(1, 30))) for i in range(12)]


def test_random_corpora(spark):
    for seed, n_words in ((1, 40), (2, 2000)):
        docs, items = random_corpus(700, n_words, seed)
        items += [(90, "W0 w0 unheard"), (91, "unheard"), (92, ""), (93, None), (94, "@ -")]
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        asked = spark.createDataFrame(items, "item_id long, text string")
        index = search.build_index(frame)
        for chars in (1_000_000, 300):
            got = search.search(index, asked, block_chars=chars).collect()
            assert ranked(got) == slow_search(docs, items)


def test_bounds_are_upper_bounds():
    docs, items = random_corpus(300, 100, 3)
    parsed = [search.terms_of(t) for _, t in docs]
    blocks, counts = search.block_signatures(parsed)
    terms = sorted(counts)
    at = {t: i for i, t in enumerate(terms)}
    asked = []
    for _, text in items:
        c = Counter(search.terms_of(text))
        asked.append((np.array([at[t] for t in c if t in at]), np.array([c[t] for t in c if t in at])))
    total = sum(map(len, parsed))
    weights = [7 + i for i in range(len(terms))]
    queries = search.Queries(300, total, terms, weights, search.term_hashes(terms), asked)
    tight = seen = 0
    for width, members, cells in blocks:
        bounds = queries.bounds(width, np.array([len(parsed[d]) for d in members]), cells)
        for column, d in enumerate(members):
            exact = queries.scores(parsed[d], range(len(items)), at)
            assert all(b >= s for b, s in zip(bounds[:, column], exact, strict=True))
            tight += sum(b <= 1.2 * s for b, s in zip(bounds[:, column], exact, strict=True))
            seen += len(exact)
    assert sorted(d for _, members, _ in blocks for d in members) == list(range(300))
    assert tight > seen / 2  # bounds that tell documents apart


def test_edge_rows(spark):
    docs = [
        (3, "same words here", "x"),
        (2, "same words here", "x"),
        (2, "same words here", "x"),
        (None, "same words here", None),
        (7, None, "x"),
        (8, "", "x"),
        (9, " .,; ", "x"),
        (10, "long " * 300_000 + "here", "x"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    items = spark.createDataFrame(
        [(1, "words here"), (1, "words here"), (None, "long"), (5, None)], "item_id long, text string"
    )
    index = search.build_index(frame)
    assert (index.n_docs, index.n_terms) == (5, 12 + 300_001)
    got = [tuple(r) for r in search.search(index, items).collect()]
    first = sorted(r[:3] for r in got if r[0] == 1)
    assert first == [(1, 1, 2), (1, 2, 2), (1, 3, 3), (1, 4, None), (1, 5, 10)]
    assert [r[:3] for r in got if r[0] is None] == [(None, 1, 10)]
    assert len(got) == 6
    top = [tuple(r) for r in search.search(index, items, k=2).collect()]
    assert sorted(r[1:3] for r in top if r[0] == 1) == [(1, 2), (2, 2)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(search.build_index(docs), items).collect() == []
    full = search.build_index(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert search.search(full, items.limit(0)).collect() == []
    assert len(search.search(full, items).collect()) == 1
