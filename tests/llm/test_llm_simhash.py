"""SimHash classes against all pairs and union-find."""

import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import simhash
from layerflow.llm.components import components
from layerflow.llm.queries import QUERIES


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def slow_classes(prints, max_bits):
    """{node: smallest node reachable} over all pairs."""
    nodes = sorted(set(prints))
    least = {n: n for n in nodes}

    def root(n):
        while least[n] != n:
            n = least[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits:
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {n: root(n) for n in nodes}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aAbBéİ \n\t\x85 ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint_of(text, 3) % (1 << 64) == slow_fingerprint(text)


def test_whole_table(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op8_simhash_near_dedup"](spark, sf_dir).collect()
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    classes = slow_classes(prints.values(), 2)
    first = {}
    for i in sorted(prints):
        first.setdefault(classes[prints[i]], i)
    assert {r.doc_id: r.component_id for r in got} == {
        i: first[classes[p]] for i, p in prints.items()
    }


@pytest.mark.parametrize("crowded", [1, 3, 64])
@pytest.mark.parametrize("max_bits,n_blocks", [(2, 4), (2, 3), (4, 6)])
def test_no_link_is_lost(spark, crowded, max_bits, n_blocks):
    random.seed(crowded + max_bits)
    prints = {random.getrandbits(64) for _ in range(60)}
    for start in random.sample(sorted(prints), 12):
        for _ in range(12):
            flips = sum(1 << b for b in random.sample(range(64), random.randint(1, max_bits + 1)))
            prints.add(start ^ flips)
            start = random.choice([start, start ^ flips])
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.close_pairs(frame, max_bits, n_blocks, crowded=crowded)
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    got = {r.node: r.component for r in components(links).collect()}
    expected = slow_classes(signed, max_bits)
    assert {n: got.get(n, n) for n in signed} == expected
    assert simhash.close_pairs(frame.limit(0), max_bits, n_blocks).count() == 0


def test_components(spark):
    random.seed(11)
    edges = [(i, i + 1) for i in range(80)] + [(500, i) for i in range(501, 560)]
    edges += [(random.randint(1000, 1100), random.randint(1000, 1100)) for _ in range(70)]
    random.shuffle(edges)
    edges = [random.choice([(a, b), (b, a)]) for a, b in edges]
    least = {n: n for e in edges for n in e}
    for _ in range(len(least)):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in got} == {n: c for n, c in least.items() if n in linked}
    assert len(got) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_rows(spark):
    one = "the quick brown fox jumps over the lazy dog"
    rows = [
        (7, one), (3, one.upper()), (3, one.upper()), (None, one), (9, ""), (8, None), (None, " \n"),
        (None, "alone in here"), (None, "alone in here"), (20, "x" * 50_000), (21, "y " * 40_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("fp", F.lit("mine")).withColumn("component", F.lit(1))
    got = simhash.simhash_classes(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {
        (7, 3), (3, 3), (None, 3), (9, 8), (8, 8), (None, 8), (None, None), (20, 20), (21, 21),
    }
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(3, one.upper()), (8, ""), (0, "alone in here"), (20, "x" * 50_000), (21, "y " * 40_000)]
    )
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0
