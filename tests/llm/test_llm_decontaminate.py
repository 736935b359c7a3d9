"""Benchmark passages: planted ones are found, substitutions tolerated, clean texts left alone."""

import random
import re

from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import decontaminate
from layerflow.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def test_whole_table_against_brute_force(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    got = {
        (r.doc_id, r.item_id): r
        for r in QUERIES["op9_benchmark_decontamination"](spark, sf_dir).collect()
    }
    exact = set()
    for doc in docs:
        text = f" {' '.join(words(doc.text))} "
        exact |= {(doc.doc_id, i.item_id) for i in items if f" {' '.join(words(i.text))} " in text}
    assert len(exact) > 10
    assert exact <= set(got)
    texts, of = dict(docs), {i.item_id: words(i.text) for i in items}
    for (doc_id, item_id), row in got.items():
        passage = words(texts[doc_id][row.start : row.end])
        assert len(passage) == row.overlap_words
        assert row.matched_words >= 0.8 * row.overlap_words
        assert row.matched_words >= min(13, 0.8 * len(of[item_id]))


def test_substitutions(spark):
    random.seed(5)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(18, 60)))) for i in range(60)]
    docs = []
    for i, text in items:
        passage = text.split()
        for at in random.sample(range(len(passage)), len(passage) * 15 // 100):
            passage[at] = "other"
        around = [random.choices(vocabulary, k=200) for _ in range(2)]
        docs.append((i, " ".join(around[0] + passage + around[1]).title() + "."))
    docs += [(1000 + i, " ".join(random.choices(vocabulary, k=400))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = decontaminate.find_benchmark(frame, bench).collect()
    found = {(r.doc_id, h.item_id) for r in got for h in r.overlaps}
    assert {d for d, _ in found} <= {i for i, _ in items}  # no clean document
    assert len(found & {(i, i) for i, _ in items}) >= 59


def slow_overlap(doc, item):
    """Most matching words of a stretch with at least four fifths equal, over all diagonals."""
    best = 0
    for shift in range(-len(item), len(doc)):
        same = [i for i, w in enumerate(item) if 0 <= i + shift < len(doc) and doc[i + shift] == w]
        for a in range(len(same)):
            for b in range(len(same) - 1, a + best - 1, -1):
                if b - a + 1 >= 0.8 * (same[b] - same[a] + 1) - 1e-9:
                    best = max(best, b - a + 1)
                    break
    return best


def best_of(spark, cases):
    """For each (document, item) of lists of words the matching words that are found, or None."""
    docs = [(i, " ".join(doc)) for i, (doc, _) in enumerate(cases)]
    items = [(i, " ".join(item)) for i, (_, item) in enumerate(cases)]
    found = decontaminate.find_benchmark(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    got = {(r.doc_id, h.item_id): h.matched_words for r in found.collect() for h in r.overlaps}
    return [got.get((i, i)) for i in range(len(cases))]


def test_longest_overlap_against_brute_force(spark):
    random.seed(8)
    cases = []
    for _ in range(150):
        item = random.choices("abcdefgh", k=random.randint(14, 30))
        doc = random.choices("abcdefgh", k=10) + [
            w if random.random() < 0.85 else "x" for w in item
        ]
        cases.append((doc, item))
    for (doc, item), found in zip(cases, best_of(spark, cases), strict=True):
        best = slow_overlap(doc, item)
        assert found == (best if best >= decontaminate.needed_words(len(item)) else None)


def test_edge_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "a b c"), (5, "k l m n o p")],
        "item_id long, text string",
    )
    rows = [(1, item.upper()), (1, item.upper()), (2, None), (3, ""), (4, "a b c"), (None, item)]
    rows += [(5, "x k, l m-n O p y"), (6, "k l m n o q"), (9, "k l x n o p"), (11, "k l x y o p"), (7, "zz " * 70_000 + item), (8, "word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    got = decontaminate.find_benchmark(docs, bench).collect()
    assert sorted((r.doc_id or 0, [h.item_id for h in r.overlaps]) for r in got) == [
        (0, [1]), (1, [1]), (1, [1]), (2, []), (3, []), (4, []), (5, [5]), (6, [5]), (7, [1]), (8, []),
        (9, [5]), (11, []),
    ]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 8, 11]
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0


def counts(same, length):
    """Does a row of equal and other words hold an overlap, by the rule?"""
    need = decontaminate.needed_words(length)
    at = [i for i, equal in enumerate(same) if equal]
    return any(
        b - a + 1 >= need and 5 * (b - a + 1) >= 4 * (at[b] - at[a] + 1)
        for a in range(len(at))
        for b in range(a, len(at))
    )


def seeded(same, length):
    return any(
        all(same[at + i] for i in mask)
        for mask in decontaminate.seed_masks(length)
        for at in range(len(same) - mask[-1])
    )


def test_every_overlap_holds_a_seed():
    """All substitutions in short items; in long ones, all rows without a seed, letter by letter."""
    for length in range(decontaminate.SHORTEST, 16):
        for bits in range(1 << length):
            same = [bits >> i & 1 for i in range(length)]
            assert seeded(same, length) or not counts(same, length), same
    # the most that matches exceed four fifths by, over rows without a seed that begin and end
    # with a match, by (last 7 words, matching words up to 13), scaled by 5; no row need be longer
    # than the point from which no state's value rises any more
    masks = [sum(1 << (mask[-1] - i) for i in mask) for mask in decontaminate.seed_masks(16)]
    states = {(1, 1): 1}
    best = dict(states)
    changed = states
    while changed:
        following = {}
        for (tail, matched), excess in changed.items():
            for equal in (0, 1):
                new = (tail << 1 | equal) & 0x7F
                if any(new & mask == mask for mask in masks):
                    continue
                key = new, min(13, matched + equal)
                value = excess + (1 if equal else -4)
                if value > best.get(key, -100) and value > -60:
                    best[key] = following[key] = value
        changed = following
    assert max(v for (tail, matched), v in best.items() if matched == 13 and tail & 1) < 0


def test_overlaps_at_need_against_brute_force(spark):
    random.seed(9)
    cases = []
    for case in range(600):
        n = random.randint(5, 24)
        item = [f"w{case}x{i}" for i in range(n)]
        passage = list(item)
        for at in random.sample(range(n), random.randint(0, n // 5)):
            passage[at] = "other"
        cases.append(([*"abcde", *passage, *"fghij"], item))
    found_all = 0
    for (doc, item), found in zip(cases, best_of(spark, cases), strict=True):
        best = slow_overlap(doc, item)
        if best >= decontaminate.needed_words(len(item)):
            assert found == best
            found_all += 1
        else:
            assert found is None
    assert found_all > 300


def test_a_phrase_in_all_items_and_texts(spark):
    """A common seed gives a hit for each text, item and diagonal, verified where Spark deals them."""
    phrase = "which of the following answers is right"
    items = [(i, f"{phrase} a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i}") for i in range(400)]
    docs = [(i, " ".join(f"{phrase} t{i}u{j}" for j in range(60))) for i in range(20)]
    docs.append((99, "some words " + items[7][1] + " and more"))
    got = decontaminate.find_benchmark(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {r.doc_id: [h.item_id for h in r.overlaps] for r in got if r.overlaps} == {99: [7]}
    assert len(got) == len(docs)


def test_hits_are_no_more_than_their_join(spark):
    """Equal texts share a key: copies of a text are searched, joined and verified as one."""
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(i, item) for i in range(500)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate._found(docs, bench, "text").collect()
    assert len(found) == 1 and len(found[0].overlaps) == 1
    assert decontaminate.drop_contaminated(docs, bench).count() == 0
