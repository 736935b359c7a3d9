"""Benchmark passages in documents: spaced-seed hits, then substitution-tolerant overlaps."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm.text import Points, add_from_text, mixed, text_slices
from layerflow.llm.training import stored
from layerflow.llm.wanted import bitmap_of, holds, rows_by_key, rows_wanted

SIMILARITY = 0.8
MIN_WORDS = 13  # matching words that make an overlap, or a whole shorter item's share of them
SHORTEST = 5  # items with fewer words are no evidence and match nothing
# Words of a seed, by the item's length: the most of which every overlap that counts holds a seed.
SEED_WORDS = {5: 4, 6: 4, 10: 4, 11: 5, 12: 5}
LONG_SEED_WORDS = 6  # of all other items
SEED_BITS = 1 << 25  # of the bitmap of the benchmark's seeds, 4 MB whatever the benchmark's size
_STEP = np.uint64(0xD6E8FEB86659FD93)
_KEY = "__lf_key"


def needed_words(length: int) -> int:
    """Matching words that make an overlap with an item of ``length`` words."""
    return min(MIN_WORDS, math.ceil(SIMILARITY * length))


def _masks(n: int) -> list[tuple[int, ...]]:
    holes = (tuple(i for i in range(n + 1) if i != hole) for hole in range(1, n))
    return [tuple(range(n)), *holes]


def seed_masks(length: int) -> list[tuple[int, ...]]:
    """Word positions that seeds of an item look at, from the first; another may hold any word.

    A seed is some words in a row, or as many with one other word among them. An overlap without
    a seed of 6 words has runs of 5 equal words at most, and 5 at most in two runs with one
    word between, which is under four fifths from 13 matching words on, so no overlap with an item
    of 16 words or more lacks one. The tests prove this, and try all substitutions in shorter items.
    """
    return _masks(SEED_WORDS.get(length, LONG_SEED_WORDS))


def _seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Seed hash at each word position from which the mask fits into the array."""
    n = max(0, len(hashes) - mask[-1])
    # masks differ in what they look at, so that begins their hashes
    total = np.full(n, np.uint64(sum(1 << i for i in mask)))
    for offset in mask:
        total = total * _STEP + hashes[offset : offset + n]
    return mixed(total)


def _words(texts: Sequence[str]):
    """The texts' words (runs of letters and digits) and their hashes in lower case."""
    points = Points(texts)
    words = points.alphanumeric()
    return points, words, words.hashes(points.lowered())


def overlap(words: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(matching words, first word, end) of the longest overlap on a diagonal, if it counts.

    Only substitutions are tolerated: the item's first word is laid on the text's word ``diagonal``,
    and the stretch between two matching words with the most of them at ``SIMILARITY`` or more
    is sought.
    """
    start, end = max(diagonal, 0), min(diagonal + len(item), len(words))
    equal = words[start:end] == item[start - diagonal : end - diagonal]
    need = needed_words(len(item))
    at = np.flatnonzero(equal)
    if len(at) < need:
        return None
    # a stretch from match i to match j counts if its excess of matches is not negative:
    # tail[j] >= share[i]; for each i the last such j
    share = np.arange(len(at)) - SIMILARITY * at
    tail = np.maximum.accumulate((share + 1 - SIMILARITY)[::-1])[::-1]
    last = np.searchsorted(-tail, -share + 1e-9, "right") - 1
    matched = last - np.arange(len(at)) + 1
    i = int(np.argmax(matched))
    if matched[i] < need:
        return None
    return int(matched[i]), start + int(at[i]), start + int(at[last[i]]) + 1


# The benchmark's side.


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, n, words``: each distinct item with its word hashes, stored.

    Null ids and texts match nothing, and neither do items of fewer than ``SHORTEST`` words.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").na.drop()

    def compute(texts: list[str]) -> dict[str, Sequence]:
        _, words, hashes = _words(texts)
        parts = [hashes[a:b].tobytes() for a, b in zip(words.first, words.last, strict=True)]
        return {"n": words.last - words.first, "words": parts}

    added = {"n": (pa.int64(), "long"), "words": (pa.binary(), "binary")}
    rows = add_from_text(items.distinct(), compute, added, keep=["item_id"])
    numbered = rows.where(F.col("n") >= SHORTEST).distinct()
    return stored(numbered.withColumn("item", F.monotonically_increasing_id()), "benchmark-items")


def item_seeds(items: DataFrame) -> DataFrame:
    """``seed, item, place``: every seed of every item, and the word it begins at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.frombuffer(text, np.uint64)
                for mask in seed_masks(len(hashes)):
                    seeds = _seeds(hashes, mask)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "seed": seeds.view(np.int64),
                            "item": np.full(len(seeds), item),
                            "place": np.arange(len(seeds)),
                        }
                    )

    return items.select("item", "words").mapInArrow(run, "seed long, item long, place long")


# The documents' side.


def text_seeds(docs: DataFrame, sizes: Sequence[int], bitmap: np.ndarray, text_col: str) -> DataFrame:
    """``seed, key, at``: the seeds of whole texts that the benchmark may hold too.

    ``key`` stands for the text; ``sizes`` are the numbers of words in the seeds. The benchmark's
    bitmap of fixed size, against which each task tests its seeds, leaves nearly no others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    masks = [mask for n in sizes for mask in _masks(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for start, _, texts in text_slices(batch.column(0)):
                _, words, hashes = _words(texts)
                for mask in masks:
                    seeds = _seeds(hashes, mask)
                    at = np.flatnonzero(holds(known, (seeds & np.uint64(SEED_BITS - 1)).astype(np.int64)))
                    at = at[words.doc[at] == words.doc[at + mask[-1]]]
                    if len(at):
                        doc = words.doc[at]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "seed": seeds[at].view(np.int64),
                                "key": keys[start + doc],
                                "at": at - words.first[doc],
                            }
                        )

    rows = docs.select(text_col, F.xxhash64(text_col).alias("key"))
    return rows.mapInArrow(run, "seed long, key long, at long")


HIT = pa.struct(
    [
        ("item_id", pa.int64()),
        ("matched_words", pa.int32()),
        ("overlap_words", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
    ]
)
HIT_DDL = "array<struct<item_id:long,matched_words:int,overlap_words:int,start:int,end:int>>"


def _verified(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """``key, overlaps`` of the texts (``key, text``) that some hit (``key, diagonal``, item) proves.

    A text and its hits come to one task in a row, the text first, and pass through it batch by
    batch: no task holds all hits of a text, only its overlaps so far, the longest of each item.
    """
    none = F.lit(None)
    both = texts.select(
        "key",
        "text",
        none.cast("long").alias("diagonal"),
        none.cast("long").alias("item"),
        none.cast("long").alias("item_id"),
        none.cast("binary").alias("words"),
    ).unionByName(hits.withColumn("text", none.cast("string")))
    ordered = both.repartition("key").sortWithinPartitions("key", F.col("item").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = points = words = hashes = None
        best: dict[int, tuple] = {}

        def found() -> Iterator[pa.RecordBatch]:
            if not best:
                return
            rows = []
            for _, (item_id, (matched, first, end)) in sorted(best.items()):
                rows.append(
                    {
                        "item_id": item_id,
                        "matched_words": matched,
                        "overlap_words": end - first,
                        "start": int(words.starts[first]),
                        "end": int(words.ends[end - 1]),
                    }
                )
            rows.sort(key=lambda r: (r["item_id"], r["start"]))
            arrays = [pa.array([key]), pa.array([rows], pa.list_(HIT))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "overlaps"])

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "diagonal", "item", "item_id", "words")]
            is_text = batch.column("item").is_null().to_numpy(zero_copy_only=False)
            for row in range(batch.num_rows):
                if is_text[row]:
                    yield from found()
                    key, best = columns[0][row].as_py(), {}
                    points, words, hashes = _words([batch.column("text")[row].as_py()])
                    continue
                _, diagonal, item, item_id, given = (c[row].as_py() for c in columns)
                got = overlap(hashes, np.frombuffer(given, np.uint64), diagonal)
                # of equally long ones the first in the text
                if got and (item not in best or (-got[0], got[1]) < (-best[item][1][0], best[item][1][1])):
                    best[item] = (item_id, got)
        yield from found()

    return ordered.mapInArrow(run, f"key long, overlaps {HIT_DDL}")


def _found(docs: DataFrame, benchmark: DataFrame, text_col: str) -> DataFrame:
    """``key, overlaps`` of the texts that overlap an item, stored."""
    spark = docs.sparkSession
    items = benchmark_items(benchmark)
    # at most three: the sizes of seeds
    lengths = {r.n for r in items.select(F.least("n", F.lit(16)).alias("n")).distinct().collect()}
    sizes = sorted({SEED_WORDS.get(n, LONG_SEED_WORDS) for n in lengths})
    if not sizes:
        return spark.createDataFrame([], f"key long, overlaps {HIT_DDL}")
    seeds = stored(item_seeds(items), "benchmark-seeds")
    bitmap = bitmap_of(seeds, F.col("seed").bitwiseAND(F.lit(SEED_BITS - 1)), SEED_BITS)
    of_texts = text_seeds(docs, sizes, bitmap, text_col)
    hits = of_texts.join(seeds, "seed").select(
        "key", "item", (F.col("at") - F.col("place")).alias("diagonal")
    )
    hits = stored(hits.distinct(), "benchmark-hits")
    keyed = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    texts = rows_wanted(keyed, hits.select("key").distinct(), "key").dropDuplicates(["key"])
    whole = hits.join(items.select("item", "item_id", "words"), "item")
    return stored(_verified(texts, whole), "overlaps")


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, column: str = "overlaps", text_col: str = "text"
) -> DataFrame:
    """``docs`` with an array of the benchmark items that each whole text overlaps, by id.

    Words are runs of letters and digits in lower case. The item is laid along the text and counts
    when at least 13 words match (four fifths of a shorter item) and the stretch that holds them
    is at least four fifths equal; every such overlap holds a seed (see ``seed_masks``). Texts and
    items are joined on their seeds, and each diagonal on which a seed agrees is verified. Offsets
    are in code points. Items of under 5 words match nothing; null and empty texts have no
    overlaps. ``item_id`` is read as a long; two items of one id count as two. Neither side is held
    in one place: the benchmark's seeds are known to every task by a bitmap of 4 MB alone, and
    texts are shuffled only if the bitmap of those with an overlap lets them pass.
    """
    if column in docs.columns or _KEY in docs.columns:
        raise ValueError(f"column {column} is there already; give another name")
    found = _found(docs, benchmark, text_col).withColumnsRenamed({"key": _KEY, "overlaps": column})
    keyed = docs.withColumn(_KEY, F.xxhash64(text_col))
    some, rest = rows_by_key(keyed, found, _KEY)
    empty = F.array().cast(HIT_DDL)
    matched = some.join(found, _KEY, "left").withColumn(column, F.coalesce(column, empty))
    return matched.select(*docs.columns, column).unionByName(
        rest.select(*docs.columns, empty.alias(column))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with its columns."""
    found = find_benchmark(docs, benchmark, column="__lf_overlaps")
    return found.where(F.size("__lf_overlaps") == 0).select(*docs.columns)
