"""Ranked lexical search over bit-sliced Bloom signatures, with exact scores of what they leave."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerflow.llm.text import mixed, text_slices
from layerflow.llm.training import stored
from layerflow.llm.wanted import rows_wanted
from layerflow.sinks import stage_table

# A signature holds a term once for each of these that its number of occurrences reaches.
STEPS = (1, 2, 3, 4, 6, 8, 12, 16)
HASHES = 3
BITS_PER_KEY = 8  # at least; a width is a power of two
_CELLS = 1 << 23  # bits of a block at most, unless one document has more
_DOCS = 1024  # documents of a block at most
_TERMS = 1 << 18  # terms counted before a task sends its counts on

# Bytes of terms: A-Z as a-z, other letters, digits and all above 0x7F as they are; rest: blank.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def bit_places(terms: np.ndarray, step: int) -> np.ndarray:
    """``HASHES`` hashes (last axis) of each term's 64-bit hash at a step of ``STEPS``."""
    salt = np.arange(1, HASHES + 1, dtype=np.uint64) + np.uint64(step * HASHES)
    return mixed(terms[..., None] + salt * np.uint64(0x9E3779B97F4A7C15))


def term_hashes(terms: Sequence[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t) for t in terms), np.uint64, len(terms))


def block_signatures(
    docs: Sequence[list[bytes]],
) -> tuple[list[tuple[int, np.ndarray, bytes]], dict[bytes, int]]:
    """Signatures of documents with terms, as (width, documents, slices), and documents per term.

    Documents of like size share a block. Its ``width`` slices are bitmaps over the documents:
    slice ``b`` tells which signatures have bit ``b``.
    """
    known: dict[bytes, int] = {}
    ids = np.fromiter(
        (known.setdefault(t, len(known)) for terms in docs for t in terms),
        np.int64,
        sum(map(len, docs)),
    )
    doc = np.repeat(np.arange(len(docs)), [len(terms) for terms in docs])
    pair, tf = np.unique(doc * len(known) + ids, return_counts=True)
    doc, term = np.divmod(pair, max(1, len(known)))
    counts = dict(zip(known, np.bincount(term, minlength=len(known)).tolist(), strict=True))
    hashes = term_hashes(list(known))
    n_keys = np.zeros(len(docs), np.int64)
    for step in STEPS:
        n_keys += np.bincount(doc[tf >= step], minlength=len(docs))
    need = np.maximum(n_keys * BITS_PER_KEY, 64)
    widths = 1 << np.ceil(np.log2(need)).astype(np.int64)
    widths[n_keys == 0] = 0
    first = np.searchsorted(doc, np.arange(len(docs) + 1))
    out = []
    for width in np.unique(widths[widths > 0]).tolist():
        members = np.flatnonzero(widths == width)
        size = max(8, min(_DOCS, _CELLS // width))
        for start in range(0, len(members), size):
            block = members[start : start + size]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in block])
            column = np.repeat(np.arange(len(block)), first[block + 1] - first[block])
            cells = np.zeros((width, len(block)), bool)
            for k, step in enumerate(STEPS):
                reached = tf[rows] >= step
                places = bit_places(hashes[term[rows[reached]]], k) & np.uint64(width - 1)
                cells[places.astype(np.int64), column[reached, None]] = True
            out.append((width, block, np.packbits(cells, axis=1).tobytes()))
    return out, counts


INDEX = (
    "kind string, width int, keys array<long>, lengths array<long>, slices binary, "
    "term binary, n_docs long"
)


@dataclass(frozen=True)
class LexicalIndex:
    """Signature blocks and term counts, stored; ``docs`` with a column ``key`` per row."""

    docs: DataFrame
    rows: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> LexicalIndex:
    """Index the whole texts of ``docs``, every row of them, in one pass without a shuffle.

    A row of the index is a block of signatures of documents from one batch, or a term and the
    number of documents of some batches that hold it. Rows without a term are left out: no
    search can find them.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            n = len(seen)
            columns = [["term"] * n, *([None] * n for _ in range(4)), list(seen), seen.values()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(c), t.type) for c, t in zip(columns, schema, strict=True)],
                schema=schema,
            )
            seen.clear()
            return out

        for batch in batches:
            keys = batch.column(1).to_numpy()
            for start, _, texts in text_slices(batch.column(0)):
                parsed = [terms_of(t) for t in texts]
                blocks, counts = block_signatures(parsed)
                seen.update(counts)
                for width, members, cells in blocks:
                    row = ["block", width, keys[start + members], None, cells, None, None]
                    row[3] = [len(parsed[d]) for d in members]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t.type) for v, t in zip(row, schema, strict=True)],
                        schema=schema,
                    )
                if len(seen) > _TERMS:
                    yield flushed()
        if seen:
            yield flushed()

    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [
            ("kind", pa.string()),
            ("width", pa.int32()),
            ("keys", longs),
            ("lengths", longs),
            ("slices", pa.binary()),
            ("term", pa.binary()),
            ("n_docs", pa.int64()),
        ]
    )
    spark = docs.sparkSession
    made = keyed.select("text", "key").mapInArrow(run, INDEX)
    path = stage_table(made, "layerflow-search-index", ["kind"])
    rows = spark.read.schema(INDEX).parquet(path)
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    seen = rows.where("kind = 'block'").agg(F.sum(F.size("lengths")), F.sum(total)).first()
    return LexicalIndex(keyed, rows, seen[0] or 0, seen[1] or 0)


@dataclass(frozen=True)
class Queries:
    """A block of items: their terms' weights, and how often each item has each term."""

    n_docs: int
    n_terms: int
    terms: list[bytes]
    weights: list[int]
    hashes: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]  # numbers of terms, and their counts

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + (25 * lengths * self.n_docs) // max(1, self.n_terms)

    def bounds(self, width: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
        """Upper bounds of the scores, items by documents of a block.

        A term's bitmaps, one for each step, are the intersection of its slices. A document in
        the bitmap of a step may have the term so often, and never more often than
        just below the next step unless it is in that bitmap too.
        """
        n = len(lengths)
        cells = np.frombuffer(slices, np.uint8).reshape(width, -1)
        m = self.norm(lengths)
        part = np.zeros((len(self.terms), n))
        rows = np.arange(len(self.terms))
        inside = np.full((len(rows), cells.shape[1]), 255, np.uint8)
        before = np.zeros(n)
        for k in range(len(STEPS)):
            places = bit_places(self.hashes[rows], k) & np.uint64(width - 1)
            got = np.bitwise_and.reduce(cells[places.astype(np.int64)], axis=1) & inside
            some = got.any(axis=1)
            rows, inside = rows[some], got[some]
            if not len(rows):
                break
            most = STEPS[k + 1] - 1 if k + 1 < len(STEPS) else None
            gain = np.full(n, 1e6) if most is None else 1e9 * most // (1000 * most + 12 * m)
            bits = np.unpackbits(inside, axis=1, count=n)
            part[rows] += bits * (gain - before)
            before = gain
        weights = np.array(self.weights, np.float64)
        out = np.zeros((len(self.items), n))
        for i, (numbers, counts) in enumerate(self.items):
            out[i] = (weights[numbers] * counts) @ part[numbers]
        return out

    def scores(self, terms: list[bytes], items: Sequence[int], at: dict[bytes, int]) -> list[int]:
        """Exact scores of one document for some items."""
        tf = {at[t]: c for t, c in Counter(terms).items() if t in at}
        m = 75 + (25 * len(terms) * self.n_docs) // max(1, self.n_terms)
        gain = {t: self.weights[t] * (1_000_000_000 * c // (1000 * c + 12 * m)) for t, c in tf.items()}
        return [
            sum(
                gain.get(t, 0) * c
                for t, c in zip(self.items[i][0].tolist(), self.items[i][1].tolist(), strict=True)
            )
            for i in items
        ]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
    """Width, keys, lengths and slices of one block after another."""
    for i in range(batch.num_rows):
        width, keys, lengths, cells = (column[i] for column in batch.columns)
        keys, lengths = (x.values.to_numpy(zero_copy_only=False) for x in (keys, lengths))
        yield width.as_py(), keys, lengths, cells.as_py()


def _ranked(rows: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The first ``k`` rows of each item, with their ``rank``."""
    order = [F.col(by).desc(), *(F.col(c).asc_nulls_last() for c in ties)]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def _best_bounds(index: LexicalIndex, shared, k: int) -> DataFrame:
    """``item, key, bound``: each task's ``k`` greatest bounds of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = shared.value, None
        for batch in batches:
            for width, keys, lengths, cells in _blocks(batch):
                bounds = queries.bounds(width, lengths, cells)
                keys = np.broadcast_to(keys, bounds.shape)
                if best is not None:
                    bounds = np.concatenate((best[0], bounds), axis=1)
                    keys = np.concatenate((best[1], keys), axis=1)
                if bounds.shape[1] > k:
                    top = np.argpartition(-bounds, k - 1, axis=1)[:, :k]
                    bounds = np.take_along_axis(bounds, top, 1)
                    keys = np.take_along_axis(keys, top, 1)
                best = (bounds, keys)
        if best is not None:
            item, column = np.nonzero(best[0] > 0)
            yield pa.RecordBatch.from_pydict(
                {"item": item, "key": best[1][item, column], "bound": best[0][item, column]}
            )

    blocks = index.rows.where("kind = 'block'").select("width", "keys", "lengths", "slices")
    return blocks.mapInArrow(run, "item long, key long, bound double")


def _not_excluded(index: LexicalIndex, shared, least: np.ndarray) -> DataFrame:
    """``item, key`` of all documents whose bound is not below the item's ``least``."""
    limits = index.rows.sparkSession.sparkContext.broadcast(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = shared.value, limits.value[:, None]
        for batch in batches:
            for width, keys, lengths, cells in _blocks(batch):
                bounds = queries.bounds(width, lengths, cells)
                item, column = np.nonzero((bounds >= least) & (bounds > 0))
                if len(item):
                    yield pa.RecordBatch.from_pydict({"item": item, "key": keys[column]})

    blocks = index.rows.where("kind = 'block'").select("width", "keys", "lengths", "slices")
    return blocks.mapInArrow(run, "item long, key long")


def _exact_scores(index: LexicalIndex, shared, candidates: DataFrame) -> DataFrame:
    """``item, doc_id, score`` of the candidates, from their whole texts."""
    # a document's items are at most the block's
    wanted = candidates.groupBy("key").agg(F.collect_set("item").alias("items"))
    rows = rows_wanted(index.docs, wanted, "key").select("doc_id", "text", "items")
    kind = index.docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        at = {t: i for i, t in enumerate(queries.terms)}
        for batch in batches:
            for start, end, texts in text_slices(batch.column(1)):
                part = batch.slice(start, end - start)
                docs, items, scores = [], [], []
                for n, (text, chosen) in enumerate(zip(texts, part.column(2).to_pylist(), strict=True)):
                    items += chosen
                    scores += queries.scores(terms_of(text), chosen, at)
                    docs += [n] * len(chosen)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(docs, pa.int64())), pa.array(items), pa.array(scores)],
                    names=["doc_id", "item", "score"],
                )

    schema = f"doc_id {kind.simpleString()}, item long, score long"
    return rows.mapInArrow(run, schema).where("score > 0")


def _query_blocks(
    index: LexicalIndex, items: DataFrame, block_chars: int
) -> Iterator[tuple[list, Queries]]:
    """Items of about ``block_chars`` characters at a time, with their terms' weights."""
    spark = items.sparkSession
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = math.ceil(total / block_chars)
    for block in range(n_blocks):
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
        rows = items.where(place == block).collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        parsed = [Counter(terms_of(r.text)) for r in rows]
        terms = sorted(set().union(*parsed))
        if not terms:
            continue
        asked = spark.createDataFrame([(t,) for t in terms], "term binary")
        counted = index.rows.where("kind = 'term'").join(F.broadcast(asked), "term")
        found = counted.groupBy("term").agg(F.sum("n_docs").alias("n_docs"))
        df = {bytes(r.term): r.n_docs for r in found.collect()}  # one row for each of the block's terms
        n = index.n_docs
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in terms]
        at = {t: i for i, t in enumerate(terms)}
        yield [r.item_id for r in rows], Queries(
            n,
            index.n_terms,
            terms,
            weights,
            term_hashes(terms),
            [
                (np.array([at[t] for t in c], np.int64), np.array(list(c.values()), np.int64))
                for c in parsed
            ],
        )


def search(
    index: LexicalIndex, items: DataFrame, k: int = 20, *, block_chars: int = 1_000_000
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score for each item.

    ``items`` has ``item_id`` and ``text``. Every block of items is held against all signatures,
    which give each document an upper bound of its score. The exact scores of the ``k`` with
    the greatest bounds tell how much the ``k``-th best has at least; all documents with a
    bound of no less are then scored exactly from their whole texts, so that the result
    is what scoring all documents gives. What reaches the driver is bounded by a block's items
    and terms. Equal scores rank by id, null ids last. Documents without a term and items without
    one (null and empty texts) give no rows, items repeated with their id give theirs once, and
    repeated documents as many as there are.
    """
    spark = items.sparkSession
    items = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    id_type = items.schema["item_id"].dataType.simpleString()
    doc_type = index.docs.schema["doc_id"].dataType.simpleString()
    schema = f"item_id {id_type}, rank int, doc_id {doc_type}, score long"
    out = spark.createDataFrame([], schema)
    for ids, queries in _query_blocks(index, items, block_chars):
        shared = spark.sparkContext.broadcast(queries)
        first = _ranked(_best_bounds(index, shared, k), "bound", k, "key").select("item", "key")
        seeds = _ranked(_exact_scores(index, shared, first), "score", k, "doc_id")
        least = np.zeros(len(ids))
        for r in seeds.where(F.col("rank") == k).select("item", "score").collect():
            least[r.item] = r.score
        candidates = stored(_not_excluded(index, shared, least), "search-candidates")
        best = _ranked(_exact_scores(index, shared, candidates), "score", k, "doc_id")
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {id_type}")
        out = out.union(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
