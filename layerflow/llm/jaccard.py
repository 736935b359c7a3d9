"""Jaccard join of word n-gram sets by trees of OR-combined token bitmaps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerflow.llm.components import components
from layerflow.llm.text import Points, add_from_text, mixed, slices, text_slices
from layerflow.llm.training import stored
from layerflow.llm.wanted import rows_wanted

FAN = 8  # children of a tree's node
CHUNK = 512  # documents of one tree; a larger group is a forest, whose trees meet two by two
HOT_TOKENS = 1 << 16  # tokens that come last in the order of prefixes, at most
HOT_FROM = 64  # documents that make a token one of them
SET_CHARS = 1 << 19  # characters whose sets are made at once
_PAIRS = 1 << 13  # node pairs looked at together, at most
_PAIR_BYTES = 1 << 23  # their bitmaps, at most
_STEP = np.uint64(0xD6E8FEB86659FD93)


# Sets of tokens.


def token_sets(texts: Sequence[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in ascending order, and each text's first one.

    Only A-Z are lower-cased. A text with fewer words gives its whole sequence as one token.
    """
    points = Points(texts)
    codes = points.codes + np.where((points.codes >= 65) & (points.codes <= 90), np.uint32(32), np.uint32(0))
    words = points.words()
    hashes = words.hashes(codes)
    n = max(0, len(hashes) - shingle + 1)
    token = np.full(n, np.uint64(shingle))
    for k in range(shingle):
        token = mixed(token * _STEP + hashes[k : k + n])
    whole = words.doc[:n] == words.doc[shingle - 1 : shingle - 1 + n]
    token, doc = token[whole], words.doc[:n][whole]
    lengths = words.last - words.first
    short = np.flatnonzero((lengths > 0) & (lengths < shingle))
    if len(short):
        alone = np.empty(len(short), np.uint64)
        for at, d in enumerate(short.tolist()):
            value = np.full(1, np.uint64(lengths[d]))
            for i in range(words.first[d], words.last[d]):
                value = mixed(value * _STEP + hashes[i])
            alone[at] = value[0]
        token, doc = np.concatenate((token, alone)), np.concatenate((doc, short))
    order = np.lexsort((token, doc))
    token, doc = token[order], doc[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    token, doc = token[new], doc[new]
    return token, np.searchsorted(doc, np.arange(len(texts) + 1))


def width_of(sizes: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps of sets of such sizes: the next power of two, 64 at least."""
    return 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64)


def hot_tokens(docs: DataFrame, shingle: int, text_col: str) -> np.ndarray:
    """Hashes, ascending, of tokens that many documents hold: ``HOT_TOKENS`` at most.

    Each task counts the tokens that come twice or more in a slice of its texts and
    sends the most frequent on. The join is exact whatever tokens are named here; naming the hot
    ones keeps documents that share nothing else apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                parts = slices(list(map(len, texts)), SET_CHARS)
                tokens = [token_sets(texts[a:b], shingle)[0] for a, b in parts]
                token, n = np.unique(np.concatenate(tokens), return_counts=True)
                both = np.concatenate((known, token[n > 1]))
                known, place = np.unique(both, return_inverse=True)
                seen = np.bincount(place, np.concatenate((seen, n[n > 1])), len(known)).astype(np.int64)
                if len(known) > 4 * HOT_TOKENS:
                    top = np.sort(np.argpartition(seen, -HOT_TOKENS)[-HOT_TOKENS:])
                    known, seen = known[top], seen[top]
        often = np.flatnonzero(seen >= 4)
        if len(often) > HOT_TOKENS:
            often = often[np.argpartition(seen[often], -HOT_TOKENS)[-HOT_TOKENS:]]
        yield pa.RecordBatch.from_pydict({"token": known[often].view(np.int64), "n": seen[often]})

    counted = docs.select(text_col).mapInArrow(run, "token long, n long").groupBy("token")
    total = counted.agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_FROM)
    top = total.orderBy(F.col("n").desc(), "token").limit(HOT_TOKENS)
    return np.sort(np.array([r.token for r in top.collect()], np.int64).view(np.uint64))


def with_sets(
    docs: DataFrame, shingle: int, percent: int, hot: np.ndarray, text_col: str
) -> DataFrame:
    """``docs`` with the set's size ``n``, its 128-bit name, bitmap and prefix, without the text.

    Two sets that are linked share a token of their prefixes: in an order of all tokens, hot ones
    last and else by hash, the first ``n - ceil(percent * n / 100) + 1``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def compute(texts: list[str]) -> dict[str, Sequence]:
        hot = shared.value
        token, first = token_sets(texts, shingle)
        sizes = np.diff(first)
        doc = np.repeat(np.arange(len(texts)), sizes)
        is_hot = np.isin(token, hot)
        order = np.argsort(2 * doc + is_hot, kind="stable")
        rank = np.arange(len(token)) - np.repeat(first[:-1], sizes)
        length = sizes + (-percent * sizes) // 100 + 1
        kept = order[rank < np.repeat(length, sizes)]
        ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, length, 0))))
        prefix = token[kept].view(np.int64)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(token * _STEP))))
        name = [(total[first[1:]] - total[first[:-1]]).view(np.int64)]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(token + _STEP))))
        name.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
        bitmaps = []
        for d, width in enumerate(width_of(sizes).tolist()):
            bits = np.zeros(width if sizes[d] else 0, bool)
            bits[(token[first[d] : first[d + 1]] & np.uint64(width - 1)).astype(np.int64)] = True
            bitmaps.append(np.packbits(bits, bitorder="little").tobytes())
        return {
            "n": sizes,
            "name1": name[0],
            "name2": name[1],
            "bitmap": bitmaps,
            "prefix": [prefix[a:b] for a, b in zip(ends, ends[1:], strict=False)],
        }

    added = {
        "n": (pa.int64(), "long"),
        "name1": (pa.int64(), "long"),
        "name2": (pa.int64(), "long"),
        "bitmap": (pa.binary(), "binary"),
        "prefix": (pa.list_(pa.int64()), "array<long>"),
    }
    keep = [c for c in docs.columns if c != text_col]
    return add_from_text(docs, compute, added, text_col=text_col, keep=keep, chars=SET_CHARS)


# Trees.


class SignatureTree:
    """Sets in order of size; a node has the OR of its sets' bitmaps and the range of their sizes.

    ``lost`` is, of a set, its number of tokens less that of its bits; of a node, the greatest
    of its sets'. So two sets below two nodes have no more tokens in common than the nodes have
    bits in common, plus the lesser ``lost``.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, height: int = 0):
        lost = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, lost)]
        while len(bits) > FAN or len(self.levels) <= height:
            cut = np.arange(0, len(bits), FAN)
            bits = np.bitwise_or.reduceat(bits, cut)
            _, low, high, lost = self.levels[-1]
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((bits, low, high, np.maximum.reduceat(lost, cut)))

    @property
    def height(self) -> int:
        return len(self.levels) - 1


def _may_link(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Can a set below node ``i`` be linked with one below node ``j``?"""
    low, high = np.minimum(a[1][i], b[1][j]), np.minimum(a[2][i], b[2][j])
    fits = 100 * high >= percent * np.maximum(a[1][i], b[1][j])
    i, j, high = i[fits], j[fits], high[fits]
    common = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1, dtype=np.int64)
    most = np.minimum(common + np.minimum(a[3][i], b[3][j]), high)
    need = percent * (a[1][i] + b[1][j])
    out = np.zeros(len(low), bool)
    out[np.flatnonzero(fits)] = (100 + percent) * most >= need
    return out


def linked_pairs(a: SignatureTree, b: SignatureTree, percent: int) -> Iterator[tuple]:
    """Pairs of sets that no bound keeps apart, by a traversal of both trees at once.

    With a tree and itself, each pair comes once. Where the bitmaps have a bit for every
    token, these are the linked pairs.
    """
    own = a is b
    if a.height != b.height:
        raise ValueError("trees of unequal height")
    n, m = len(a.levels[-1][0]), len(b.levels[-1][0])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(m), indexing="ij"))
    first = i <= j if a.height else i < j
    stack = [(a.height, i[first], j[first]) if own else (a.height, i, j)]
    child = np.arange(FAN)
    # wide bitmaps are compared a few pairs at a time
    most = max(1, min(_PAIRS, _PAIR_BYTES // max(1, a.levels[0][0][:1].nbytes)))
    while stack:
        level, i, j = stack.pop()
        if len(i) > most:
            stack.append((level, i[most:], j[most:]))
            i, j = i[:most], j[:most]
        good = _may_link(a.levels[level], b.levels[level], i, j, percent)
        i, j = i[good], j[good]
        if not len(i):
            continue
        if level == 0:
            yield i, j
            continue
        below = level - 1
        ci = np.broadcast_to((i[:, None] * FAN + child)[:, :, None], (len(i), FAN, FAN)).ravel()
        cj = np.broadcast_to((j[:, None] * FAN + child)[:, None, :], (len(j), FAN, FAN)).ravel()
        there = (ci < len(a.levels[below][0])) & (cj < len(b.levels[below][0]))
        if own:
            there &= ci <= cj if below else ci < cj
        stack.append((below, ci[there], cj[there]))


def _labels(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest number connected with each of ``n`` numbers."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            least = np.minimum(label[i], label[j])
            if (label[i] == least).all() and (label[j] == least).all():
                break
            np.minimum.at(label, label[i], least)
            np.minimum.at(label, label[j], least)
            while (label != label[label]).any():
                label = label[label]
    return label


def _folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of equal width as rows of 64-bit words, halves combined until ``width`` is reached."""
    bits = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1)
    while bits.shape[1] * 64 > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def candidate_labels(
    sizes: np.ndarray, bitmaps: list[bytes], part: np.ndarray, percent: int
) -> np.ndarray:
    """Labels by candidate links among sets in order of size: of one part, or between two.

    Sets whose bitmaps have one width make a tree; linked ones differ in width by a step at most.
    """
    widths = width_of(sizes)
    sides = [np.flatnonzero(part == p) for p in np.unique(part)]
    two = len(sides) == 2

    def tree(rows: np.ndarray, width: int, height: int = 0) -> SignatureTree:
        return SignatureTree(_folded([bitmaps[r] for r in rows], width), sizes[rows], height)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for width in np.unique(widths).tolist():
            for upper in (width, 2 * width):
                for left, right in ((0, 1), (1, 0)) if two else ((0, 0),):
                    x = sides[left][widths[sides[left]] == width]
                    y = sides[right][widths[sides[right]] == upper]
                    if not len(x) or not len(y) or (two and upper == width and left):
                        continue
                    a = tree(x, width)
                    if not two and upper == width:
                        found = linked_pairs(a, a, percent)
                    else:
                        b = tree(y, width, a.height)
                        if b.height > a.height:
                            a = tree(x, width, b.height)
                        found = linked_pairs(a, b, percent)
                    for i, j in found:
                        yield x[i], y[j]

    return _labels(len(sizes), pairs())


def exact_labels(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Labels by links among sets of hashes, in trees whose bitmaps have a bit for every token.

    A token of one set alone is in no overlap and has no bit, so nothing is ``lost``.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.argsort(sizes, kind="stable")
    token, place, n = np.unique(
        np.concatenate([sets[o] for o in order]), return_inverse=True, return_counts=True
    )
    number = np.cumsum(n > 1) - 1
    width = -(-max(1, int((n > 1).sum())) // 64) * 64
    packed, start = np.empty((len(sets), width // 8), np.uint8), 0
    for row, o in enumerate(order):
        own = place[start : start + sizes[o]]
        bits = np.zeros(width, bool)
        bits[number[own[n[own] > 1]]] = True
        packed[row] = np.packbits(bits)
        start += sizes[o]
    tree = SignatureTree(packed.view(np.uint64), sizes[order])
    tree.levels = [(b, low, high, np.zeros_like(low)) for b, low, high, _ in tree.levels]
    pairs = ((order[i], order[j]) for i, j in linked_pairs(tree, tree, percent))
    return _labels(len(sets), pairs)


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each group, from batches in order of their first ``n_keys`` columns (longs)."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        keys = [batch.column(k).to_numpy() for k in range(n_keys)]
        new = np.zeros(batch.num_rows, bool)
        new[:1] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(new).tolist()
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)
        rest = batch.slice(starts[-1]) if starts else rest
    if rest is not None and rest.num_rows:
        yield rest


def _candidates(members: DataFrame, percent: int) -> DataFrame:
    """``a, b``: of each group's sets that candidate links connect, the first with every other one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            part, n, ids = (group.column(k).to_numpy() for k in (4, 5, 6))
            label = candidate_labels(n, group.column(7).to_pylist(), part, percent)
            other = np.flatnonzero(label != np.arange(len(ids)))
            if len(other):
                yield pa.RecordBatch.from_pydict({"a": ids[label[other]], "b": ids[other]})

    return members.mapInArrow(run, "a long, b long").distinct()


def _links(families: DataFrame, percent: int) -> DataFrame:
    """``a, b``: of each group's sets that links connect, the first with every other one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            ids = group.column(3).to_numpy()
            sets = [np.frombuffer(t, np.uint64) for t in group.column(4).to_pylist()]
            label = exact_labels(sets, percent)
            other = np.flatnonzero(label != np.arange(len(ids)))
            if len(other):
                yield pa.RecordBatch.from_pydict({"a": ids[label[other]], "b": ids[other]})

    return families.mapInArrow(run, "a long, b long").distinct()


def _in_parts(rows: DataFrame, group: Sequence[str], percent: int) -> DataFrame:
    """Rows ``n, id`` of groups, with ``a, b, part``: a group's parts of ``CHUNK`` sets, two by two.

    The parts go by size; ``a`` and ``b`` meet where the ranges of their sizes let them, and each
    part meets itself. Small groups have one part.
    """
    by_size = Window.partitionBy(*group).orderBy("n", "id")
    place = F.floor((F.row_number().over(by_size) - 1) / CHUNK)
    rows = rows.withColumns({"part": place, "_size": F.count("*").over(Window.partitionBy(*group))})
    zero = F.lit(0).cast("long")
    columns = [*group, "a", "b", "part", "n", "id"]
    small = rows.where(F.col("_size") <= CHUNK).withColumns({"a": zero, "b": zero})
    large = rows.where(F.col("_size") > CHUNK)
    parts = large.groupBy(*group, "part").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    left = parts.select(*group, F.col("part").alias("a"), F.col("high").alias("a_high"))
    right = parts.select(*group, F.col("part").alias("b"), F.col("low").alias("b_low"))
    meet = (
        left.join(right, list(group))
        .where((F.col("a") <= F.col("b")) & (F.col("b_low") * percent <= F.col("a_high") * 100))
        .select(*group, "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("part"))
    )
    dealt = large.join(meet, [*group, "part"])
    return small.select(*columns).unionByName(dealt.select(*columns))


def _meeting(sets: DataFrame, percent: int) -> DataFrame:
    """``size, mark, a, b, part, n, id``: sets that share a prefix token, by groups of such.

    Tokens held by the same sets make one group, named by its size and the XOR of its sets'
    hashes. A set stays if another of the group is near enough in size.
    """
    by_token = Window.partitionBy("token")
    held = sets.select(F.explode("prefix").alias("token"), "id", "n").withColumns(
        {
            "size": F.count("*").over(by_token),
            "mark": F.bit_xor(F.xxhash64("id")).over(by_token),
        }
    )
    rows = held.where("size > 1").select("size", "mark", "id", "n").distinct()
    by_size = Window.partitionBy("size", "mark").orderBy("n", "id")
    near = (F.lag("n").over(by_size) * 100 >= F.col("n") * percent) | (
        F.lead("n").over(by_size) * percent <= F.col("n") * 100
    )
    rows = rows.withColumn("near", near).where("near").drop("near")
    return _in_parts(rows, ["size", "mark"], percent)


def jaccard_classes(
    docs: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Two documents are linked where ``100 * common >= percent * united`` of their sets of distinct
    word shingles (words between spaces and U+0009 to U+000D, A-Z lower-cased; fewer words make one
    token). ``component_id`` is the smallest id that links connect. Documents without a word
    are linked with nothing and keep their id; so do null ids there. Null ids take part otherwise,
    but give no id. Repeated rows come back as often as they came.

    1. Equal sets become one. Linked sets share a token of their prefixes (``with_sets``), so they
       meet in the groups of such tokens.
    2. In each group a signature tree, of bitmaps with one or two bits for each token, is
       traversed against itself; node pairs are pruned by their greatest possible overlap. What
       is left connects families of candidates, mostly true ones; a set is in one at most.
    3. Only these get their tokens, from the whole texts again. Trees with a bit for every token
       give the links, which alternating stars turn into components.

    No step lists all pairs of a group, and no task holds more than two parts of ``CHUNK`` sets.
    Tokens are compared by 64-bit hashes.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
    )
    hot = hot_tokens(keyed, shingle, "text")
    rows = stored(with_sets(keyed, shingle, percent, hot, "text"), "jaccard-rows")
    name = ["name1", "name2", "n"]
    first = F.min(F.struct("key", "bitmap", "prefix")).alias("first")
    least = F.min("doc_id").alias("first_id")
    sets = rows.where("n > 0").groupBy(*name).agg(first, least)
    sets = sets.select(*name, "first.*", "first_id")
    sets = stored(sets.withColumn("id", F.monotonically_increasing_id()), "jaccard-sets")

    members = _meeting(sets.select("id", "n", "prefix"), percent)
    by_group = ["size", "mark", "a", "b"]
    with_bits = members.join(sets.select("id", "bitmap"), "id").select(
        *by_group, "part", "n", "id", "bitmap"
    )
    grouped = with_bits.repartition(*by_group).sortWithinPartitions(*by_group, "n", "id")
    candidates = stored(_candidates(grouped, percent), "jaccard-candidates")

    families = components(candidates).select(
        F.col("node").alias("id"), F.col("component").alias("family")
    )
    families = stored(families.join(sets.select("id", "n", "key"), "id"), "jaccard-families")
    tokens = add_from_text(
        rows_wanted(keyed, families.select("key", "id"), "key"),
        lambda texts: {"tokens": _as_bytes(*token_sets(texts, shingle))},
        {"tokens": (pa.binary(), "binary")},
        keep=["id"],
        chars=SET_CHARS,
    )
    tokens = tokens.groupBy("id").agg(F.first("tokens").alias("tokens"))  # of equal rows
    by_family = ["family", "a", "b"]
    parts = _in_parts(families.select("family", "n", "id"), ["family"], percent)
    whole = parts.join(tokens, "id").select(*by_family, "id", "tokens")
    whole = whole.repartition(*by_family).sortWithinPartitions(*by_family, "id")
    links = stored(_links(whole, percent), "jaccard-links")

    linked = components(links).withColumnRenamed("node", "id")
    classes = sets.select(*name, "id", "first_id").join(linked, "id", "left")
    classes = classes.withColumn("component", F.coalesce("component", "id"))
    ids = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = classes.join(ids, "component").select(*name, "component_id")
    return _with_class(rows, named, name)


def _as_bytes(token: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [token[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]


def _with_class(rows: DataFrame, named: DataFrame, name: Sequence[str]) -> DataFrame:
    out: list[Column] = [F.col("doc_id"), F.col("n").alias("n_shingles")]
    empty = rows.where("n = 0").select(*out, F.col("doc_id").alias("component_id"))
    full = rows.where("n > 0").select("doc_id", *name).join(named, list(name))
    return full.select(*out, "component_id").unionByName(empty)
