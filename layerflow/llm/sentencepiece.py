"""SentencePiece encoding over a relational lattice of words, and decoding."""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.llm.text import add_from_text, let, text_slices
from layerflow.llm.training import stored

SPACE = "▁"  # stands for a space inside pieces
TOKENIZERS = "/opt/tokenizers"
MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
# Words that the lattice encodes for the shared dictionary: the most frequent ones, so its size
# is bounded whatever the corpus; longer and rarer words are encoded in the batch.
DICTIONARY_WORDS = 1 << 18
LONGEST_WORD = 24
SCANNED = 100  # letters of a word up to which the best merge is looked for among all pairs
# Characters whose words are counted before the counts go to the shuffle; bounds a task's memory.
COUNTED_CHARS = 1 << 22


@dataclass(frozen=True)
class Pieces:
    """A model's vocabulary: piece texts by id, scores, byte pieces, and how its pieces join."""

    text: tuple[str, ...]
    score: list[float]
    merges: bool  # a BPE model: scores rank merges; else a unigram model: scores add up
    usable: dict[str, int]  # pieces that text may be cut into
    byte_ids: dict[int, int]
    unknown: int
    rough: tuple[str, ...] = field(default=())  # pairs of letters that a piece joins across a cut

    @cached_property
    def ranks(self) -> dict[str, float]:
        """Of pieces that a merge can make: the lower, the sooner."""
        return {piece: -self.score[n] for piece, n in self.usable.items() if len(piece) > 1}

    @property
    def byte_pairs(self) -> tuple[tuple[int, int], ...]:
        return tuple(sorted(self.byte_ids.items()))

    @property
    def longest(self) -> int:
        return max(map(len, self.usable))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(piece, n, self.score[n]) for piece, n in self.usable.items()]
        return spark.createDataFrame(rows, "piece string, id int, score double")


@lru_cache(maxsize=4)
def load_pieces(model_file: str = MODEL) -> Pieces:
    """Read a model file. Pieces must not hold a space mark after their first other letter."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    processor = SentencePieceProcessor(model_file=model_file)
    with open(model_file, "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    kind = proto.trainer_spec.model_type
    n = processor.vocab_size()
    text = [processor.id_to_piece(i) for i in range(n)]
    special = [
        processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) for i in range(n)
    ]
    usable = {text[i]: i for i in range(n) if not special[i]}
    if any(SPACE in piece.lstrip(SPACE) for piece in usable):
        raise ValueError("pieces that span words are not supported")
    rough = {a + b for piece in usable for a, b in zip(piece, piece[1:]) if _cut_between(a, b)}
    return Pieces(
        text=tuple(text),
        score=[processor.get_score(i) for i in range(n)],
        merges=kind == proto.trainer_spec.BPE,
        usable=usable,
        byte_ids={int(text[i][3:5], 16): i for i in range(n) if processor.is_byte(i)},
        unknown=processor.unk_id(),
        rough=tuple(sorted(rough)),
    )


# --- words ------------------------------------------------------------------------------

# Runs of ASCII marks, digits and controls are cut from runs of everything else. No piece joins
# the two but for those in ``rough``; texts with such a pair are cut at spaces only.
_FINE = re.compile(rf"{SPACE}*(?:[\x00-\x40\x5b-\x60\x7b-\x7f]+|[^\x00-\x40\x5b-\x60\x7b-\x7f{SPACE}]+|$)")
_COARSE = re.compile(rf"{SPACE}*(?:[^{SPACE}]+|$)")


def _is_mark(letter: str) -> bool:
    return letter < "\x80" and not letter.isalpha()


def _cut_between(a: str, b: str) -> bool:
    return SPACE not in (a, b) and _is_mark(a) != _is_mark(b)


def words_of(text: str, rough: Sequence[str] = ()) -> list[str]:
    """The words of a text with spaces marked; joined they give that text again.

    A model that adds a mark in front and keeps all spaces is assumed; pieces never cross the
    words' borders, so words can be encoded one by one.
    """
    if not text:
        return []
    marked = SPACE + text.replace(" ", SPACE)
    pattern = _COARSE if any(pair in marked for pair in rough) else _FINE
    words = pattern.findall(marked)
    return words if words[-1] else words[:-1]


# --- the lattice ------------------------------------------------------------------------


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """``word, edges``: every piece that occurs in the word, as an edge from border to border.

    Substrings of bounded length are exploded and equi-joined to the piece table, which is as
    large as the vocabulary and therefore broadcast. Words must be distinct and have at most 61
    letters. Edges hold ``start, end, score, id``, the bits of their two borders, and the bits
    of the borders between them.
    """
    n = F.length("word")
    cut = words.select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    end = F.explode(
        F.sequence(F.col("start") + 1, F.least(F.col("start") + F.lit(longest), n))
    ).alias("end")
    cut = cut.select("word", "start", end).withColumn(
        "piece", F.substr("word", F.col("start") + 1, F.col("end") - F.col("start"))
    )
    first, last = _bit(F.col("start")), _bit(F.col("end"))
    edge = F.struct(
        "start", "end", "score", "id", (first + last).alias("ends"), (last - 2 * first).alias("inner")
    )
    found = cut.join(F.broadcast(pieces), "piece").select("word", edge.alias("edge"))
    grouped = found.groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    return words.join(grouped, "word", "left").select(
        "word", F.coalesce("edges", F.array().cast(grouped.schema["edges"].dataType)).alias("edges")
    )


def viterbi(word: Column, edges: Column) -> Column:
    """Borders of the best path by the sum of scores, as bits, folded over the word's positions.

    A letter without a piece is an edge of its own, with a score under every other. State: the
    best score and the borders up to each position so far.
    """
    state = F.array(F.struct(F.lit(0.0).alias("score"), _bit(F.lit(0)).alias("borders")))

    def step(best, end):
        arriving = F.filter(edges, lambda e: e["end"] == end)
        paths = F.transform(
            arriving,
            lambda e: F.struct(
                (best[e["start"]]["score"] + e["score"]).alias("score"),
                (best[e["start"]]["borders"] + _bit(end)).alias("borders"),
            ),
        )
        before = best[end - 1]
        alone = F.struct(
            (before["score"] - F.lit(1e6)).alias("score"),
            (before["borders"] + _bit(end)).alias("borders"),
        )
        single = F.exists(arriving, lambda e: e["start"] == end - 1)
        return F.array_append(
            best, F.array_max(F.when(single, paths).otherwise(F.array_append(paths, alone)))
        )

    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(word)), state, step), -1)["borders"]


def merged(word: Column, edges: Column) -> Column:
    """Borders after all merges of a BPE model, as bits, folded over as many steps as letters.

    State: the borders. An edge whose ends are borders with exactly one border between them is a
    merge that can be made; the best score goes first, then the leftmost.
    """
    n = F.length(word)

    def fold(longer):
        def step(borders, _):
            possible = F.filter(
                longer,
                lambda e: (borders.bitwiseAND(e["ends"]) == e["ends"])
                & (F.bit_count(borders.bitwiseAND(e["inner"])) == 1),
            )
            ranked = F.transform(
                possible,
                lambda e: F.struct(
                    e["score"].alias("score"), (-e["start"]).alias("left"), e["inner"].alias("inner")
                ),
            )
            gone = F.coalesce(F.array_max(ranked)["inner"], F.lit(0).cast("long"))
            return borders - borders.bitwiseAND(gone)

        # each merge takes one border away, and an edge is merged once at most
        steps = F.least(n - 1, F.size(longer))
        steps = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, _bit(n + 1) - 1, step)

    return let(F.filter(edges, lambda e: e["end"] - e["start"] > 1), fold)


def encode_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, ids`` of distinct words of at most 61 letters, by lattice and fold.

    A unigram model takes the Viterbi path; a BPE model, whose scores rank merges and do not add
    up, takes the merges. A letter without a piece gives its bytes, or the unknown id.
    """
    rows = lattice(words, pieces.table(words.sparkSession), pieces.longest)
    word, edges = F.col("word"), F.col("edges")
    byte_id = F.create_map(
        *(F.lit(x) for pair in sorted(pieces.byte_ids.items()) or [(0, 0)] for x in pair)
    )

    def bytes_of(letter):
        code = F.hex(F.encode(letter, "utf-8"))
        at = F.sequence(F.lit(0), F.floor(F.length(code) / 2).cast("int") - 1)
        each = F.transform(
            at, lambda j: byte_id[F.conv(F.substr(code, 2 * j + 1, F.lit(2)), 16, 10).cast("int")]
        )
        return each if pieces.byte_ids else F.array(F.lit(pieces.unknown))

    def ids(borders):
        used = F.filter(
            edges,
            lambda e: (borders.bitwiseAND(e["ends"]) == e["ends"])
            & (borders.bitwiseAND(e["inner"]) == 0),
        )

        def of(used):
            known = F.transform(used, lambda e: F.struct(e["start"], F.array(e["id"])))
            # letters that no piece covers
            loose = F.filter(
                F.sequence(F.lit(0), F.length(word) - 1),
                lambda i: ~F.exists(used, lambda e: (e["start"] <= i) & (i < e["end"])),
            )
            spelled = F.transform(
                loose, lambda i: F.struct(i.alias("start"), bytes_of(F.substr(word, i + 1, F.lit(1))))
            )
            every = F.sort_array(F.concat(known, spelled.cast("array<struct<start:int,col2:array<int>>>")))
            whole = F.size(used) == F.bit_count(borders) - 1
            return F.when(whole, F.transform(used, lambda e: e["id"])).otherwise(
                F.flatten(F.transform(every, lambda p: p["col2"]))
            )

        return let(used, of)

    cut = merged if pieces.merges else viterbi
    return rows.select("word", let(cut(word, edges), ids).alias("ids"))


# --- the same for one word, for words outside the dictionary -----------------------------------


def encode_word(word: str, pieces: Pieces) -> list[int]:
    """Lattice and fold of one word of any length; what ``encode_words`` gives."""
    borders = _merge_borders(word, pieces) if pieces.merges else _viterbi_borders(word, pieces)
    ids = []
    for start, end in zip(borders, borders[1:], strict=False):
        piece = word[start:end]
        if piece in pieces.usable:
            ids.append(pieces.usable[piece])
        elif pieces.byte_ids:
            ids.extend(pieces.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
        else:
            ids.append(pieces.unknown)
    return ids


def _merge_borders(word: str, pieces: Pieces) -> list[int]:
    if len(word) > SCANNED:
        return _merge_long(word, pieces)
    rank = pieces.ranks.get
    borders = list(range(len(word) + 1))
    never = float("inf")
    # rank of the merge of each symbol with the next
    pairs = [rank(word[i : i + 2], never) for i in range(len(word) - 1)]
    while pairs:
        best = min(pairs)
        if best == never:
            break
        i = pairs.index(best)
        del borders[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank(word[borders[i] : borders[i + 2]], never)
        if i:
            pairs[i - 1] = rank(word[borders[i - 1] : borders[i + 1]], never)
    return borders


def _merge_long(word: str, pieces: Pieces) -> list[int]:
    """The same with a heap, for words in which looking through all pairs would take long."""
    n, usable, score = len(word), pieces.usable, pieces.score
    follows, before = list(range(1, n + 2)), list(range(-1, n + 1))
    heap: list[tuple[float, int, int, int]] = []

    def offer(start: int) -> None:
        middle = follows[start]
        if middle < n:
            end = follows[middle]
            if (piece := usable.get(word[start:end])) is not None:
                heapq.heappush(heap, (-score[piece], start, middle, end))

    for start in range(n - 1):
        offer(start)
    gone = bytearray(n + 1)
    while heap:
        _, start, middle, end = heapq.heappop(heap)
        if gone[start] or gone[middle] or follows[start] != middle or follows[middle] != end:
            continue
        gone[middle] = 1
        follows[start], before[end] = end, start
        offer(start)
        if start:
            offer(before[start])
    return [i for i in range(n + 1) if not gone[i]]


def _viterbi_borders(word: str, pieces: Pieces) -> list[int]:
    n, longest = len(word), pieces.longest
    best = [(0.0, 0)] + [(float("-inf"), 0)] * n
    for end in range(1, n + 1):
        for start in range(max(0, end - longest), end):
            piece = pieces.usable.get(word[start:end])
            if piece is None and start < end - 1:
                continue
            gain = -1e6 if piece is None else pieces.score[piece]
            # of equal sums the one with the last border furthest on, as the greatest bits are there
            if best[start][0] + gain >= best[end][0]:
                best[end] = (best[start][0] + gain, start)
    borders = [n]
    while borders[-1]:
        borders.append(best[borders[-1]][1])
    return borders[::-1]


# --- texts ------------------------------------------------------------------------------


def _plain(text: str, rough: Sequence[str]) -> bool:
    """Do the parts between the text's spaces have one mark each, and fine words inside?"""
    return not (
        "  " in text
        or SPACE in text
        or text[:1] == " "
        or text[-1:] == " "
        or any(pair in text for pair in rough)
    )


def _count_words(texts: Sequence[str], rough: Sequence[str]) -> Counter[str]:
    parts: Counter[str] = Counter()
    counts: Counter[str] = Counter()
    for text in texts:
        if text and _plain(text, rough):
            parts.update(text.split(" "))
        else:
            counts.update(words_of(text, rough))
    for part, n in parts.items():  # each distinct part is cut once
        for word in _cut(part):
            counts[word] += n
    return counts


def _cut(part: str) -> Sequence[str]:
    """The words of a part between two spaces; letters, or letters and one mark, need no pattern."""
    if part.isalpha():
        return (SPACE + part,)
    if part[:-1].isalpha() and _is_mark(part[-1]):
        return SPACE + part[:-1], part[-1]
    return [word for word in _FINE.findall(SPACE + part) if word]


def word_counts(docs: DataFrame, pieces: Pieces, text_col: str = "text") -> DataFrame:
    """``word, n`` over all texts; counted per batch before anything is shuffled."""
    rough = pieces.rough

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0), COUNTED_CHARS):
                counts = _count_words(texts, rough)
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(counts.keys(), pa.string()),
                        "n": pa.array(counts.values(), pa.int64()),
                    }
                )

    partial = docs.select(text_col).mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(
    docs: DataFrame, pieces: Pieces, *, size: int = DICTIONARY_WORDS, text_col: str = "text"
) -> DataFrame:
    """``word, ids`` of the ``size`` or fewer most frequent words of at most 24 letters.

    The rank is not a sort of all words: a histogram over powers of the square root of two of
    the counts tells from which count on all words fit.
    """
    counts = stored(word_counts(docs, pieces, text_col), "words")
    counts = counts.where((F.length("word") <= LONGEST_WORD) & (F.length("word") > 0))
    level = F.floor(2 * F.log2("n")).cast("int")
    found = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in found:  # at most 2 * 63 levels
        total += row["count"]
        if total > size:
            break
        least = row["level"]
    if least is None:
        chosen = counts.orderBy(F.desc("n"), "word").limit(size)
    else:
        chosen = counts.where(level >= least)
    return encode_words(chosen.select("word"), pieces)


def encode(
    docs: DataFrame,
    pieces: Pieces | None = None,
    *,
    size: int = DICTIONARY_WORDS,
    text_col: str = "text",
    ids_col: str = "ids",
    keep: Sequence[str] | None = None,
    check_col: str | None = None,
) -> DataFrame:
    """``docs`` (or columns ``keep``) with the piece ids of each whole text.

    The corpus's frequent words are encoded once, by lattice and fold, into a dictionary of
    bounded size, which every task gets; other words go through the same lattice and fold in
    the batch. Null and empty texts have no ids. ``check_col`` adds whether decoding the ids
    gives the text again.
    """
    pieces = pieces or load_pieces()
    table = dictionary(docs, pieces, size=size, text_col=text_col).toArrow().combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast((_packed(table), pieces))
    del table

    def compute(texts: list[str]) -> dict[str, Sequence]:
        known, pieces = shared.value
        flat, offsets = encode_texts(texts, known, pieces)
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        values: dict[str, Sequence] = {ids_col: ids}
        if check_col:
            # decoded as one, compared text by text
            raw, at = _decoded_bytes(flat, offsets, pieces)
            values[check_col] = [
                raw[a:b].decode("utf-8", "replace").removeprefix(" ") == text
                for a, b, text in zip(at, at[1:], texts, strict=False)
            ]
        return values

    added = {ids_col: (pa.list_(pa.int32()), "array<int>")}
    if check_col:
        added[check_col] = (pa.bool_(), "boolean")
    return add_from_text(docs, compute, added, text_col=text_col, keep=keep)


def _packed(table: pa.Table) -> dict[str, bytes]:
    """The dictionary as words and the bytes of their ids."""
    if not table.num_rows:
        return {}
    lists = table["ids"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = (lists.offsets.to_numpy() * 4).tolist()
    raw = lists.values.to_numpy().astype("<i4").tobytes()
    words = table["word"].to_pylist()
    return {w: raw[a:b] for w, a, b in zip(words, offsets, offsets[1:], strict=False)}


# Parts of texts between spaces that a worker has put together from words; dropped when full.
CACHED_PARTS = 1 << 17
_parts: dict[str, bytes] = {}
_parts_of: list[object] = [None]


def encode_texts(
    texts: Sequence[str], known: dict[str, bytes], pieces: Pieces
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and each text's offset."""
    if _parts_of[0] is not known or len(_parts) > CACHED_PARTS:
        _parts.clear()
        _parts_of[0] = known
    rough = pieces.rough

    def word_ids(word: str) -> bytes:
        found = known.get(word)
        if found is None:
            found = array("i", encode_word(word, pieces)).tobytes()
        return found

    chunks: list[bytes] = []
    sizes = [0]
    for text in texts:
        if not text:
            sizes.append(0)
            continue
        if _plain(text, rough):
            found = []
            for part in text.split(" "):
                ids = _parts.get(part)
                if ids is None:
                    ids = _parts[part] = b"".join([word_ids(w) for w in _cut(part)])
                found.append(ids)
        else:
            found = [word_ids(w) for w in words_of(text, rough)]
        chunk = b"".join(found)
        chunks.append(chunk)
        sizes.append(len(chunk) // 4)
    return np.frombuffer(b"".join(chunks), "<i4"), np.cumsum(sizes)


def decode_ids(ids: Sequence[int], pieces: Pieces) -> str:
    """The text of some ids: byte pieces together as UTF-8, marks as spaces, the first one gone."""
    flat = np.asarray(ids, np.int64)
    raw, _ = _decoded_bytes(flat, np.array([0, len(flat)]), pieces)
    return raw.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def _bytes_of(texts: tuple[str, ...], byte_ids: tuple[tuple[int, int], ...]):
    table = [piece.replace(SPACE, " ").encode() for piece in texts]
    for byte, n in byte_ids:
        table[n] = bytes([byte])
    sizes = np.array([len(b) for b in table])
    return np.frombuffer(b"".join(table), np.uint8), np.cumsum(sizes) - sizes, sizes


def _decoded_bytes(flat: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> tuple[bytes, np.ndarray]:
    """UTF-8 of all pieces end to end, and where each text's bytes begin."""
    letters, starts, sizes = _bytes_of(pieces.text, pieces.byte_pairs)
    size = sizes[flat]
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    at = np.repeat(starts[flat] - ends[:-1], size) + np.arange(ends[-1])
    return letters[at].tobytes(), ends[offsets]


def decode(
    rows: DataFrame, pieces: Pieces | None = None, *, ids_col: str = "ids", text_col: str = "text"
) -> DataFrame:
    """``rows`` with the text of their ids; null ids give a null text, no ids an empty one.

    A mark in the original text comes back as a space, which is what the model makes of it.
    """
    pieces = pieces or load_pieces()
    shared = rows.sparkSession.sparkContext.broadcast(pieces)
    at = rows.columns.index(ids_col)
    schema = T.StructType([*rows.schema.fields]).add(text_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if ids is None else decode_ids(ids, shared.value)
                for ids in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col]
            )

    return rows.mapInArrow(run, schema)
