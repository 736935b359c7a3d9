"""Texts of an Arrow batch as one array of code points, for operators that work on whole batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code points handled at once: bounds a task's memory, as hashing words alone takes some 50 bytes for
# each; a longer text is a slice of its own.
SLICE_CHARS = 1 << 19

_POWERS = 1 << 18  # powers are added by so many
_RATIO = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def slices(lengths: Sequence[int], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts, given their lengths, with about ``chars`` characters each."""
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(lengths):
        yield start, len(lengths)


def text_slices(column: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of a column of texts and their texts, null ones as empty; one range at a time."""
    lengths = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    for start, end in slices(lengths, chars):
        yield start, end, [text or "" for text in column.slice(start, end - start).to_pylist()]


class Points:
    """Code points of texts laid end to end, each text closed by a line feed of our own.

    ``starts`` and ``ends`` give each text's range without that line feed.
    """

    def __init__(self, texts: Sequence[str]):
        joined = "\n".join(texts) + "\n"
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def runs(self, inside: np.ndarray) -> Runs:
        """Maximal runs of true positions; false at every text's end, so none crosses it."""
        inside = inside.copy()
        inside[self.ends] = False
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate(([0], edge))
        return Runs(self, edge[0::2], edge[1::2])

    def words(self) -> Runs:
        """Runs of anything but the space and U+0009 to U+000D."""
        codes = self.codes
        return self.runs((codes != 32) & ((codes < 9) | (codes > 13)))

    def alphanumeric(self) -> Runs:
        """Runs of letters and digits."""
        return self.runs(tables()[0][self.codes])

    def lowered(self) -> np.ndarray:
        return tables()[1][self.codes]


class Runs:
    """Words of several texts; ``first`` and ``last`` give each text's range of words."""

    def __init__(self, points: Points, starts: np.ndarray, ends: np.ndarray):
        self.starts, self.ends = starts, ends
        self.first = np.searchsorted(starts, points.starts)
        self.last = np.searchsorted(starts, points.ends)
        self.doc = np.repeat(np.arange(len(points.starts)), self.last - self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        """64-bit hashes of the words' code points, equal for equal words in any batch."""
        powers, inverse = _powers(len(codes))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers[: len(codes)])))
        return mixed((total[self.ends] - total[self.starts]) * inverse[self.starts])


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


_cache: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _cache or len(_cache[0][0]) < n:
        size = -(-n // _POWERS) * _POWERS
        _cache[:] = [
            tuple(
                np.cumprod(np.full(size, ratio, np.uint64))
                for ratio in (_RATIO, pow(_RATIO, -1, 1 << 64))
            )
        ]
    return _cache[0]


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Is a code point a letter or digit; its lower case, where that is one code point."""
    size = 0x110000
    known = np.zeros(size, bool)
    lower = np.arange(size, dtype=np.uint32)
    for code in range(0x20000):  # beyond lie only ideographs, marks and private use
        char = chr(code)
        known[code] = char.isalnum()
        if len(low := char.lower()) == 1:
            lower[code] = ord(low)
    known[0x20000:0x323B0] = True
    return known, lower


def per_text(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each range; 0 over an empty one."""
    total = np.concatenate((np.zeros(1), np.cumsum(values, dtype=np.float64)))
    n = len(values)
    return total[np.minimum(last, n)] - total[np.minimum(first, n)]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def add_from_text(
    docs: DataFrame,
    compute: Callable[[list[str]], Mapping[str, Sequence]],
    added: Mapping[str, tuple[pa.DataType, str]],
    *,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    chars: int = SLICE_CHARS,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) and the columns that ``compute`` derives from the texts.

    ``compute`` gets a slice of an Arrow batch of about ``chars`` characters, null texts as empty
    ones, and returns a value per text under each name of ``added`` (Arrow type, Spark type). Rows
    stay as they are.
    """
    if clash := set(added) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are there already; give other names")
    keep = list(docs.columns if keep is None else keep)
    source = docs.select(*(docs[c] for c in dict.fromkeys([*keep, text_col])))
    at = source.columns.index(text_col)
    types = {name: kind for name, (kind, _) in added.items()}
    schema = T.StructType([source.schema[c] for c in keep])
    for name, (_, ddl) in added.items():
        schema.add(name, T.DataType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in text_slices(batch.column(at), chars):
                found = compute(texts)
                columns = batch.slice(start, end - start).columns[: len(keep)]
                columns += [pa.array(found[name], kind) for name, kind in types.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *types])

    return source.mapInArrow(run, schema)
