"""Periodic runs of words, by catchers of squares over completed power-of-two blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from layerflow.llm.text import add_from_text, mixed

_STEP = np.uint64(0xD6E8FEB86659FD93)
_SEPARATOR = 1 << 40  # ids from here on are unlike any word's


class SquareCatcher:
    """Runs in a growing stream of ids.

    For ``m = 1, 2, 4, ...`` each completed block of ``m`` ids at a multiple of ``m`` is a catcher.
    It waits for squares of a period from ``2 * m`` to ``4 * m - 1`` (and 1, where ``m`` is 1) whose
    first half holds it, and each of these holds one. So an appended id gives for each ``m``
    two suffix comparisons: the last ``m`` ids with the only two blocks that lie at such a
    distance. A match is extended to both sides by hashes of 1, 2, 4, ... ids; where it reaches the
    end of the stream it stays open, and the ids appended next extend it further. Extensions
    of one run meet in the same ends, among which the smallest period is the run's.

    ``append`` takes any number of ids, and the runs do not depend on how the stream is cut. Work
    per id grows with the logarithm of ``longest``, above which there is no run: the length of
    the stream, unless separators bound it. Blocks are compared by 64-bit hashes.
    """

    def __init__(self, min_length: int = 6, min_exponent: int = 4, longest: int | None = None):
        if min_exponent < 2:
            raise ValueError("min_exponent must be 2 or more")
        self.min_length, self.min_exponent, self.longest = min_length, min_exponent, longest
        self.n = 0
        self._hashes = [np.empty(0, np.uint64)]  # [k][i]: of the 2**k ids from i on
        none = np.empty(0, np.int64)
        self._open = (none, none)  # start and period of matches that reach the end
        self._found: list[np.ndarray] = []

    def _grow(self, ids: np.ndarray) -> None:
        total = self.n + len(ids)
        bound = min(total, self.longest or total)
        while 1 << len(self._hashes) <= bound:
            self._hashes.append(np.empty(0, np.uint64))
        if len(self._hashes[0]) < total:
            room = max(total, 2 * self.n)
            for k, old in enumerate(self._hashes):
                self._hashes[k] = np.empty(room, np.uint64)
                self._hashes[k][: len(old)] = old
        self._hashes[0][self.n : total] = mixed(ids.astype(np.uint64) + _STEP)
        for k in range(1, len(self._hashes)):
            half, h = 1 << (k - 1), self._hashes[k - 1]
            if len(self._hashes[k]) < len(h):
                self._hashes[k] = np.empty(len(h), np.uint64)
            first, end = max(0, self.n - 2 * half + 1), total - 2 * half + 1
            if k >= self._complete:
                first = 0
            if end > first:
                both = h[first:end] * _STEP + h[first + half : end + half]
                self._hashes[k][first:end] = mixed(both + np.uint64(k))
        self._complete = len(self._hashes)
        self.n = total

    _complete = 1  # levels that hold hashes for all that was appended before

    def _forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many ids from ``i`` and from ``j`` (the greater) on are the same."""
        at = j.copy()
        for k in range(len(self._hashes) - 1, -1, -1):
            size, h = 1 << k, self._hashes[k]
            fits = np.flatnonzero(at + size <= self.n)
            x = at[fits]
            at[fits[h[x] == h[x - j[fits] + i[fits]]]] += size
        return at - j

    def _backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many ids before ``i`` (the lesser) and before ``j`` are the same."""
        at = i.copy()
        for k in range(len(self._hashes) - 1, -1, -1):
            size, h = 1 << k, self._hashes[k]
            fits = np.flatnonzero(at >= size)
            x = at[fits] - size
            at[fits[h[x] == h[x - i[fits] + j[fits]]]] -= size
        return i - at

    def append(self, ids: np.ndarray) -> None:
        if not len(ids):
            return
        old = self.n
        self._grow(ids)
        starts, periods = self._open
        ends = old + self._forward(np.full(len(periods), old) - periods, np.full(len(periods), old))
        found = [np.stack((starts, periods, ends))]
        blocks, suffixes, sizes = [], [], []
        for k, h in enumerate(self._hashes):
            m = 1 << k
            if self.longest and 2 * m * self.min_exponent > max(self.longest, 8):
                break
            x = np.arange(max(0, old - m + 1), self.n - m + 1)
            for back in (2, 3, 1)[: 3 if m == 1 else 2]:
                block = (x // m - back) * m
                fits = np.searchsorted(x, back * m)  # blocks before the stream are none
                same = fits + np.flatnonzero(h[block[fits:]] == h[x[fits:]])
                blocks.append(block[same])
                suffixes.append(x[same])
                sizes.append(np.full(len(same), m))
        a, x, m = (np.concatenate(parts) for parts in (blocks, suffixes, sizes))
        starts, ends = a - self._backward(a, x), x + m + self._forward(a + m, x + m)
        found.append(np.stack((starts, x - a, ends)))
        starts, periods, ends = np.concatenate(found, axis=1)
        at_end = ends == self.n
        # all matches of one period that reach the end are one
        open_periods, first = np.unique(periods[at_end], return_index=True)
        self._open = (starts[at_end][first], open_periods)
        self._found.append(self._smallest(starts, periods, ends, ~at_end))

    def _smallest(self, starts, periods, ends, which=True) -> np.ndarray:
        """Starts, periods and ends of those long enough, with the smallest period for any two ends."""
        length = ends - starts
        good = which & (length >= self.min_exponent * periods) & (length >= self.min_length)
        rows = np.stack((starts, periods, ends))[:, good]
        rows = rows[:, np.lexsort((rows[1], rows[2], rows[0]))]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[2, 1:] != rows[2, :-1])
        return rows[:, new]

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of all runs so far, by start, then period."""
        starts, periods = self._open
        still = np.stack((starts, periods, np.full(len(starts), self.n)))
        rows = self._smallest(*np.concatenate([*self._found, still], axis=1))
        runs = ((start, end - start, q) for start, q, end in rows.T.tolist())
        return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_texts(
    words: Sequence[Sequence[bytes]], min_length: int = 6, min_exponent: int = 4
) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs, all lists passing one catcher, with separators between."""
    known: dict[bytes, int] = {}
    ids = [known.setdefault(w, len(known)) for ws in words for w in ws]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    firsts = np.cumsum(lengths + 1) - lengths - 1
    stream = np.empty(len(ids) + len(words), np.int64)
    is_word = np.ones(len(stream), bool)
    is_word[firsts + lengths] = False
    stream[is_word] = ids
    # each separator occurs once, so no run holds one
    stream[~is_word] = _SEPARATOR + np.arange(len(words))
    catcher = SquareCatcher(min_length, min_exponent, longest=int(lengths.max(initial=0)) + 1)
    catcher.append(stream)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, length, period in catcher.runs():
        doc = int(np.searchsorted(firsts, start, "right")) - 1
        out[doc].append((start - int(firsts[doc]), length, period))
    return out


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, each run cut to its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(
    docs: DataFrame,
    *,
    min_length: int = 6,
    min_exponent: int = 4,
    text_col: str = "text",
    runs_col: str = "runs",
    collapsed_col: str = "collapsed",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with each whole text's periodic runs and the text without them.

    Words are separated by the space and U+0009 to U+000D. A run is a maximal stretch of words
    with smallest period ``q`` that is ``min_length`` and ``min_exponent * q`` words long at least;
    runs come by start, then period. The collapsed text lacks every word that some run holds
    after that run's first ``q`` words, and is joined by single spaces. Null, empty and blank
    texts have no runs and collapse to an empty text. Rows stay as they are, repeated ones too;
    a column that has one of the new names already is refused.
    """

    def compute(texts: list[str]) -> dict[str, list]:
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        found = runs_of_texts(words, min_length, min_exponent)
        names = ("start", "length", "period")
        return {
            runs_col: [[dict(zip(names, r, strict=True)) for r in runs] for runs in found],
            collapsed_col: [
                collapsed(ws, runs).decode("utf-8", "surrogatepass")
                for ws, runs in zip(words, found, strict=True)
            ],
        }

    added = {
        runs_col: (pa.list_(RUN), "array<struct<start:long,length:long,period:long>>"),
        collapsed_col: (pa.string(), "string"),
    }
    return add_from_text(docs, compute, added, text_col=text_col, keep=keep)
