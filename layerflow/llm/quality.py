"""Quality rules: exact text counts, and a calibrated n-gram classifier with a fixed threshold."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from layerflow.llm.text import Points, Runs, add_from_text, mixed, per_text
from layerflow.llm.training import (
    SparseRows,
    fit_logistic,
    fit_sparse_logistic,
    labelled_sample,
    sigmoid,
)

SYMBOLS = np.frombuffer("#*$%&|<>".encode("utf-32-le"), np.uint32)
WINDOW = 8
BUCKET_BITS = 16
KINDS = 4  # character 2-grams and 3-grams, words, word pairs
SCALE = 20.0  # of the share that an n-gram has in its text; sets how far one step of the fit goes
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
BLANK = " \t\n\v\f\r"


@dataclass(frozen=True)
class QualityModel:
    """Weights by bucket, intercept, and the calibration of the margin to a probability.

    ``keep_at`` is fixed: a text is kept when its probability of good quality is at least that.
    """

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float
    keep_at: float = 0.5

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (margin + self.intercept) + self.offset)


def _grams(points: Points, words: Runs) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind: bucket of every n-gram, and each text's range of n-grams."""
    codes = points.codes
    shift = np.uint32(32 - BUCKET_BITS)
    two = codes[:-1] * _ODD[0] + codes[1:] * _ODD[1]
    yield two >> shift, points.starts, np.maximum(points.starts, points.ends - 1)
    three = two[:-1] + codes[2:] * _ODD[2]
    yield three >> shift, points.starts, np.maximum(points.starts, points.ends - 2)
    hashes = words.hashes(codes)
    shift = np.uint64(64 - BUCKET_BITS)
    yield hashes >> shift, words.first, words.last
    pairs = mixed(hashes[:-1] * _PAIR + hashes[1:])
    pairs[hashes[:-1] == hashes[1:]] = 0  # a word said twice, whatever the word
    yield pairs >> shift, words.first, np.maximum(words.first, words.last - 1)


def margins(points: Points, words: Runs, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(points.starts))
    for kind, (buckets, first, last) in enumerate(_grams(points, words)):
        own = weights[kind << BUCKET_BITS : (kind + 1) << BUCKET_BITS]
        total += per_text(own[buckets], first, last) * SCALE / np.maximum(1, last - first)
    return total


def sparse_row(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of one text, as ``margins`` weighs them."""
    points = Points([text])
    columns, values = [], []
    for kind, (buckets, first, last) in enumerate(_grams(points, points.words())):
        found, n = np.unique(buckets[first[0] : last[0]], return_counts=True)
        columns.append(found.astype(np.int64) + (kind << BUCKET_BITS))
        values.append(n * SCALE / max(1, last[0] - first[0]))
    return np.concatenate(columns), np.concatenate(values)


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 2000) -> QualityModel | None:
    """Fit on at most ``max_rows`` labelled documents, a quarter of which calibrates the margin.

    Without both labels there is nothing to learn: None.
    """
    sample = labelled_sample(docs, labels, "quality", max_rows).orderBy("doc_id").toPandas()
    y = sample["label"].to_numpy(float)
    if len(set(y)) < 2:
        return None
    rows = [sparse_row(text) for text in sample["text"]]
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    width = KINDS << BUCKET_BITS
    fit = SparseRows([r for r, h in zip(rows, held, strict=True) if not h], width)
    weights, intercept = fit_sparse_logistic(fit, y[~held], l2=1e-5)
    check = held if held.any() else ~held
    margin = SparseRows([r for r, c in zip(rows, check, strict=True) if c], width).times(weights)
    slope, offset = fit_logistic((margin + intercept)[:, None], y[check], l2=1e-2)
    return QualityModel(weights.astype(np.float32), intercept, float(slope), float(offset))


def duplicate_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that occur twice or more, the first occurrence included."""
    first: dict[tuple, int] = {}
    inside = bytearray(len(words))
    for i in range(len(words) - WINDOW + 1):
        window = tuple(words[i : i + WINDOW])
        earlier = first.setdefault(window, i)
        if earlier < i:
            inside[i : i + WINDOW] = b"\1" * WINDOW
            inside[earlier : earlier + WINDOW] = b"\1" * WINDOW
    return sum(inside)


def _may_repeat(words: Runs, hashes: np.ndarray) -> np.ndarray:
    """Texts with two windows of equal hash; every text with a repeated window is among them."""
    if len(words) < WINDOW:
        return np.zeros(0, np.int64)
    n = len(words) - WINDOW + 1
    window = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        window = window * _PAIR + hashes[j : j + n]
    whole = words.doc[:n] == words.doc[WINDOW - 1 :]
    doc = words.doc[:n][whole]
    window = mixed(window[whole] + doc.astype(np.uint64) * _PAIR)
    order = np.argsort(window)
    ordered = window[order]
    return np.unique(doc[order[1:][ordered[1:] == ordered[:-1]]])


def measure(texts: list[str], model: QualityModel | None) -> dict[str, np.ndarray]:
    """The columns that ``quality_rules`` adds, for some texts."""
    points = Points(texts)
    words = points.words()
    n_words = words.last - words.first
    lengths = words.ends - words.starts
    hashes = words.hashes(points.codes)
    repeats = np.zeros(len(texts), np.int64)
    for i in _may_repeat(words, hashes):
        repeats[i] = repeated_words(texts[i].encode("utf-8", "surrogatepass").split())
    failed = (n_words < 20) | (100 * repeats > 30 * n_words)
    if model is None:
        good = np.ones(len(texts))
    else:
        good = model.probability(margins(points, words, model.weights))
    return {
        "n_words": n_words,
        "word_chars": per_text(lengths, words.first, words.last).astype(np.int64),
        "n_symbols": per_text(np.isin(points.codes, SYMBOLS), points.starts, points.ends).astype(
            np.int64
        ),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": ~failed & (good >= (model.keep_at if model else 0)),
        "quality": good,
    }


COLUMNS = {
    "n_words": (pa.int64(), "long"),
    "word_chars": (pa.int64(), "long"),
    "n_symbols": (pa.int64(), "long"),
    "n_dup_lines": (pa.int64(), "long"),
    "n_repeat_words": (pa.int64(), "long"),
    "base_failed": (pa.bool_(), "boolean"),
    "kept": (pa.bool_(), "boolean"),
    "quality": (pa.float64(), "double"),
}


def quality_rules(
    docs: DataFrame,
    model: QualityModel | None,
    *,
    text_col: str = "text",
    prefix: str = "",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with counts of each whole text, the base verdict, the probability and the verdict.

    Words are runs of anything but the space and U+0009 to U+000D. Null and empty texts have no
    words and fail the base. Without a model the base verdict is the verdict. Rows come back as
    often as they came, with their own columns or those in ``keep``. The added columns are
    those of ``COLUMNS``, named with ``prefix``, which must not clash with columns of ``docs``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str]) -> dict[str, np.ndarray]:
        return {prefix + name: values for name, values in measure(texts, shared.value).items()}

    added = {prefix + name: kinds for name, kinds in COLUMNS.items()}
    return add_from_text(docs, compute, added, text_col=text_col, keep=keep)


def keep_good(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns."""
    scored = quality_rules(docs, model, prefix="__lf_")
    return scored.where("__lf_kept").select(*docs.columns)

