"""Labelled rows to fit a model on, and the fits that several operators share."""

from __future__ import annotations

import importlib
import io
import math
import os
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.sinks import stage_table
from layerflow.sources import shared_folder
from layerflow.sources.tables import discard, write_bytes

_PARTS = 1 << 20


# Paths of tables stored inside each ``scratch`` that is open, the innermost last.
_open: list[list[str]] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    path = stage_table(df, f"layerflow-{label}")
    if _open:
        _open[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*frames: DataFrame | None) -> None:
    """Remove tables that ``stored`` has written, once nothing reads them any more."""
    for df in frames:
        if path := getattr(df, "stored_at", None):
            discard(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are removed at the end; write what is to last within it."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            discard(spark, path)


def ship(spark: SparkSession) -> None:
    """Make sure that the executors' Python can import this package, once per application.

    Where it cannot, as when the driver has the package on a path of its own, it is put into the
    shared folder as an archive, from which Spark hands it to the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_layerflow_there", False):
        return

    def can_import(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            try:
                there = importlib.import_module("layerflow.llm.text") is not None
            except ImportError:
                there = False
            yield pa.RecordBatch.from_pydict({"there": [there] * batch.num_rows})

    n = context.defaultParallelism
    if not all(r.there for r in spark.range(0, n, 1, n).mapInArrow(can_import, "there boolean").collect()):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(package)))
        path = f"{shared_folder(spark, 'layerflow-code')}/layerflow.zip"
        write_bytes(spark, path, packed.getvalue())
        context.addPyFile(path)
    context._layerflow_there = True


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    bound: int,
    usable: Column | None = None,
    max_chars: int = 40_000_000,
) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` labelled documents, picked by a hash of the id.

    Labels other than 0 and 1 and null ids are left out; a repeated id takes its largest label
    and its first text in string order, so that no id gives more than one row. ``usable`` is a
    condition on ``doc_id``. Where the texts have more than ``max_chars`` letters together, the
    longest rows (over a twentieth of that) are left out and then the last ones by hash.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    # a hash range twice as wide as needed, so that tasks do not each send their first rows
    width = math.ceil(_PARTS * min(1.0, 2 * bound / max(1, known.count())))
    rank = F.xxhash64("doc_id")
    picked = known.where(F.pmod(rank, F.lit(_PARTS)) < width).orderBy(rank, "doc_id").limit(bound)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(picked), "doc_id")
    rows = stored(joined.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")
    # ids and lengths of at most ``bound`` rows
    sizes = rows.select("doc_id", F.length("text").alias("n")).orderBy(rank, "doc_id").collect()
    if sum(r.n for r in sizes) <= max_chars:
        return rows
    total, ids = 0, []
    for r in sizes:
        if r.n <= max_chars // 20 and total + r.n <= max_chars:
            total += r.n
            ids.append(r.doc_id)
    return rows.where(F.col("doc_id").isin(ids))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights and, last, the intercept of a small dense logistic regression, by Newton's method."""
    x = np.column_stack((x, np.ones(len(y))))
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), l2 * len(y))
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w
        )
        w += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


class SparseRows:
    """Rows of (column, value) pairs, for gradients without a dense matrix."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.width = width
        self.column = np.concatenate([c for c, _ in rows]) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
        self.row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
        self.n = len(rows)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.n)

    def transposed_times(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * residual[self.row], self.width)


def fit_sparse_logistic(
    rows: SparseRows, y: np.ndarray, l2: float, steps: int = 120, rate: float = 0.3
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam over all rows; the same input gives the same weights."""
    w = np.zeros(rows.width + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        residual = sigmoid(rows.times(w[:-1]) + w[-1]) - y
        grad = np.append(rows.transposed_times(residual), residual.sum()) / len(y)
        grad[:-1] += l2 * w[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        size = rate * (1 - t / (steps + 1))
        w -= size * mean / (1 - 0.9**t) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return w[:-1], float(w[-1])
