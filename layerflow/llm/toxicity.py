"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.text import Points, Runs, add_from_text, mixed, per_text, slices
from layerflow.llm.training import fit_logistic, labelled_sample, sigmoid

KINDS = 3  # the word, its first five letters, its last three
BUCKET_BITS = 18
PREFIX, SUFFIX = 5, 3
CHUNK = 1 << 17  # tokens whose tables are held at once
SEGMENT = 128  # tokens that are worked through side by side
SKETCH = 16  # smallest word hashes that tell near copies among the training rows

SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS_DDL = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class ToxicityModel:
    """Chain of two states, 1 being toxic; and the map from marginals to a document's score.

    ``weights`` are of state 1 by kind and bucket, ``moves`` log weights from state to state,
    ``begin`` the log weight of beginning in state 1.
    """

    weights: np.ndarray
    moves: np.ndarray
    begin: float
    score: np.ndarray

    def marginals(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _chunked(_emission(self.weights, buckets), first, self.moves, self.begin)[0]

    def document_scores(self, p: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return sigmoid(_summary(p, first, last) @ self.score[:-1] + self.score[-1])


def tokens_of(points: Points) -> tuple[Runs, np.ndarray, np.ndarray]:
    """Words of letters and digits in lower case, their hashes, and a bucket for each kind."""
    tokens = points.alphanumeric()
    codes = points.lowered()
    whole = tokens.hashes(codes)
    cut = Runs.__new__(Runs)
    cut.starts, cut.ends = tokens.starts, np.minimum(tokens.ends, tokens.starts + PREFIX)
    head = cut.hashes(codes)
    cut.starts, cut.ends = np.maximum(tokens.starts, tokens.ends - SUFFIX), tokens.ends
    tail = cut.hashes(codes)
    shift = np.uint64(64 - BUCKET_BITS)
    return tokens, whole, np.stack([whole >> shift, head >> shift, tail >> shift]).astype(np.int32)


def _emission(weights: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return sum(weights[kind][buckets[kind]] for kind in range(KINDS)).astype(np.float64)


def _forward_backward(emission, first, moves, begin):
    """Marginals of state 1, and expected counts of moves; ``first`` marks texts' first tokens.

    All texts form one chain in which a first token does not depend on the token before it. The
    chain is cut into segments: their transfer matrices are multiplied out side by side, the
    states at their borders follow one after another, and then all segments are worked through
    side by side. So the number of steps does not grow with the longest text.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    rows = -(-n // SEGMENT)
    size = rows * SEGMENT
    gain = np.ones(size)
    gain[:n] = np.exp(np.clip(emission, -30, 30))
    step = np.empty((2, 2, size))  # weight of the move into a token, its own gain included
    for p in range(2):
        for q in range(2):
            step[p, q] = np.exp(moves[p, q])
    starts = np.flatnonzero(first)
    step[:, 0, starts] = 1.0
    step[:, 1, starts] = np.exp(begin)
    step[:, 1] *= gain
    step[:, :, n:] = np.eye(2)[:, :, None]
    step = step.reshape(2, 2, rows, SEGMENT)
    # transfer matrix of each segment
    whole = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, rows)).copy()
    for t in range(SEGMENT):
        whole = np.einsum("pqs,qrs->prs", whole, step[:, :, :, t])
        whole /= whole.sum(axis=(0, 1))
    into = np.empty((2, rows))
    state = (0.5, 0.5)
    w = whole.transpose(2, 0, 1).tolist()
    for s in range(rows):
        into[:, s] = state
        (a, b), (c, d) = w[s]
        x, y = state[0] * a + state[1] * c, state[0] * b + state[1] * d
        state = (x / (x + y), y / (x + y))
    out = np.empty((2, rows))
    state = (0.5, 0.5)
    for s in range(rows - 1, -1, -1):
        out[:, s] = state
        (a, b), (c, d) = w[s]
        x, y = a * state[0] + b * state[1], c * state[0] + d * state[1]
        state = (x / (x + y), y / (x + y))
    ahead = np.empty((2, rows, SEGMENT))
    alpha = into
    for t in range(SEGMENT):
        alpha = np.einsum("ps,pqs->qs", alpha, step[:, :, :, t])
        alpha = alpha / alpha.sum(axis=0)
        ahead[:, :, t] = alpha
    behind = np.empty((2, rows, SEGMENT))
    beta = out
    for t in range(SEGMENT - 1, -1, -1):
        behind[:, :, t] = beta
        beta = np.einsum("pqs,qs->ps", step[:, :, :, t], beta)
        beta = beta / beta.sum(axis=0)
    both = ahead * behind
    marginal = (both[1] / both.sum(axis=0)).reshape(-1)[:n]
    # expected moves: the state before, the move, what follows
    before = np.concatenate((into[:, :, None], ahead[:, :, :-1]), axis=2).reshape(2, size)[:, :n]
    after = behind.reshape(2, size)[:, :n]
    joint = before[:, None] * step.reshape(2, 2, size)[:, :, :n] * after[None]
    joint /= joint.sum(axis=(0, 1))
    return marginal, joint[:, :, ~first[:n]].sum(axis=2)


def _chunked(emission, first, moves, begin):
    """``_forward_backward`` over some whole texts at a time, so its tables stay small."""
    starts = np.flatnonzero(first)
    cuts = np.searchsorted(starts, np.arange(CHUNK, len(emission), CHUNK))
    cuts = starts[cuts[cuts < len(starts)]]
    cuts = np.unique(np.concatenate((np.zeros(1, np.int64), cuts, [len(emission)])))
    p, counts = np.empty(len(emission)), np.zeros((2, 2))
    for a, b in zip(cuts, cuts[1:], strict=False):
        p[a:b], more = _forward_backward(emission[a:b], first[a:b], moves, begin)
        counts += more
    return p, counts


def _firsts(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    begins = np.zeros(n, bool)
    begins[first[last > first]] = True
    return begins


def _summary(p: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Largest marginal, expected number of toxic words and their share, on scales of odds or logs."""
    n = last - first
    total = per_text(p, first, last)
    most = np.zeros(len(n))
    some = n > 0
    if some.any():
        most[some] = np.maximum.reduceat(p, first[some])
    most = np.clip(most, 1e-4, 1 - 1e-4)
    share = total / np.maximum(1, n)
    return np.column_stack(
        (np.log(most / (1 - most)), np.log1p(total), np.log(share + 1e-3), np.sqrt(share))
    )


def _copy_groups(sketches: list[np.ndarray]) -> np.ndarray:
    """A group number per text; texts that share half of their sketches are one group."""
    by_hash, group = defaultdict(list), []
    for i, sketch in enumerate(sketches):
        shared: dict[int, int] = defaultdict(int)
        for h in sketch.tolist():
            for j in by_hash[h]:
                shared[j] += 1
        best = max(shared, key=lambda j: (shared[j], -j), default=None)
        if best is not None and 2 * shared[best] >= len(sketch):
            group.append(group[best])
        else:
            group.append(i)
            for h in sketch.tolist():
                by_hash[h].append(i)
    return np.array(group)


def label_tokens(
    hashes: np.ndarray, doc: np.ndarray, toxic: np.ndarray, group: np.ndarray
) -> np.ndarray:
    """Token labels from document labels: words of toxic texts that toxic texts use far more often.

    A word counts once per group of copies. It is labelled where at least 4 toxic groups use it,
    and their share is at least 8 times that of the other groups.
    """
    _, kept = np.unique(mixed(hashes + group[doc].astype(np.uint64)), return_index=True)
    of_group = toxic[group[doc[kept]]]
    words, at = np.unique(hashes[kept], return_inverse=True)
    bad = np.bincount(at, of_group, len(words))
    good = np.bincount(at, 1 - of_group, len(words))
    leaders = np.unique(group)
    n_bad = toxic[leaders].sum()
    n_good = len(leaders) - n_bad
    odd = (bad + 0.5) / (n_bad + 1) >= 8 * (good + 0.5) / (n_good + 1)
    lexicon = words[odd & (bad >= 4)]
    return np.isin(hashes, lexicon) & (toxic[doc] > 0)


def _fit_chain(buckets, first, y, steps: int = 60, rate: float = 0.4, l2: float = 2e-6):
    """Weights, moves and beginning by Adam on the likelihood of the labelled tokens."""
    n = len(y)
    width = 1 << BUCKET_BITS
    w = np.zeros(KINDS * width + 5)
    seen = np.zeros((2, 2))
    pair = np.flatnonzero(~first)
    np.add.at(seen, (y[pair - 1], y[pair]), 1)
    w[-5:-1] = np.log((seen + 1) / (seen.sum(axis=1, keepdims=True) + 2)).reshape(-1)
    w[-1] = np.log((y[first].sum() + 1) / (first.sum() + 2))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        weights = w[:-5].reshape(KINDS, width)
        p, moves = _chunked(_emission(weights, buckets), first, w[-5:-1].reshape(2, 2), w[-1])
        residual = y - p
        grad = np.concatenate(
            [np.bincount(kind, residual, width) for kind in buckets]
            + [(seen - moves).reshape(-1), residual[first].sum(keepdims=True)]
        )
        grad /= n
        grad[:-5] -= l2 * w[:-5]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        size = rate * (1 - t / (steps + 1))
        w += size * mean / (1 - 0.9**t) / (np.sqrt(square / (1 - 0.99**t)) + 1e-10)
    weights = w[:-5].reshape(KINDS, width).astype(np.float32)
    return weights, w[-5:-1].reshape(2, 2), float(w[-1])


def fit(texts: Sequence[str], labels: np.ndarray) -> ToxicityModel | None:
    """Fit the chain on two thirds of the texts and the document score on the others."""
    toxic = np.asarray(labels, float)
    if len(set(toxic)) < 2:
        return None
    parts = []
    for a, b in slices([len(text) for text in texts]):
        tokens, own, bucket = tokens_of(Points(texts[a:b]))
        parts.append((tokens.last - tokens.first, own, bucket))
    n = np.concatenate([part[0] for part in parts])
    hashes = np.concatenate([part[1] for part in parts])
    buckets = np.concatenate([part[2] for part in parts], axis=1)
    del parts
    if not len(hashes):
        return None
    last = np.cumsum(n)
    first = last - n
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    group = _copy_groups([np.unique(hashes[a:b])[:SKETCH] for a, b in zip(first, last, strict=True)])
    # whole groups go to one side, so that no text is scored by a copy of itself
    chain = group % 3 != 2
    if len(set(toxic[chain])) < 2 or len(set(toxic[~chain])) < 2:
        chain = np.ones(len(toxic), bool)
    inside = chain[doc]
    y = label_tokens(hashes[inside], doc[inside], toxic, group).astype(np.int64)
    begins = _firsts(first, last, len(hashes))
    weights, moves, begin = _fit_chain(buckets[:, inside], begins[inside], y)
    p, _ = _chunked(_emission(weights, buckets), begins, moves, begin)
    rest = ~chain if not chain.all() else chain
    score = fit_logistic(_summary(p, first, last)[rest], toxic[rest], l2=1e-3)
    return ToxicityModel(weights, moves, begin, score)


def train(
    docs: DataFrame, labels: DataFrame, *, usable: Column | None = None, max_rows: int = 3000
) -> ToxicityModel | None:
    """Fit on at most ``max_rows`` labelled documents; None where there are not both labels."""
    sample = labelled_sample(docs, labels, "toxic", max_rows, usable).orderBy("doc_id").toPandas()
    return fit(list(sample["text"]), sample["label"].to_numpy(float))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from; false for a null id, which has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel | None,
    *,
    threshold: float = 0.3,
    text_col: str = "text",
    prefix: str = "",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``spans`` of each whole text.

    ``spans`` are runs of words whose marginal of the toxic state is at least one half, as offsets
    in code points. Null and empty texts have no words, no spans, and the score of a text without
    any sign of toxicity. Without a model every score is 0. Only the text enters a score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str]) -> dict[str, Sequence]:
        model = shared.value
        spans: list[list[dict]] = [[] for _ in texts]
        score = np.zeros(len(texts))
        if model is not None:
            points = Points(texts)
            tokens, _, buckets = tokens_of(points)
            p = model.marginals(buckets, _firsts(tokens.first, tokens.last, len(tokens)))
            score = model.document_scores(p, tokens.first, tokens.last)
            toxic = np.flatnonzero(p >= 0.5)
            doc = tokens.doc[toxic]
            opens = np.ones(len(toxic), bool)
            opens[1:] = (toxic[1:] != toxic[:-1] + 1) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(opens)
            end = np.append(begin, len(toxic))[1:] - 1
            for a, b in zip(begin, end, strict=True):
                at = points.starts[doc[a]]
                spans[doc[a]].append(
                    {
                        "start": int(tokens.starts[toxic[a]] - at),
                        "end": int(tokens.ends[toxic[b]] - at),
                    }
                )
        return {
            f"{prefix}score": score,
            f"{prefix}predicted": (score >= threshold).astype(np.int32),
            f"{prefix}spans": spans,
        }

    added = {
        f"{prefix}score": (pa.float64(), "double"),
        f"{prefix}predicted": (pa.int32(), "int"),
        f"{prefix}spans": (SPANS, SPANS_DDL),
    }
    return add_from_text(docs, compute, added, text_col=text_col, keep=keep)
