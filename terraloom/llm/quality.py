"""Quality classifier: Naive Bayes support vectors.

Every text becomes a set of n-gram indicators (words, word pairs, and runs of token
shapes), hashed into a fixed number of buckets. Indicators are scaled by the log of the
ratio in which the two classes have them, and a linear model with hinge loss is fitted on
the scaled indicators by dual coordinate descent. Margins of rows left out of a fit turn
into probabilities through a logistic curve.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled, textops

BUCKETS = 1 << 18
#: The fit sees at most so many labelled rows, and at most so many indicators in all.
SAMPLE_ROWS = 4000
SAMPLE_VALUES = 12_000_000
THRESHOLD = 0.3

_CLASS = np.full(256, 2, np.uint8)  # 0 space, 1 word, 2 sign, 3 line end
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 3
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_BITS = np.zeros(256, np.uint8)
_BITS[48:58], _BITS[65:91], _BITS[97:123], _BITS[128:] = 1, 2, 4, 8
_U = np.uint64


def _tokens(part: textops.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, shape and text index of each token: a run of word bytes, of signs, or of line ends."""
    kind = _CLASS[part.data]
    change = np.ones(len(kind), bool)
    change[1:] = kind[1:] != kind[:-1]
    edges = part.offsets[1:-1]
    change[edges[(edges > 0) & (edges < len(kind))]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(kind))
    bits = np.bitwise_or.reduceat(_BITS[part.data], starts) if len(starts) else np.zeros(0, np.uint8)
    real = kind[starts] != 0
    glued = np.zeros(len(starts), bool)
    glued[1:] = real[:-1]
    glued &= ~np.isin(starts, part.offsets)  # a text's first token follows nothing
    starts, ends, bits, glued = starts[real], ends[real], bits[real], glued[real]
    docs = part.docs(starts)
    hashes = textops.run_hashes(textops.prefix_sums(textops.LOWER[part.data]), starts, ends)
    length = np.minimum(np.frexp((ends - starts).astype(np.float64))[1], 5).astype(np.uint64)
    again = np.zeros(len(starts), bool)
    for back in (1, 2, 3):
        again[back:] |= (hashes[back:] == hashes[:-back]) & (docs[back:] == docs[:-back])
    word = kind[starts] == 1
    shape = np.where(word, _U(1) + bits.astype(np.uint64) * _U(8) + length, hashes)
    shape = np.where(kind[starts] == 3, _U(7), shape) * _U(4) + again * _U(2) + glued
    return hashes, shape, docs


def indicators(texts: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Sorted distinct buckets of every text; an empty or null text has none."""
    out: list[np.ndarray] = []
    for part in textops.slices(texts):
        text, bucket = _slice_indicators(part)
        out += np.split(bucket.astype(np.uint32), np.searchsorted(text, np.arange(1, part.n)))
    return out


def _slice_indicators(part: textops.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bucket of each distinct indicator, ordered by both."""
    hashes, shape, docs = _tokens(part)
    found = []
    for seed, base, sizes in ((1, hashes, (1, 2)), (2, shape, (1, 2, 3, 4))):
        for n in sizes:
            grams, at = textops.ngrams(base, docs, n)
            found.append((docs[at] * BUCKETS) | (textops.mix(grams + _U(seed * 16 + n)) % _U(BUCKETS)).astype(np.int64))
    both = np.sort(np.concatenate(found))
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return both // BUCKETS, both % BUCKETS


@dataclass
class QualityModel:
    """One weight per bucket, an offset, and the logistic curve from margin to probability."""

    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def margins(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        out = []
        for part in textops.slices(texts):
            text, bucket = _slice_indicators(part)
            total = np.bincount(text, weights=self.weights[bucket], minlength=part.n)
            size = np.maximum(np.bincount(text, minlength=part.n), 1)
            out.append(total / np.sqrt(size) + self.offset)
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Probability of label 1, between 0 and 1."""
        return labelled.sigmoid(self.slope * self.margins(texts) + self.shift)


def _ratios(y: np.ndarray, rows: list[np.ndarray], alpha: float) -> np.ndarray:
    counts = [np.bincount(np.concatenate([r for r, c in zip(rows, y) if c == k] or [np.zeros(0, np.uint32)]).astype(np.int64),
                          minlength=BUCKETS) + alpha for k in (0, 1)]
    n = [max(int(np.sum(y == k)), 1) + 2 * alpha for k in (0, 1)]
    return np.log(counts[1] / n[1]) - np.log(counts[0] / n[0])


def _descend(y: np.ndarray, rows: list[np.ndarray], ratio: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for squared hinge loss; classes weigh the same in total."""
    sign = np.where(y == 1, 1.0, -1.0)
    share = {k: cost * len(y) / (2.0 * max(int(np.sum(sign == k)), 1)) for k in (-1.0, 1.0)}
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    diagonal = np.array([1.0 / (2.0 * share[s]) for s in sign])
    norms = np.array([v @ v + 1.0 for v in values]) + diagonal
    weights, offset, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            r, v = rows[i], values[i]
            slope = sign[i] * (weights[r] @ v + offset) - 1.0 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / norms[i], 0.0)
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[r] += step * v
                offset += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights * ratio, offset


def fit(y: np.ndarray, rows: list[np.ndarray], alpha: float = 0.5, cost: float = 1.0, epochs: int = 40, folds: int = 3, seed: int = 7) -> QualityModel:
    """Fit on encoded rows. With one class only, every score is that class's smoothed share."""
    if not len(y) or y.min() == y.max():
        share = (float(np.sum(y)) + 1.0) / (len(y) + 2.0)
        return QualityModel(np.zeros(BUCKETS), 0.0, 1.0, float(np.log(share / (1 - share))))
    fold = np.arange(len(y)) % folds
    margin = np.zeros(len(y))
    for k in range(folds):
        seen = fold != k
        if y[seen].min() == y[seen].max():
            continue
        part = [r for r, s in zip(rows, seen) if s]
        w, b = _descend(y[seen], part, _ratios(y[seen], part, alpha), cost, epochs, seed)
        for i in np.flatnonzero(~seen):
            margin[i] = w[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + b
    slope, shift = labelled.calibrate(margin, y)
    w, b = _descend(y, rows, _ratios(y, rows, alpha), cost, epochs, seed)
    return QualityModel(w.astype(np.float32), b, slope, shift)


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, values: int = SAMPLE_VALUES) -> QualityModel:
    """Learn ``labels.quality`` from the texts of at most ``rows`` labelled documents that are not held out."""
    y, encoded = labelled.gather_sample(labelled.training_texts(documents, labels, "quality", rows), indicators, values)
    return fit(y, encoded)


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """All rows and columns of ``documents`` with ``score``, the probability of good quality.

    The score depends on the whole text only; null counts as empty, and an empty text gets
    the score of no indicators. An input column named ``score`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights: 1 MB at any input size
    return labelled.score_texts(documents, lambda texts: shared.value.score(texts))


def quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``; repeated rows stay repeated.

    An empty ``documents`` gives no rows; without usable labels every score is 0.5.
    """
    scored = score_quality(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select("doc_id", labelled.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
