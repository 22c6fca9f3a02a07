"""Toxicity classifier: bags of subword embeddings, averaged into a linear softmax.

A word is the bag of its character n-grams (with word edges), so an unseen misspelling
shares most of its vectors with the word it imitates. The vectors of the bag are averaged
and go into a linear softmax over both classes; vectors and softmax are trained jointly. A
text averages its ``TOP`` most toxic words, so a few insults in a very long text are not
averaged away and a single doubtful word does not decide; in training the gradient of a
text flows to these words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled, textops

BUCKETS = 1 << 18
WIDTH = 8
GRAMS = (3, 4, 5, 6)
TOP = 4
#: n-grams of fewer texts of the sample get no vector: they say nothing about other texts.
LEAST = 3
#: Words whose subwords are made at once.
PART = 10_000
#: The fit sees at most so many labelled rows, and their words take at most so many numbers.
SAMPLE_ROWS = 4000
SAMPLE_VALUES = 12_000_000
THRESHOLD = 0.5
_U = np.uint64


def _distinct_words(part: textops.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of one occurrence of each distinct word, each word's number, and each word's text."""
    starts, ends, docs, hashes = textops.words(part)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    return starts[first], ends[first], number, docs


def _subwords(part: textops.Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of ``<word>`` and where each word's buckets begin; the word itself is one.

    Characters are UTF-8 code points; n-grams never begin inside one.
    """
    lengths = ends - starts + 2
    base = np.concatenate(([0], np.cumsum(lengths)))
    marked = np.empty(base[-1], np.uint8)
    marked[base[:-1]], marked[base[1:] - 1] = 1, 2
    inner = np.ones(len(marked), bool)
    inner[base[:-1]] = inner[base[1:] - 1] = False
    at = np.repeat(starts - base[:-1] - 1, lengths) + np.arange(len(marked))
    marked[inner] = textops.LOWER[part.data[at[inner]]]
    sums = textops.prefix_sums(marked)
    lead = np.flatnonzero((marked & 0xC0) != 0x80)  # first byte of each code point
    owner = np.searchsorted(base, lead, "right") - 1
    stop = np.append(lead, base[-1])
    owners, buckets = [np.arange(len(starts))], [textops.run_hashes(sums, base[:-1], base[1:]) % _U(BUCKETS)]
    for n in GRAMS:
        if len(lead) < n:
            continue
        k = np.flatnonzero(owner[: len(lead) - n + 1] == owner[n - 1 :])
        owners.append(owner[k])
        buckets.append(textops.run_hashes(sums, lead[k], stop[k + n]) % _U(BUCKETS))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(starts) + 1))


def encode(texts: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Each text as numbers: how many words, distinct words and bytes of these; each word's place among the distinct ones; their lengths; their bytes."""
    out = []
    for part in textops.slices(texts):
        starts, ends, number, docs = _distinct_words(part)
        low = textops.LOWER[part.data]
        edge = np.searchsorted(docs, np.arange(part.n + 1))
        for k in range(part.n):
            own, local = np.unique(number[edge[k] : edge[k + 1]], return_inverse=True)
            sizes = ends[own] - starts[own]
            begin = np.cumsum(sizes) - sizes
            raw = low[np.repeat(starts[own] - begin, sizes) + np.arange(sizes.sum())] if len(own) else np.zeros(0, np.uint8)
            padded = np.concatenate([raw, np.zeros(-len(raw) % 4, np.uint8)]).view("<u4")
            out.append(np.concatenate([[len(local), len(own), len(raw)], local, sizes, padded]).astype(np.uint32))
    return out


def _vocabulary(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Every text's words by number, and the subwords of each number with where they begin.

    Made text by text and then ``PART`` words at a time, so only the result is ever whole.
    """
    places, sizes, raw, hashes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.uint64)]
    for row in rows:
        n, w, size = (int(x) for x in row[:3])
        places.append(row[3 : 3 + n].astype(np.int64))
        sizes.append(row[3 + n : 3 + n + w].astype(np.int64))
        raw.append(np.ascontiguousarray(row[3 + n + w :]).view(np.uint8)[:size])
        ends = np.cumsum(sizes[-1])
        hashes.append(textops.run_hashes(textops.prefix_sums(raw[-1]), ends - sizes[-1], ends) if w else np.zeros(0, np.uint64))
    base = np.cumsum([0, *(len(s) for s in sizes[1:])])
    size, whole = np.concatenate(sizes), textops.Slice(np.concatenate(raw), np.zeros(2, np.int64), 0)
    ends = np.cumsum(size)
    _, first, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    buckets, begins, total = [np.zeros(0, np.int32)], [], 0
    for k in range(0, len(first), PART):
        own = first[k : k + PART]
        bucket, begin = _subwords(whole, ends[own] - size[own], ends[own])
        buckets.append(bucket.astype(np.int32))
        begins.append(begin[:-1] + total)
        total += len(bucket)
    return [number[base[k] : base[k + 1]][p] for k, p in enumerate(places)], np.concatenate(buckets), np.concatenate([*begins, [total]])


@dataclass
class ToxicModel:
    """Per bucket the toxic-minus-clean logit that its vector adds, and an offset."""

    logits: np.ndarray
    offset: float

    def peaks(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Average of the ``TOP`` largest word logits of each text, missing ones counting 0, plus the offset."""
        out = []
        for part in textops.slices(texts):
            top = np.full(part.n, self.offset)
            starts, ends, number, docs = _distinct_words(part)
            if len(starts):
                bucket, begin = _subwords(part, starts, ends)
                word = np.add.reduceat(self.logits[bucket], begin[:-1]) / np.diff(begin)
                z = word[number]
                top += np.bincount(docs, weights=np.where(_top(z, docs), z / TOP, 0.0), minlength=part.n)
            out.append(top)
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Softmax share of label 1, between 0 and 1."""
        return labelled.sigmoid(self.peaks(texts))


def _top(z: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Marks the ``TOP`` largest values of each text; ``text`` ascends."""
    order = np.lexsort((-z, text))
    grouped = text[order]
    begin = np.maximum.accumulate(np.where(np.append(True, grouped[1:] != grouped[:-1]), np.arange(len(grouped)), 0))
    out = np.zeros(len(z), bool)
    out[order[np.arange(len(grouped)) - begin < TOP]] = True
    return out


def fit(y: np.ndarray, rows: list[np.ndarray], epochs: int = 6, rate: float = 0.5, batch: int = 64, seed: int = 11) -> ToxicModel:
    """Adagrad on batches of texts. With one class only, every score is that class's smoothed share."""
    if not len(y) or y.min() == y.max():
        share = (float(np.sum(y)) + 1.0) / (len(y) + 2.0)
        return ToxicModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32)
    offset = np.zeros(2, np.float32)
    gv, gs, go = np.full((BUCKETS, 1), 1e-6, np.float32), np.full_like(softmax, 1e-6), np.full(2, 1e-6, np.float32)
    texts, bucket, begin = _vocabulary(rows)
    usable = [i for i, t in enumerate(texts) if len(t)]
    seen = np.zeros(BUCKETS, np.int32)
    for i in usable:
        seen[np.unique(_ranges(bucket, begin, np.unique(texts[i]))[0])] += 1
    fixed = seen < LEAST
    vectors[fixed] = 0
    weight = np.where(y == 1, 0.5 * len(y) / max(np.sum(y == 1), 1), 0.5 * len(y) / max(np.sum(y == 0), 1))
    weight = np.sqrt(weight)
    for _ in range(epochs):
        order = rng.permutation(usable)
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            docs = np.repeat(np.arange(len(chosen)), [len(texts[i]) for i in chosen])
            own, place = np.unique(np.concatenate([texts[i] for i in chosen]), return_inverse=True)
            flat, sizes = _ranges(bucket, begin, own)
            direction = softmax[:, 1] - softmax[:, 0]
            word = np.add.reduceat((vectors @ direction)[flat], np.cumsum(sizes) - sizes) / sizes
            z = word[place]
            edge = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
            share = np.where(_top(z, docs), 1.0 / TOP, 0.0)
            pooled = np.add.reduceat(share * z, edge)
            ids = chosen[docs[edge]]
            error = ((labelled.sigmoid(pooled + offset[1] - offset[0]) - y[ids]) * weight[ids]).astype(np.float32)
            dz = np.repeat(error, np.diff(np.append(edge, len(z)))) * share
            dword = np.bincount(place, weights=dz, minlength=len(own)).astype(np.float32)
            dflat = np.repeat(dword / sizes, sizes)
            keep = (np.abs(dflat) > 1e-9) & ~fixed[flat]
            flat_k, dflat = flat[keep], dflat[keep]
            uniq, inv = np.unique(flat_k, return_inverse=True)
            dbucket = np.bincount(inv, weights=dflat, minlength=len(uniq)).astype(np.float32)
            dsoft = vectors[uniq].T @ dbucket
            gv[uniq, 0] += dbucket**2 * float(direction @ direction) / WIDTH
            vectors[uniq] -= rate * dbucket[:, None] * direction[None] / np.sqrt(gv[uniq])
            grad = np.stack([-dsoft, dsoft], 1)
            gs += grad**2
            softmax -= 0.1 * rate * grad / np.sqrt(gs)
            goff = np.array([-error.sum(), error.sum()], np.float32)
            go += goff**2
            offset -= 0.1 * rate * goff / np.sqrt(go)
    return ToxicModel((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(offset[1] - offset[0]))


def _ranges(bucket: np.ndarray, begin: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of the given words one after the other, and how many each has."""
    sizes = begin[words + 1] - begin[words]
    ends = np.cumsum(sizes)
    return bucket[np.repeat(begin[words] - ends + sizes, sizes) + np.arange(sizes.sum())], sizes


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, values: int = SAMPLE_VALUES) -> ToxicModel:
    """Learn ``labels.toxic`` from the texts of at most ``rows`` labelled documents that are not held out."""
    y, encoded = labelled.gather_sample(labelled.training_texts(documents, labels, "toxic", rows), encode, values)
    return fit(y, encoded)


def score_toxicity(documents: DataFrame, model: ToxicModel) -> DataFrame:
    """All rows and columns of ``documents`` with ``score``, the probability of being toxic.

    The score depends on the whole text only; null counts as empty, and a text without words
    gets the score of the offset. An input column named ``score`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS logits: 1 MB at any input size
    return labelled.score_texts(documents, lambda texts: shared.value.score(texts))


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``; repeated rows stay repeated.

    An empty ``documents`` gives no rows; without usable labels every score is 0.5.
    """
    scored = score_toxicity(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select("doc_id", labelled.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
