"""Main text of HTML pages by a linear-chain conditional random field over their leaf blocks.

A block's label, main or not, depends on features of its ancestors and its text and on the
label before it. Weights maximize the likelihood of labelled pages; Viterbi finds the most
likely labels of a page.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import html_pages
from .html_blocks import leaf_blocks

#: Generated labelled pages the default model is fitted on, and rounds of the fit.
PAGES, ROUNDS = 500, 90
#: Strength of the pull of weights towards zero.
PULL = 0.02


class Model(NamedTuple):
    """``weights`` of features for main text; ``start``, ``step`` and ``stop`` of the labels other (0) and main (1)."""

    weights: dict[str, float]
    start: tuple[float, float]
    step: tuple[tuple[float, float], tuple[float, float]]
    stop: tuple[float, float]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))


def likelihood(emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log of the sum over all label sequences of every page, and the marginals of labels and of label pairs.

    ``emit`` is pages x blocks x 2; blocks past a page's length do not count. All pages go forward and backward together.
    """
    n, most, _ = emit.shape
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = start + emit[:, 0]
    live = np.arange(most)[None, :] < lengths[:, None]
    for t in range(1, most):
        new = _log_sum(ahead[:, t - 1, :, None] + step[None], 1) + emit[:, t]
        ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
    total = _log_sum(ahead[:, -1] + stop, 1)
    back[:, -1] = stop
    for t in range(most - 2, -1, -1):
        new = _log_sum(step[None] + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(live[:, t + 1, None], new, stop)
    one = np.exp(ahead + back - total[:, None, None]) * live[..., None]
    pair = ahead[:, :-1, :, None] + step[None, None] + (emit[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    return total, one, np.exp(np.where(live[:, 1:, None, None], pair, -np.inf))


def fit(pages: Sequence[tuple[Sequence[Sequence[str]], Sequence[int]]], rounds: int = ROUNDS, pull: float = PULL) -> Model:
    """A model of labelled pages: for each the features of its blocks, and their labels (1: main).

    Features seen in one page only are left out. The fit runs on the driver: give it a bounded number of pages.
    """
    pages = [(blocks, labels) for blocks, labels in pages if blocks]
    seen: dict[str, int] = {}
    for blocks, _ in pages:
        for name in {f for block in blocks for f in block}:
            seen[name] = seen.get(name, 0) + 1
    number = {name: k for k, name in enumerate(sorted(name for name, count in seen.items() if count > 1))}
    if not number:
        return Model({}, (0.0, 0.0), ((0.0, 0.0), (0.0, 0.0)), (0.0, 0.0))
    lengths = np.array([len(blocks) for blocks, _ in pages])
    most = int(lengths.max())
    truth = np.zeros((len(pages), most), np.int64)
    flat, owner = [], []
    for p, (blocks, labels) in enumerate(pages):
        truth[p, : len(labels)] = labels
        for b, block in enumerate(blocks):
            own = [number[f] for f in block if f in number]
            flat += own
            owner += [p * most + b] * len(own)
    flat, owner = np.array(flat), np.array(owner)
    live = np.arange(most)[None, :] < lengths[:, None]
    last = truth[np.arange(len(pages)), lengths - 1]
    want_pair = np.zeros((2, 2))
    np.add.at(want_pair, (truth[:, :-1][live[:, 1:]], truth[:, 1:][live[:, 1:]]), 1)
    n = len(number)
    x, moved, spread = np.zeros(n + 8), np.zeros(n + 8), np.zeros(n + 8)
    for k in range(1, rounds + 1):
        w, start, step, stop = x[:n], x[n : n + 2], x[n + 2 : n + 6].reshape(2, 2), x[n + 6 :]
        emit = np.zeros((len(pages), most, 2))
        emit[..., 1] = np.bincount(owner, weights=w[flat], minlength=truth.size).reshape(truth.shape)
        _, one, pair = likelihood(emit, lengths, start, step, stop)
        rest = ((truth == 1) * live - one[..., 1]).ravel()
        ends = one[np.arange(len(pages)), lengths - 1]
        slope = np.concatenate([
            np.bincount(flat, weights=rest[owner], minlength=n), np.bincount(truth[:, 0], minlength=2) - one[:, 0].sum(0),
            (want_pair - pair.sum((0, 1))).ravel(), np.bincount(last, minlength=2) - ends.sum(0),
        ]) / len(pages) - pull / len(pages) * 10 * x
        # Steps of bounded size, by the running mean and spread of the slope.
        moved, spread = 0.9 * moved + 0.1 * slope, 0.99 * spread + 0.01 * slope * slope
        x = x + 0.15 * (moved / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-8)
    start, step, stop = x[n : n + 2], x[n + 2 : n + 6].reshape(2, 2), x[n + 6 :]
    return Model(
        {name: float(x[k]) for name, k in number.items()}, tuple(start.tolist()), tuple(map(tuple, step.tolist())), tuple(stop.tolist())
    )


def decode(blocks: Sequence[Sequence[str]], model: Model) -> list[int]:
    """The most likely labels of a page's blocks, by Viterbi."""
    if not blocks:
        return []
    weight, ((oo, om), (mo, mm)) = model.weights.get, model.step
    came: list[tuple[int, int]] = []
    other, main = model.start[0], model.start[1] + sum(weight(f, 0.0) for f in blocks[0])
    for block in blocks[1:]:
        emit = sum(weight(f, 0.0) for f in block)
        came.append((int(main + mo > other + oo), int(main + mm > other + om)))
        other, main = max(other + oo, main + mo), max(other + om, main + mm) + emit
    labels = [int(main + model.stop[1] > other + model.stop[0])]
    for step in reversed(came):
        labels.append(step[labels[-1]])
    return labels[::-1]


def labelled_blocks(page: str) -> tuple[list[tuple[str, ...]], list[int]]:
    """Features and labels of a page whose main blocks begin with the mark of ``html_pages``."""
    found = leaf_blocks(page.replace(html_pages.MARK, ""))
    marked = [text for text, _ in leaf_blocks(page)]
    return [features for _, features in found], [int(text.startswith(html_pages.MARK)) for text in marked]


@lru_cache(1)
def default_model(pages: int = PAGES) -> Model:
    """The model of ``pages`` generated labelled pages; made once per process, the same in each."""
    return fit([labelled_blocks(html_pages.labelled_page(seed)) for seed in range(pages)])


def main_text(page: str | None, model: Model) -> str:
    """The main blocks of a page, joined by line breaks; empty if none."""
    found = leaf_blocks(page or "")
    labels = decode([features for _, features in found], model)
    return "\n".join(text for (text, _), label in zip(found, labels) if label)


def train(labelled: DataFrame, rows: int = PAGES) -> Model:
    """A model of at most ``rows`` rows ``html, labels`` (1 or 0 for every leaf block of ``leaf_blocks``), chosen by hash.

    Pages whose labels do not match their blocks in number are left out.
    """
    chosen = labelled.select("html", "labels").orderBy(F.xxhash64("html"), "html").limit(rows).collect()
    pages = [([features for _, features in leaf_blocks(r.html or "")], list(r.labels or [])) for r in chosen]
    return fit([(blocks, labels) for blocks, labels in pages if len(blocks) == len(labels)])


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """All columns of ``pages`` with ``text``, the main text of the whole ``html``, and ``n_chars``, its code points.

    Null html counts as empty; a page without main blocks has an empty text. Input columns
    named ``text`` or ``n_chars`` are replaced. Each row is worked on by itself, so repeated
    rows have equal results; the model (a few hundred KB) is sent to the tasks.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(tuple(model or default_model()))

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [main_text(page, own) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*kept, "text", "n_chars"],
                )

    schema = pages.select(*kept).schema.add("text", "string").add("n_chars", "long")
    return pages.select(*kept).mapInArrow(run, schema)
