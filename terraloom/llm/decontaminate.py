"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark items become windows of ``WINDOW`` consecutive words. Windows are searched in the
normalized bytes of every whole document: the last bytes before a position select a shift
from a table, which skips all positions no window can end at; where the shift is zero, the
same bytes select the windows that end so, and comparing bytes decides. Positions of many
stretches of text are advanced together as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import textops

WINDOW = 13
#: A document counts as contaminated from one hit word in so many.
ONE_IN = 20
#: Benchmark text searched at once; more is searched block after block, so tables stay bounded.
BLOCK_BYTES = 4 << 20
#: Items are cut into overlapping pieces of so many windows, so that a long one spreads over blocks.
PIECE_WINDOWS = 2048
_TABLE_BITS = 20
_LANE = 256
_U = np.uint64
_CLASSES = (8, 32)  # windows are searched in groups of similar length: a short one would shrink all shifts


def _normalize(part: textops.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slice joined by single spaces: the bytes, where each word starts and ends there, and its text."""
    low = textops.LOWER[part.data]
    starts, ends = textops.bounds(textops.WORD[low], part.offsets)
    lengths = ends - starts
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(at[-1] + 8, 32, np.uint8)
    member = np.ones(at[-1], bool)
    member[at[1:] - 1] = False
    out[: at[-1]][member] = low[textops.WORD[low]]
    return out, at[:-1], at[:-1] + lengths, part.docs(starts)


class _Group:
    """Shift table and suffix buckets for the windows of one range of lengths."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray):
        self.least = int(lengths.min())
        self.block = min(8, self.least)
        self.mask = _U((1 << (8 * self.block)) - 1)
        view = _eight(data)
        self.shift = np.full(1 << _TABLE_BITS, self.least - self.block + 1, np.int32)
        for end in range(self.block, self.least + 1):
            np.minimum.at(self.shift, self.key(view, starts + end - self.block), self.least - end)
        suffix = self.key(view, starts + self.least - self.block)
        order = np.argsort(suffix, kind="stable")
        self.starts, self.lengths, self.ids = starts[order], lengths[order], ids[order]
        self.edges = np.searchsorted(suffix[order], np.arange((1 << _TABLE_BITS) + 1))

    def key(self, view: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (((view[at] & self.mask) * _U(0x9E3779B97F4A7C15)) >> _U(64 - _TABLE_BITS)).astype(np.int64)


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))


class Matcher:
    """All distinct windows of one block of items, ready to search."""

    def __init__(self, pieces: list[tuple[int, bool, str]], window: int = WINDOW):
        """``pieces``: item number, whether it is a whole item, and its words joined by spaces."""
        data = bytearray()
        found: dict[bytes, tuple[int, int, int]] = {}
        owners: dict[bytes, set[int]] = {}
        for item, whole, text in pieces:
            parts = text.split(" ")
            base = len(data)
            raw = text.encode() + b" "
            data += raw
            ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
            starts = np.concatenate(([0], ends[:-1] + 1))
            size = min(window, len(parts)) if whole else window
            for k in range(len(parts) - size + 1):
                a, b = int(starts[k]), int(ends[k + size - 1]) + 1
                found.setdefault(raw[a:b], (base + a, b - a, size))
                owners.setdefault(raw[a:b], set()).add(item)
        self.data = np.frombuffer(bytes(data) + b"\0" * 8, np.uint8)
        facts = np.array(list(found.values()), np.int64).reshape(-1, 3)
        self.n_words = facts[:, 2]
        lists = [sorted(owners[k]) for k in found]
        self.item_edges = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        self.items = np.array([i for x in lists for i in x], np.int64)
        self.groups = []
        for low, high in zip((0, *_CLASSES), (*_CLASSES, 1 << 62)):
            own = np.flatnonzero((facts[:, 1] >= low) & (facts[:, 1] < high))
            if len(own):
                self.groups.append(_Group(self.data, facts[own, 0], facts[own, 1], own))

    def search(self, text: np.ndarray, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start position and window number of every occurrence that begins where a word begins."""
        n = len(text) - 8
        view, own = _eight(text), _eight(self.data)
        begins = np.zeros(n + 1, bool)
        begins[word_starts] = True
        at_all, id_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for g in self.groups:
            if n < g.least:
                continue
            cursor = np.arange(g.least - g.block, n - g.block + 1, _LANE)  # where the last block begins
            stop = np.minimum(cursor + _LANE, n - g.block + 1)
            zero = []
            while len(cursor):
                jump = g.shift[g.key(view, cursor)]
                zero.append(cursor[jump == 0])
                cursor = cursor + np.maximum(jump, 1)
                live = cursor < stop
                cursor, stop = cursor[live], stop[live]
            ends = np.concatenate(zero)
            ends = ends[begins[ends + g.block - g.least]]
            key = g.key(view, ends)
            count = g.edges[key + 1] - g.edges[key]
            start = np.repeat(ends + g.block - g.least, count)
            which = np.repeat(g.edges[key] - np.cumsum(count) + count, count) + np.arange(count.sum())
            length = g.lengths[which]
            inside = start + length <= n
            start, which, length = start[inside], which[inside], length[inside]
            done = 0
            while len(start) and done < int(length.max()):
                left = np.clip(length - done, 0, 8)
                mask = np.where(left == 8, ~_U(0), (_U(1) << (left.astype(np.uint64) * _U(8))) - _U(1))
                a = view[np.minimum(start + done, len(view) - 1)]
                b = own[np.minimum(g.starts[which] + done, len(own) - 1)]
                same = ((a ^ b) & mask) == 0
                start, which, length = start[same], which[same], length[same]
                done += 8
            at_all.append(start)
            id_all.append(g.ids[which])
        return np.concatenate(at_all), np.concatenate(id_all)

    def hits(self, part: textops.Slice) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Per text: number of words, merged hit runs as (first, last + 1) word pairs, and item numbers."""
        text, starts, _, docs = _normalize(part)
        n_words = np.bincount(docs, minlength=part.n)
        base = np.concatenate(([0], np.cumsum(n_words)))
        spans: list[np.ndarray] = [np.zeros(0, np.int64)] * part.n
        items: list[np.ndarray] = [np.zeros(0, np.int64)] * part.n
        at, which = self.search(text, starts) if len(starts) else (np.zeros(0, np.int64),) * 2
        first = np.searchsorted(starts, at)
        last = first + self.n_words[which]
        inside = (last <= len(docs)) & (docs[np.minimum(last, len(docs)) - 1] == docs[first]) if len(at) else np.zeros(0, bool)
        first, last, which = first[inside], last[inside], which[inside]
        if not len(first):
            return n_words, spans, items
        change = np.bincount(first, minlength=len(docs) + 1) - np.bincount(last, minlength=len(docs) + 1)
        covered = np.cumsum(change)[: len(docs)] > 0
        run_first, run_last = textops.bounds(covered, base)
        count = self.item_edges[which + 1] - self.item_edges[which]
        item = self.items[np.repeat(self.item_edges[which] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        pairs = np.unique(np.stack([np.repeat(docs[first], count), item]), axis=1)
        owner = docs[run_first]
        for d in np.unique(owner):
            own = owner == d
            spans[d] = np.stack([run_first[own] - base[d], run_last[own] - base[d]], 1).ravel()
            items[d] = pairs[1, pairs[0] == d]
        return n_words, spans, items


def _pieces(benchmark: DataFrame) -> DataFrame:
    """``item, whole, words, n`` per piece of every item that has words; ``item`` is the id as text."""

    def run(batches):
        for batch in batches:
            item, whole, text, size = [], [], [], []
            for part in textops.slices(batch.column("text")):
                data, starts, ends, docs = _normalize(part)
                edges = np.searchsorted(docs, np.arange(part.n + 1))
                for d in range(part.n):
                    a, b = int(edges[d]), int(edges[d + 1])
                    for k in range(a, b, PIECE_WINDOWS):
                        stop = min(k + PIECE_WINDOWS + WINDOW - 1, b)
                        if k > a and stop - k < WINDOW:
                            break
                        item.append(batch.column("item")[part.first + d].as_py())
                        whole.append(b - a <= PIECE_WINDOWS)
                        text.append(data[starts[k] : ends[stop - 1]].tobytes().decode(errors="surrogateescape"))
                        size.append(int(ends[stop - 1] - starts[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.string()), pa.array(whole, pa.bool_()), pa.array(text, pa.string()), pa.array(size, pa.int64())],
                names=["item", "whole", "words", "n"],
            )

    named = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return named.mapInArrow(run, "item string, whole boolean, words string, n long").distinct()


def _order(item: str | None) -> tuple[bool, str]:
    """Items in order of their ids, those without one last."""
    return item is None, item or ""


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bool, str]]]:
    """The pieces in blocks of about ``block_bytes``, one block at a time on the driver."""
    pieces = materialize(_pieces(benchmark), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n if total else 0):
        rows = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k).collect()
        yield sorted(((r.item, r.whole, r.words) for r in rows), key=lambda piece: (_order(piece[0]), *piece[1:]))


def find_contamination(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``documents`` with ``n_words``, ``hit_spans`` and ``hit_items``.

    ``hit_spans`` holds the merged runs of hit words as first, last + 1, first, ... counted
    from 0; ``hit_items`` the distinct ids of the items whose windows occur, null among them for
    items without an id. A null or empty text has no words and no hits. Items without words are never found; an empty
    benchmark finds nothing. Each block of the benchmark is one pass over the same rows,
    without a shuffle. Input columns with the names of the new ones are replaced.
    """
    new = {"n_words": "long", "hit_spans": "array<int>", "hit_items": "array<string>"}
    kept = [c for c in documents.columns if c not in new]
    schema = documents.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    out, any_block = documents.select(*kept), False
    for block in _blocks(benchmark, block_bytes):
        names = sorted({item for item, _, _ in block}, key=_order)
        number = {item: k for k, item in enumerate(names)}
        numbered = [(number[item], whole, text) for item, whole, text in block]
        shared = documents.sparkSession.sparkContext.broadcast((names, numbered))  # bounded by block_bytes
        out = out.mapInArrow(_searcher(shared, kept, any_block), schema)
        any_block = True
    if not any_block:
        out = out.mapInArrow(_searcher(documents.sparkSession.sparkContext.broadcast(([], [])), kept, False), schema)
    return out


def _searcher(shared, kept: list[str], again: bool):
    def run(batches):
        names, pieces = shared.value
        matcher = Matcher(pieces)
        for batch in batches:
            n_words, spans, items = [], [], []
            for part in textops.slices(batch.column("text")):
                n, s, i = matcher.hits(part)
                n_words.append(n)
                spans += s
                items += [[names[x] for x in own] for own in i]
            if again:
                spans = [_merge(a, b) for a, b in zip(spans, batch.column("hit_spans").to_pylist())]
                items = [sorted({*a, *b}, key=_order) for a, b in zip(items, batch.column("hit_items").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.array([x.tolist() if len(x) else [] for x in spans], pa.list_(pa.int32())),
                   pa.array(items, pa.list_(pa.string()))],
                names=[*kept, "n_words", "hit_spans", "hit_items"],
            )

    return run


def _merge(a: np.ndarray, b: list[int]) -> np.ndarray:
    """Union of two sets of runs."""
    runs = sorted(zip([*a[::2], *b[::2]], [*a[1::2], *b[1::2]]))
    out: list[list[int]] = []
    for first, last in runs:
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([int(first), int(last)])
    return np.array(out, np.int64).ravel()


def _n_hit() -> Column:
    """Words in all runs: ends count plus, beginnings minus."""
    signed = F.transform("hit_spans", lambda x, k: F.when(k % 2 == 0, -x).otherwise(x).cast("bigint"))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _judged(found: DataFrame) -> DataFrame:
    out = found.withColumn("n_hit", _n_hit())
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words")))


def contamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = _judged(find_contamination(documents.select("doc_id", "text"), benchmark))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"), "contaminated",
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, as they are."""
    names = ["_seen_" + c for c in documents.columns]
    safe = documents.toDF(*names).withColumn("text", F.col("_seen_text"))
    clean = _judged(find_contamination(safe, benchmark)).where(~F.col("contaminated"))
    return clean.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, documents.columns)])
