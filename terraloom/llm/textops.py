"""Words and word runs of whole batches of texts, found with array operations on their UTF-8 bytes.

Used inside Arrow batches only. A batch is worked on in slices of bounded bytes, so
memory follows the slice (or one long text), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a single longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: digits, lower-case letters and everything outside ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


class Slice:
    """The bytes of texts ``first`` to ``first + len(offsets) - 2`` of a batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.n = data, offsets, first, len(offsets) - 1

    def docs(self, positions: np.ndarray) -> np.ndarray:
        """Index within the slice of the text that holds each byte position."""
        return np.searchsorted(self.offsets, positions, "right") - 1


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All text bytes of a string column and where each text starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[Slice]:
    data, offsets = flat(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
        yield Slice(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first)
        first = last


def bounds(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 position of each run of true bytes; runs end where a text ends."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    first[edges] = member[edges]
    last[edges - 1] = member[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _powers(base: np.uint64, n: int, kept: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    have = kept.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * SLICE_BYTES:
            kept[int(base)] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which the hash of any byte run follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data) + 1)[: len(data)], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes, wherever in the batch it stands."""
    raw = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(sums))[starts]
    return mix(raw ^ (ends - starts).astype(np.uint64))


def text_hash(text: str) -> int:
    """The hash that ``run_hashes`` gives for a run holding exactly this text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return int(run_hashes(prefix_sums(data), np.array([0]), np.array([len(data)]))[0])


def words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contract words of a slice: start, end, text index and hash; A-Z count as a-z."""
    low = LOWER[part.data]
    starts, ends = bounds(WORD[low], part.offsets)
    hashes = run_hashes(prefix_sums(low), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return starts, ends, part.docs(starts), hashes


def ngrams(hashes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` items inside one text, and the index of its first item."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(docs[: len(docs) - n + 1] == docs[n - 1 :])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[at + k]
    return mix(out ^ np.uint64(n)), at
