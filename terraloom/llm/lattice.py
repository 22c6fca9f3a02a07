"""Lattice hashing of vectors: random projections decoded to points of the E8 lattice.

A table projects a vector on some blocks of eight random orthonormal directions and
decodes each eight to the nearest lattice point; the points name the vector's cell. Two
close vectors can only lie in different cells if one of them is near the wall between
them, so vectors near a wall probe the cell behind it.

``resolution`` fits blocks and tables to the number of vectors: each further block makes
cells finer, so that a vector meets a bounded number of strangers however many there are,
and more tables make up for the neighbours that finer cells part.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

#: Strangers a vector may meet in a table, and the share of pairs at the wanted similarity that may meet in no table.
STRANGERS = 4.0
MISSED = 0.0002
#: Fewest and most blocks of a table; with the most, the share of cells two strangers have in common is about 1e-15.
FEWEST, MOST = 2, 6
#: Lattice units per unit of length, and from which distance to a wall the cell behind it is probed.
SCALE = 4.0
MARGIN = 0.12
_U = np.uint64


@functools.cache
def shortest() -> np.ndarray:
    """The 240 shortest lattice vectors: two entries of +-1, or all +-1/2 with an even number of minus signs."""
    whole = [np.eye(8)[i] * a + np.eye(8)[j] * b for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    half = [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(whole + half)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer entries of even sum: round, and if the sum is odd, round the worst entry the other way."""
    r = np.rint(x)
    off = x - r
    worst = np.argmax(np.abs(off), axis=1)
    rows = np.arange(len(x))
    odd = r.sum(1) % 2 != 0
    other = np.where(off[rows, worst] >= 0, 1.0, -1.0)
    r[rows, worst] += np.where(odd, other, 0.0)
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point: the better of D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


@functools.cache
def directions(dims: int, table: int, count: int, seed: int = 20) -> np.ndarray:
    rng = np.random.default_rng([seed, table, dims])
    q, _ = np.linalg.qr(rng.normal(size=(max(dims, 8 * count), 8 * count)))
    return q[:dims] * np.sqrt(dims / 64.0)


def _hash(points: np.ndarray) -> np.ndarray:
    """64-bit name of each row of lattice points (doubled, so whole numbers)."""
    h = np.zeros(len(points), np.uint64)
    for column in np.rint(points * 2).astype(np.int64).T.astype(np.uint64):
        h = (h ^ column) * _U(0x9E3779B97F4A7C15)
        h ^= h >> _U(29)
    return h


def cells(unit: np.ndarray, table: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each unit vector in a table of ``count`` blocks; and for probes, the row and the cell probed."""
    n = len(unit)
    # Rounded, so that a product's last bits, which may depend on the batch, never move a point to another cell.
    x = np.round(unit @ directions(unit.shape[1], table, count) * SCALE, 6)
    home, rows, probes = np.zeros(n, np.uint64), [], []
    near = []
    for b in range(count):
        part = x[:, 8 * b : 8 * b + 8]
        point = nearest(part)
        own = _hash(point)
        wall = (1.0 - (part - point) @ shortest().T) / np.sqrt(2.0)
        row, v = np.nonzero(wall < MARGIN)
        near.append((own, row, _hash(point[row] + shortest()[v])))
    for b in range(count):
        home = _join(home, near[b][0])
    for b in range(count):
        row = near[b][1]
        other = np.zeros(len(row), np.uint64)
        for c in range(count):
            other = _join(other, near[b][2] if c == b else near[c][0][row])
        rows.append(row)
        probes.append(other)
    return home, np.concatenate(rows), np.concatenate(probes)


def _join(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h * _U(31) + more) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


@functools.cache
def _shares(similarity: float) -> tuple[float, list[float]]:
    """Per table: the share of pairs of strangers that lie in one block's cell; and for each number of blocks from ``FEWEST`` on, the share
    of pairs at ``similarity`` that meet. Measured on random vectors of 64 dimensions, to which ``directions`` scales others."""
    rng = np.random.default_rng(64)
    a, b = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, 4000, 64)))
    b -= (a * b).sum(1, keepdims=True) * a
    b = similarity * a + np.sqrt(max(1 - similarity * similarity, 0.0)) * b / np.linalg.norm(b, axis=1, keepdims=True)
    names = np.sort(_hash(nearest(a @ directions(64, 0, 1) * SCALE)))
    copies = np.unique(names, return_counts=True)[1].astype(float)
    same = max((copies * (copies - 1)).sum() / (len(a) * (len(a) - 1.0)), 1e-7)
    meet = []
    for count in range(FEWEST, MOST + 1):
        found = []
        for table in range(2):
            home_a, row_a, probe_a = cells(a, table, count)
            home_b, row_b, probe_b = cells(b, table, count)
            met = home_a == home_b
            met[row_a[probe_a == home_b[row_a]]] = True
            met[row_b[probe_b == home_a[row_b]]] = True
            found.append(met.mean())
        meet.append(float(np.mean(found)))
    return float(same), meet


def resolution(vectors: int, similarity: float) -> tuple[int, int]:
    """Blocks of a table and number of tables for that many vectors to be told apart.

    Blocks are the fewest with at most ``STRANGERS`` strangers of a vector in its cell, tables as many as leave
    at most ``MISSED`` of the pairs at ``similarity`` without a meeting.
    """
    same, meet = _shares(similarity)
    count = FEWEST
    while count < MOST and vectors * same**count > STRANGERS:
        count += 1
    share = min(max(meet[count - FEWEST], 1e-3), 0.999)
    return count, max(2, int(np.ceil(np.log(MISSED) / np.log(1 - share))))
