"""A bounded kd partitioning of point clouds, so that dense and empty regions get equal tasks."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass
class SpaceTree:
    """Complete binary tree of axis cuts in heap order; leaf numbers follow from the path."""

    axes: np.ndarray
    cuts: np.ndarray
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, leaves: int) -> SpaceTree:
        """Halve the sample at the middle of its widest axis until there are ``leaves`` parts.

        Points level on that axis are told apart by the next widest ones, so a wall or a
        filled coordinate is halved too; only full copies of a point stay together.
        """
        depth = max(math.ceil(math.log2(max(leaves, 1))), 0)
        axes = np.tile(np.arange(sample.shape[1]), (2**depth, 1))
        cuts = np.full(axes.shape, np.inf)
        parts = {1: sample}
        for node in range(1, 2**depth):
            rows = parts.pop(node)
            if len(rows) > 1:
                axes[node] = np.argsort(-np.ptp(rows, axis=0), kind="stable")
                along = rows[:, axes[node]]
                cuts[node] = along[np.lexsort(along.T[::-1])[len(along) // 2]]
            right = _at_or_after(rows[:, axes[node]], cuts[node])
            parts[2 * node], parts[2 * node + 1] = rows[~right], rows[right]
        return cls(axes, cuts, depth)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            right = _at_or_after(np.take_along_axis(points, self.axes[node], 1), self.cuts[node])
            node = 2 * node + right
        return node - 2**self.depth

    def room(self, points: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """How far each point is from the nearest wall of its leaf; smaller balls stay inside."""
        low = np.full((2 ** (self.depth + 1), points.shape[1]), -np.inf)
        high = -low
        for node in range(1, 2**self.depth):
            axis, cut = self.axes[node, 0], self.cuts[node, 0]
            for child in (2 * node, 2 * node + 1):
                low[child], high[child] = low[node], high[node]
            high[2 * node, axis] = low[2 * node + 1, axis] = cut
        own = leaf + 2**self.depth
        return np.minimum(points - low[own], high[own] - points).min(axis=1)

    def reach(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) pairs for every leaf a ball around a point enters."""
        who = np.arange(len(points))
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            at = points[who, self.axes[node, 0]]
            left = at - radius[who] <= self.cuts[node, 0]
            right = at + radius[who] >= self.cuts[node, 0]
            who, node = np.concatenate([who[left], who[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        return who, node - 2**self.depth


def _at_or_after(along: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Whether each row is at or after the cut, compared coordinate by coordinate."""
    cut = np.broadcast_to(cut, along.shape)
    out = np.ones(len(along), bool)
    for k in reversed(range(along.shape[1])):
        out = np.where(along[:, k] == cut[:, k], out, along[:, k] > cut[:, k])
    return out
