"""Eigen decomposition of neighbourhood covariances, and shape features from it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def covariances(group: np.ndarray, points: np.ndarray, groups: int) -> np.ndarray:
    """Population covariance of the points of each group, shaped (group, 3, 3); 0 for an empty one."""
    count = np.maximum(np.bincount(group, minlength=groups), 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(group, values, groups) / count

    centred = points - np.stack([mean(points[:, a]) for a in range(3)], axis=1)[group]
    out = np.zeros((groups, 3, 3))
    for i in range(3):
        for j in range(i, 3):
            out[:, i, j] = out[:, j, i] = mean(centred[:, i] * centred[:, j])
    return out


def symmetric_eigen(matrices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first and not below 0, and the unit eigenvector of the smallest, turned upwards.

    A zero matrix has no direction of its own and gets +z.
    """
    values, vectors = np.linalg.eigh(matrices)
    values = np.maximum(values[:, ::-1], 0.0)
    normal = vectors[:, :, 0]
    normal = np.where(normal[:, 2:] < 0, -normal, normal) + 0.0
    normal[values[:, 0] <= 0] = (0.0, 0.0, 1.0)
    return values, normal


def shape_features() -> dict[str, Column]:
    """Features derived from ``l1, l2, l3``; all 0 where the neighbourhood has no extent."""
    l1, l2, l3 = F.col("l1"), F.col("l2"), F.col("l3")
    total = l1 + l2 + l3

    def guarded(value: Column) -> Column:
        return F.when(l1 <= 0, F.lit(0.0)).otherwise(value)

    def entropy(v: Column) -> Column:
        share = v / total
        return F.when(share > 0, -share * F.log(share)).otherwise(F.lit(0.0))

    return {
        "linearity": guarded((l1 - l2) / l1),
        "planarity": guarded((l2 - l3) / l1),
        "sphericity": guarded(l3 / l1),
        "anisotropy": guarded((l1 - l3) / l1),
        "omnivariance": guarded(F.cbrt(l1 * l2 * l3)),
        "eigenentropy": guarded(entropy(l1) + entropy(l2) + entropy(l3)),
        "eigen_sum": guarded(total),
        "curvature": guarded(l3 / total),
    }
