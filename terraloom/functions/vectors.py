"""Vector arithmetic on array columns, in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(u: Column, v: Column) -> Column:
    return _sum(F.zip_with(u, v, lambda a, b: a.cast("double") * b.cast("double")))


def l2_norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def unit(v: Column) -> Column:
    """Unit vector in double; a zero vector is returned unchanged."""
    norm = l2_norm(v)
    return F.transform(v, lambda x: x.cast("double") / F.when(norm == 0, F.lit(1.0)).otherwise(norm))


def cosine(u: Column, v: Column) -> Column:
    return dot(unit(u), unit(v))


def dimension(v: Column) -> Column:
    """Vector length, NULL for a NULL vector."""
    return F.array_size(v)
