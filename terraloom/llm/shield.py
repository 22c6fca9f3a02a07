"""Columns that an operator does not need, kept out of the way of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shielded(rows: DataFrame, needed: tuple[str, ...]) -> tuple[DataFrame, Callable[..., list[Column]]]:
    """``rows`` with all but the ``needed`` columns renamed, and what selects the columns as they were.

    Whatever names an operator uses inside, the user's columns come through unchanged;
    ``restore(n_chars=...)`` puts new values into named ones.
    """
    own = {c: c if c in needed else f"_own_{k}" for k, c in enumerate(rows.columns)}
    safe = rows.select(*[F.col(f"`{c}`").alias(name) for c, name in own.items()])

    def restore(**fresh: Column) -> list[Column]:
        return [fresh.get(c, F.col(name)).alias(c) for c, name in own.items()]

    return safe, restore
