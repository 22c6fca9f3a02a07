"""Pixel windows, patch grids and token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coordinate(name: str) -> Column:
    """A finite coordinate in double; a point without one fails the job instead of being misplaced."""
    c = F.col(name).cast("double")
    bad = F.raise_error(F.lit(f"point without a finite {name} coordinate")).cast("double")
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), c).otherwise(bad)


def window_bounds(col: Column, row: Column, width: Column, height: Column, a: Column, c: Column,
                  e: Column, f: Column) -> dict[str, Column]:
    """World bounds of a pixel window under a north-up transform with origin (c, f)."""
    return {
        "min_x": c + col * a,
        "min_y": f + (row + height) * e,
        "max_x": c + (col + width) * a,
        "max_y": f + row * e,
    }


def grid_side(tokens: Column) -> Column:
    """Side of the square patch grid held by ``tokens`` model tokens.

    A leading class token is dropped exactly when one token fewer is a square;
    otherwise the count itself must be one, and any other count fails the job.
    """
    less = F.round(F.sqrt(tokens - 1)).cast("int")
    whole = F.round(F.sqrt(tokens)).cast("int")
    return (
        F.when((tokens > 1) & (less * less == tokens - 1), less)
        .when(whole * whole == tokens, whole)
        .otherwise(F.raise_error(F.format_string("token count %d is not a perfect square", tokens)).cast("int"))
    )


def has_class_token(tokens: Column) -> Column:
    less = F.round(F.sqrt(tokens - 1)).cast("int")
    return (tokens > 1) & (less * less == tokens - 1)


def patch_tokens(tokens: Column) -> Column:
    """The token array without its leading class token, if it has one."""
    n = F.array_size(tokens)
    return F.when(has_class_token(n), F.slice(tokens, F.lit(2), n - 1)).otherwise(tokens)


def in_box(x: Column, y: Column, min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Half-open containment: lower edges belong to the box, upper edges do not."""
    return (min_x <= x) & (max_x > x) & (min_y <= y) & (max_y > y)
