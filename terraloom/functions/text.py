"""Display numbers and tolerant JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def fixed(value: Column, places: int) -> Column:
    """Number with a fixed count of decimals and no grouping; '' where not finite."""
    return F.when(finite(value), F.format_string(f"%.{places}f", F.round(value, places))).otherwise(F.lit(""))


def json_or_empty(text: Column, ddl: str) -> Column:
    """Parse JSON; broken or missing text gives a struct of NULLs instead of failing."""
    return F.coalesce(F.from_json(text, ddl, {"mode": "PERMISSIVE"}), F.from_json(F.lit("{}"), ddl))
