"""Points against boxes: grid-bucketed containment joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import in_box
from .prefilter import may_match


def _level(extent: Column) -> Column:
    """Power of two not below a box's longer side, so the box touches at most four cells."""
    return F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(F.lit(-40)).cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


_CELL = ["_level", "_cx", "_cy"]


def _filed(points: DataFrame, boxes: DataFrame, x: str, y: str, bounds: tuple[str, str, str, str]) -> tuple[DataFrame, DataFrame]:
    """Points with the cells they look into, and the boxes filed under their cells where a point looks.

    Every box is filed under the grid whose cell is just as wide as the box, so
    large and small boxes can mix. Points look into each grid in use; there are as
    many as there are powers of two among the box sizes. Boxes of cells that no point
    looks into go while they are scanned, before any exchange.
    """
    min_x, min_y, max_x, max_y = (F.col(b) for b in bounds)
    sized = boxes.where((max_x > min_x) & (max_y > min_y)).withColumn(
        "_level", _level(F.greatest(max_x - min_x, max_y - min_y))
    )
    levels = [r[0] for r in sized.select("_level").distinct().collect()]
    filed = sized.withColumn(
        "_cx", F.explode(F.sequence(_cell(min_x, F.col("_level")), _cell(max_x, F.col("_level"))))
    ).withColumn("_cy", F.explode(F.sequence(_cell(min_y, F.col("_level")), _cell(max_y, F.col("_level")))))
    px, py = F.col(x), F.col(y)
    grids = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")
    seeking = (
        points.where(px.isNotNull() & py.isNotNull())
        .withColumn("_level", F.explode(grids))
        .withColumns({"_cx": _cell(px, F.col("_level")), "_cy": _cell(py, F.col("_level"))})
    )
    return seeking, may_match(filed, seeking, _CELL)


def point_in_box(points: DataFrame, boxes: DataFrame, x: str, y: str, bounds: tuple[str, str, str, str]) -> DataFrame:
    """All (point, box) pairs with the point inside, as an equi-join on grid cells."""
    seeking, filed = _filed(points, boxes, x, y, bounds)
    inside = in_box(F.col(x), F.col(y), *(F.col(b) for b in bounds))
    return seeking.join(filed, _CELL).where(inside).drop(*_CELL)


def first_match(queries: DataFrame, boxes: DataFrame, box_id: str, bounds: tuple[str, str, str, str],
                x: str = "query_x", y: str = "query_y", carry: tuple[str, ...] = ()) -> DataFrame:
    """The containing box with the smallest id, per distinct query coordinate, with its ``carry`` columns.

    Equal coordinates are looked up once and boxes of equal bounds compete once, so
    neither a repeated query nor a stack of copies multiplies in the join. Of rows
    that repeat an id, the one with the smallest carried values counts.
    """
    spots = queries.select(x, y).distinct()
    seeking, filed = _filed(spots, boxes.select(*bounds, F.struct(box_id, *carry).alias("_box")), x, y, bounds)
    shapes = filed.groupBy(*_CELL, *bounds).agg(F.min("_box").alias("_box"))
    found = seeking.join(shapes, _CELL).where(in_box(F.col(x), F.col(y), *(F.col(b) for b in bounds)))
    return found.groupBy(x, y).agg(F.min("_box").alias("_box")).select(x, y, "_box.*")


def unmatched(queries: DataFrame, matched: DataFrame, on: list[str]) -> DataFrame:
    """Queries without a match."""
    return queries.join(matched.select(*on).distinct(), on, "left_anti")
