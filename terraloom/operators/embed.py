"""Patch vectors from tile pixels through a user's model function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, paths, vectors
from . import raster

Model = Callable[[np.ndarray], np.ndarray]


def model_tokens(blocks: DataFrame, model: Callable[[], Model], keep: tuple[str, ...]) -> DataFrame:
    """Run a model over image blocks: ``keep`` columns and ``tokens`` (one vector per token).

    ``model()`` is called once per task and returns a function from images shaped
    (image, channel, row, column) to tokens shaped (image, token, value).
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.select(*keep).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apply = model()
        for batch in batches:
            for _, same in batch.groupby(["height", "width"], sort=False):
                for at in range(0, len(same), 32):
                    part = same.iloc[at : at + 32]
                    h, w = int(part["height"].iloc[0]), int(part["width"].iloc[0])
                    images = np.stack([np.stack([np.asarray(b) for b in bands]).reshape(-1, h, w) for bands in part["bands"]])
                    out = part[list(keep)].copy()
                    out["tokens"] = [[row for row in t] for t in np.asarray(apply(images), "float32")]
                    yield out

    columns = list(dict.fromkeys([*keep, "height", "width", "bands"]))
    return blocks.select(*columns).mapInPandas(run, f"{schema}, tokens array<array<float>>")


def prepare(blocks: DataFrame, kind: str) -> DataFrame:
    """Three 8-bit bands, standardized for index tiles (``tile``) or image queries (``query``)."""
    image = blocks.withColumn("bands", raster.rgb_bands(F.col("bands")))
    return raster.standardize_blocks(raster.stretch_blocks(image), kind)


def embed_tiles(tiles: DataFrame, model: Callable[[], Model], grid: int | None = None) -> DataFrame:
    """Patch table of a tile table with pixels: one normalised vector per patch.

    ``raster_id`` is kept where the tiles have it: ids of patches repeat between equally named rasters.

    A leading class token is dropped when the rest is a square grid; ``grid`` states
    the grid for models with other leading tokens, and keeps the last ``grid²`` ones.
    """
    own = ("raster_id",) if "raster_id" in tiles.columns else ()
    keep = ("dataset_id", *own, "tile_id", "tile_path", "min_x", "min_y", "max_x", "max_y", "height", "width")
    tokens = model_tokens(prepare(tiles, "tile"), model, keep)
    n = F.array_size("tokens")
    if grid is None:
        side, patch = geometry.grid_side(n), geometry.patch_tokens(F.col("tokens"))
    else:
        side, patch = F.lit(grid), F.slice("tokens", n - grid * grid + 1, F.lit(grid * grid))
    gridded = raster.patch_grid(tokens.withColumns({"_side": side, "_patch": patch}), F.col("_side"), F.col("width"), F.col("height"))
    at = F.col("patch_row") * F.col("_side") + F.col("patch_col")
    return gridded.select(
        "dataset_id", *own, "tile_id", "tile_path", "patch_id", "patch_row", "patch_col",
        "patch_min_x", "patch_min_y", "patch_max_x", "patch_max_y",
        vectors.unit(F.get("_patch", at)).cast("array<float>").alias("embedding"),
    )


def embed_images(images: DataFrame, model: Callable[[], Model], path: str = "path") -> DataFrame:
    """Query vectors of image blocks: each image's first (class) token, as ``query_id, vector``.

    Index rows hold patch tokens; comparing them with class tokens is the caller's choice.
    """
    tokens = model_tokens(prepare(images, "query"), model, (path,))
    return tokens.select(F.col(path).alias("query_id"), F.element_at("tokens", 1).alias("vector"))


def mean_colour_model(grid: int = 3) -> Callable[[], Model]:
    """Deterministic stand-in for a trained model: a class token and ``grid²`` mean colours.

    It shows the calling convention and serves tests; its vectors mean nothing more.
    """

    def load() -> Model:
        def apply(images: np.ndarray) -> np.ndarray:
            rows = np.array_split(images, grid, axis=2)
            cells = [c.mean(axis=(2, 3)) for r in rows for c in np.array_split(r, grid, axis=3)]
            return np.stack([images.mean(axis=(2, 3)), *cells], axis=1)

        return apply

    return load
