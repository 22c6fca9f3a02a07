"""Raster scans: headers, pixel blocks and pixels out of file bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..schemas import RASTER_BLOCK, RASTER_HEADER
from . import geotiff

#: Bytes of encoded files that a task gives on at once.
OUT_BYTES = 8 << 20

_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
_HEADER = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in RASTER_HEADER.split(", "))])


def _with_id(blobs: DataFrame) -> DataFrame:
    """Rasters are named after their whole path, so equal file names in two folders stay apart."""
    if "raster_id" in blobs.columns:
        return blobs
    return blobs.withColumn("raster_id", F.coalesce(paths.landed_id("path"), F.col("path")))


def raster_headers(blobs: DataFrame, keep: tuple[str, ...] = (), pixels: bool = False) -> DataFrame:
    """One header row per file; an unreadable file keeps its row, with ``error`` set.

    With ``pixels`` the pixels are decoded too, so that a file whose chunks are short or
    broken is found here; a rotated grid, which blocks and bounds cannot state, is an error too.
    ``keep`` names columns passed through, so that landing can store headers and
    bytes in one pass over the files.
    """
    named = _with_id(blobs)
    extra = [f"{f.name} {f.dataType.simpleString()}" for f in named.select(*keep).schema.fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raster, path, data in zip(batch["raster_id"].to_pylist(), batch["path"].to_pylist(), batch["_content"]):
                row = {"raster_id": raster, "path": path}
                try:
                    head = geotiff.read_header(data.as_buffer())
                    row.update(head)
                    if head["b"] or head["d"]:
                        raise ValueError("rotated grids are not supported")
                    if pixels:
                        geotiff.read_array(data.as_buffer())
                except Exception as problem:
                    row["error"] = f"{type(problem).__name__}: {problem}"
                rows.append(row)
            heads = pa.RecordBatch.from_pylist(rows, _HEADER)
            yield pa.RecordBatch.from_arrays(
                [*heads.columns, *(batch[c] for c in keep)], [*_HEADER.names, *keep]
            )

    columns = list(dict.fromkeys(["raster_id", "path", *keep]))
    return named.select(*columns, F.col("content").alias("_content")).mapInArrow(scan, ", ".join([RASTER_HEADER, *extra]))


def raster_bounds(headers: DataFrame) -> DataFrame:
    """(left, bottom, right, top) per raster."""
    c, f = F.col("c"), F.col("f")
    return headers.select(
        "raster_id",
        c.alias("min_x"),
        (f + F.col("e") * F.col("height")).alias("min_y"),
        (c + F.col("a") * F.col("width")).alias("max_x"),
        f.alias("max_y"),
    )


def raster_blocks(blobs: DataFrame, block: int = 256) -> DataFrame:
    """Cut every raster into ``block`` x ``block`` windows of all bands; edge windows are smaller.

    Blocks carry the facts of their raster, so nothing downstream has to shuffle
    pixels to find them. Files that cannot be read whole give no blocks: take them from
    ``raster_headers`` with ``pixels``.
    """
    names = [c.split()[0] for c in RASTER_BLOCK.split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raster, path, data in zip(batch["raster_id"], batch["path"], batch["content"]):
                try:
                    head = geotiff.read_header(data)
                    pixels = geotiff.read_array(data)
                except Exception:
                    continue
                if head["b"] or head["d"]:
                    continue
                facts = (raster, path, *(head[k] for k in ("dtype", "crs", "nodata", "a", "c", "e", "f")))
                for row in range(0, head["height"], block):
                    out = []
                    for col in range(0, head["width"], block):
                        part = pixels[:, row : row + block, col : col + block]
                        values = part.reshape(part.shape[0], -1).astype("float64")
                        out.append((*facts, row, col, part.shape[1], part.shape[2], list(values)))
                    yield pd.DataFrame(out, columns=names).astype({"nodata": "float64"})

    return _with_id(blobs).select("raster_id", "path", "content").mapInPandas(scan, RASTER_BLOCK)


def raster_pixels(blocks: DataFrame) -> DataFrame:
    """One row per pixel and band; bands count from 1."""
    bands = blocks.select(
        "raster_id", "row_off", "col_off", "width", F.posexplode("bands").alias("band_at", "cells")
    )
    cells = bands.select("*", F.posexplode("cells").alias("at", "value"))
    return cells.select(
        "raster_id",
        (F.col("row_off") + F.floor(F.col("at") / F.col("width"))).cast("int").alias("row"),
        (F.col("col_off") + F.col("at") % F.col("width")).cast("int").alias("col"),
        (F.col("band_at") + 1).alias("band"),
        "value",
    )


def blocks_to_blobs(blocks: DataFrame, dest: str) -> DataFrame:
    """Encode block rows as raster files below ``dest``, one per block, each with its own origin."""
    name = F.col("tile_path") if "tile_path" in blocks.columns else F.concat("raster_id", F.lit(".tif"))
    return blocks.select(
        paths.join_uri(F.lit(dest), name).alias("out"),
        "dtype", "row_off", "col_off", "height", "width", "bands", "a", "c", "e", "f", "crs", "nodata",
    ).mapInArrow(_encoded, "path string, content binary")


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of packed blocks, some ``OUT_BYTES`` of them at a time whatever the size of the batches."""
    for batch in batches:
        out, held = [], 0
        facts, bands = batch.drop_columns(["bands"]), batch["bands"]
        for r, packed in zip((row for at in range(0, batch.num_rows, 64) for row in facts.slice(at, 64).to_pylist()), bands):
            array = packed.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, r["height"], r["width"]).astype(r["dtype"])
            code = int(r["crs"].split(":")[1]) if r["crs"] and r["crs"].startswith("EPSG:") else None
            nodata = None if pd.isna(r["nodata"]) else r["nodata"]
            x, y = r["c"] + r["col_off"] * r["a"], r["f"] + r["row_off"] * r["e"]
            out.append((r["out"], geotiff.write(array, r["a"], x, r["e"], y, code, nodata)))
            held += len(out[-1][1])
            if held >= OUT_BYTES:
                yield _blobs(out)
                out, held = [], 0
        if out:
            yield _blobs(out)


def _blobs(files: list[tuple[str, bytes]]) -> pa.RecordBatch:
    paths_, contents = zip(*files)
    return pa.RecordBatch.from_arrays([pa.array(paths_, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
