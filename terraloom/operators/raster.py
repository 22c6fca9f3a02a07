"""Band maths, masks, statistics, validation, grids and stretches over pixel, block and header tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, paths
from ..session import lookup, materialize


def band(pixels: DataFrame, index: int, headers: DataFrame | None = None) -> DataFrame:
    """Pixels of one band, counted from 1.

    With ``headers`` a raster that lacks the band fails the job; a header table is
    tiny next to its pixels, and a single-band raster has only band 1.
    """
    if index < 1:
        raise ValueError("bands count from 1")
    picked = pixels.where(F.col("band") == index)
    if headers is None:
        return picked
    short = headers.where(F.col("band_count") < index).select("raster_id", "band_count").first()
    if short:
        raise ValueError(f"band {index} out of range for raster {short[0]} with {short[1]} bands")
    return picked


def ndvi_value(red: Column, nir: Column, inf: str = "keep") -> Column:
    """(nir - red) / (nir + red) in double; an undefined ratio or NaN input gives 0.

    A zero sum of unequal bands is signed infinity, or NULL with ``inf="null"``.
    """
    if inf not in ("keep", "null"):
        raise ValueError("inf must be 'keep' or 'null'")
    r, n = red.cast("double"), nir.cast("double")
    endless = F.when(n > r, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    if inf == "null":
        endless = F.lit(None).cast("double")
    return (
        F.when(r.isNull() | n.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(r) | F.isnan(n), F.lit(0.0))
        .when((n + r == 0) & (n == r), F.lit(0.0))
        .when(n + r == 0, endless)
        .otherwise((n - r) / F.nullif(n + r, F.lit(0.0)))
    )


def ndvi_bands(pixels: DataFrame, red_band: int = 1, nir_band: int = 2, inf: str = "keep") -> DataFrame:
    """NDVI per pixel of two bands of one pixel table.

    The bands are brought together by one aggregation instead of a self-join: one shuffle,
    not two. As in the join, a pixel needs a row in both bands, and a NULL value gives NULL.
    """
    wanted = pixels.where(F.col("band").isin(red_band, nir_band))
    both = wanted.groupBy("raster_id", "row", "col").agg(
        *[F.max(F.when(F.col("band") == band, F.col("value"))).alias(name) for band, name in ((red_band, "red"), (nir_band, "nir"))],
        F.max(F.col("band") == red_band).alias("_red"), F.max(F.col("band") == nir_band).alias("_nir"),
    )
    return both.where("_red AND _nir").select("raster_id", "row", "col", ndvi_value(F.col("red"), F.col("nir"), inf).alias("ndvi"))


def ndvi(red: DataFrame, nir: DataFrame, red_band: int = 1, nir_band: int = 1, inf: str = "keep") -> DataFrame:
    """NDVI per pixel of two pixel tables, aligned on raster, row and column; ``ndvi_bands`` serves two bands of one table."""
    left = band(red, red_band).select("raster_id", "row", "col", F.col("value").alias("red"))
    right = band(nir, nir_band).select("raster_id", "row", "col", F.col("value").alias("nir"))
    return left.join(right, ["raster_id", "row", "col"]).select(
        "raster_id", "row", "col", ndvi_value(F.col("red"), F.col("nir"), inf).alias("ndvi")
    )


def ndvi_blocks(blocks: DataFrame, red_band: int, nir_band: int, inf: str = "keep") -> DataFrame:
    """NDVI of multi-band blocks, as single-band float32 blocks: no shuffle, pixels stay packed."""
    pair = F.zip_with(
        F.element_at("bands", red_band),
        F.element_at("bands", nir_band),
        lambda r, n: ndvi_value(r, n, inf).cast("float").cast("double"),
    )
    return blocks.withColumns({"bands": F.array(pair), "dtype": F.lit("float32")})


def ndvi_pairs(red: DataFrame, nir: DataFrame, pairs: DataFrame, red_band: int = 1, nir_band: int = 1,
               inf: str = "keep") -> DataFrame:
    """NDVI of two different rasters, packed: blocks of the files of each pair meet on their place.

    ``pairs`` has ``pair_id, red_id, nir_id`` (raster ids). Blocks that only one side has give
    nothing: ``covered_pairs`` tells such pairs apart first.
    Pixels stay packed; the result's blocks carry the pair as ``raster_id`` and the red file's facts.
    """
    place = ["raster_id", "row_off", "col_off", "height", "width"]

    def side(blocks: DataFrame, key: str, band: int, name: str) -> DataFrame:
        own = pairs.select(F.col(key).alias("_file"), F.col("pair_id").alias("_pair"))
        out = blocks.withColumnRenamed("raster_id", "_file").join(own, "_file").withColumnRenamed("_pair", "raster_id").drop("_file")
        return out.withColumn(name, F.element_at("bands", band)).drop("bands")

    both = side(red, "red_id", red_band, "_red").join(side(nir, "nir_id", nir_band, "_nir").select(*place, "_nir"), place)
    values = F.zip_with("_red", "_nir", lambda r, n: ndvi_value(r, n, inf).cast("float").cast("double"))
    return both.withColumns({"bands": F.array(values), "dtype": F.lit("float32")}).drop("_red", "_nir")


def covered_pairs(red: DataFrame, nir: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``pairs`` (``pair_id, red_id, nir_id``) into those whose files have the same blocks and those with an ``error``.

    Only the places of blocks are read, joined full outer and counted on both sides, so a pair
    that would lose blocks in ``ndvi_pairs`` is named here instead. A file without blocks is missing.
    """
    def places(blocks: DataFrame, key: str, mark: str) -> DataFrame:
        own = pairs.select(F.col(key).alias("_file"), "pair_id")
        place = blocks.select(F.col("raster_id").alias("_file"), "row_off", "col_off", "height", "width")
        return place.join(own, "_file").drop("_file").withColumn(mark, F.lit(1))

    both = places(red, "red_id", "_r").join(places(nir, "nir_id", "_n"), ["pair_id", "row_off", "col_off", "height", "width"], "full")
    found = both.groupBy("pair_id").agg(
        F.count("_r").alias("red_blocks"), F.count("_n").alias("nir_blocks"), F.count_if(F.col("_r").isNotNull() & F.col("_n").isNotNull()).alias("common")
    )
    red_blocks, nir_blocks = F.coalesce("red_blocks", F.lit(0)), F.coalesce("nir_blocks", F.lit(0))
    error = (
        F.when((red_blocks == 0) | (nir_blocks == 0), F.format_string("no pixels of %s", F.concat_ws(
            " and ", F.when(red_blocks == 0, F.lit("red")), F.when(nir_blocks == 0, F.lit("nir")))))
        .when((F.col("common") < red_blocks) | (F.col("common") < nir_blocks), F.format_string(
            "red and nir differ in shape: %d of %d and %d blocks in common", "common", red_blocks, nir_blocks))
    )
    checked = pairs.join(found, "pair_id", "left").withColumn("error", error).select(*pairs.columns, "error")
    return checked.where("error IS NULL").drop("error"), checked.where("error IS NOT NULL")


def shape_check(red: DataFrame, nir: DataFrame, on: str = "raster_id") -> tuple[DataFrame, DataFrame]:
    """Split header pairs into those with equal grids and those without."""
    r = red.select(on, F.col("width").alias("red_width"), F.col("height").alias("red_height"))
    n = nir.select(on, F.col("width").alias("nir_width"), F.col("height").alias("nir_height"))
    pairs = r.join(n, on)
    same = (F.col("red_width") == F.col("nir_width")) & (F.col("red_height") == F.col("nir_height"))
    return pairs.where(same), pairs.where(~same)


def is_data(value: Column, nodata: Column) -> Column:
    """Whether a pixel is not the raster's nodata value; NaN nodata masks NaN pixels."""
    return (
        F.when(nodata.isNull(), F.lit(True))
        .when(F.isnan(nodata), ~F.isnan(value))
        .otherwise(F.isnan(value) | (value != nodata))
    )


def raster_stats(pixels: DataFrame, by: tuple[str, ...] = ("raster_id",), value: str = "value",
                 nodata: str | None = None) -> DataFrame:
    """min, max, mean and population std over all rows of a group, nodata left out.

    Partial aggregation collapses each task's pixels first, so one huge raster
    shuffles a few rows only. A fully masked raster keeps its row, with NULLs.
    """
    v = F.col(value).cast("double")
    if nodata:
        v = F.when(is_data(v, F.col(nodata)), v)
    return pixels.groupBy(*by).agg(
        F.min(v).alias("min_val"),
        F.max(v).alias("max_val"),
        F.avg(v).alias("mean_val"),
        F.stddev_pop(v).alias("std_val"),
        F.count(v).alias("pixels"),
    )


def block_stats(blocks: DataFrame, headers: DataFrame) -> DataFrame:
    """``raster_stats`` of packed blocks, all bands pooled, with the grid facts of the header.

    Pixels are reduced where they are; only one row per task and raster is shuffled.
    """
    pixels = blocks.select("raster_id", "nodata", F.explode(F.flatten("bands")).alias("value"))
    return raster_stats(pixels, nodata="nodata").join(
        headers.select("raster_id", "width", "height", "crs", "band_count"), "raster_id"
    )


def header_errors() -> Column:
    """The rules a header breaks; an empty reference system is tolerated."""
    rules = F.array(
        F.when(F.col("error").isNotNull(), F.concat(F.lit("unreadable: "), "error")),
        F.when(
            F.col("error").isNull() & ~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)),
            F.lit("invalid raster dimensions"),
        ),
    )
    return F.filter(rules, lambda e: e.isNotNull())


def validate(headers: DataFrame, skip: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split headers into good rows and quarantined rows with their ``errors``."""
    if "error" not in headers.columns:
        headers = headers.withColumn("error", F.lit(None).cast("string"))
    errors = F.array().cast("array<string>") if skip else header_errors()
    checked = headers.withColumn("errors", errors)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def _tile_columns(df: DataFrame, size: int) -> dict[str, Column]:
    """Index columns of the tile at ``col_off, row_off`` of a row carrying its raster's transform."""
    dataset = F.col("dataset_id") if "dataset_id" in df.columns else paths.dataset_name("path")
    tile = paths.tile_id(dataset, "col_off", "row_off")
    bounds = geometry.window_bounds(
        F.col("col_off"), F.col("row_off"), F.lit(size), F.lit(size), F.col("a"), F.col("c"), F.col("e"), F.col("f")
    )
    return {
        "dataset_id": dataset, "tile_id": tile, **{k: v.cast("double") for k, v in bounds.items()},
        "crs": F.coalesce(F.col("crs"), F.lit("None")), "tile_path": paths.tile_path(tile),
    }


def tile_grid(headers: DataFrame, size: int = 256, edges: bool = False) -> DataFrame:
    """Non-overlapping ``size`` x ``size`` windows, one row per tile.

    Windows crossing the right or bottom edge are left out unless ``edges`` is set.
    Pure expansion of the header table: no shuffle, and pixels are not touched.
    """
    whole = headers.where((F.col("width") > 0) & (F.col("height") > 0))
    last_col = F.col("width") - (1 if edges else size)
    last_row = F.col("height") - (1 if edges else size)
    if not edges:
        whole = whole.where((last_col >= 0) & (last_row >= 0))
    cells = whole.withColumn("col_off", F.explode(F.sequence(F.lit(0), last_col.cast("int"), F.lit(size)))).withColumn(
        "row_off", F.explode(F.sequence(F.lit(0), last_row.cast("int"), F.lit(size)))
    )
    return cells.select("raster_id", "col_off", "row_off", *[v.alias(k) for k, v in _tile_columns(cells, size).items()])


def tile_counts(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("dataset_id").agg(F.count("*").alias("tiles"))


def bbox(boxes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Common extent of all boxes, or one per group."""
    return boxes.groupBy(*by).agg(
        F.min("min_x").alias("min_x"), F.min("min_y").alias("min_y"),
        F.max("max_x").alias("max_x"), F.max("max_y").alias("max_y"),
    )


def patch_grid(tiles: DataFrame, grid: Column, width: Column, height: Column) -> DataFrame:
    """Split every tile into ``grid`` x ``grid`` patches; patch sizes may be fractions of a pixel.

    ``width`` and ``height`` are the tile's pixels; its upper left corner is (min_x, max_y).
    """
    g = F.col("_grid")
    steps = F.sequence(F.lit(0), g - 1)
    cells = (
        tiles.withColumns({"_grid": grid.cast("int"), "_w": width.cast("double"), "_h": height.cast("double")})
        .withColumn("patch_row", F.explode(steps))
        .withColumn("patch_col", F.explode(steps))
    )
    w, h = F.col("_w") / g, F.col("_h") / g
    a = (F.col("max_x") - F.col("min_x")) / F.col("_w")
    e = (F.col("min_y") - F.col("max_y")) / F.col("_h")
    bounds = geometry.window_bounds(
        F.col("patch_col") * w, F.col("patch_row") * h, w, h, a, F.col("min_x"), e, F.col("max_y")
    )
    return cells.withColumns(
        {"patch_id": paths.patch_id("tile_id", "patch_row", "patch_col"), **{f"patch_{k}": v for k, v in bounds.items()}}
    ).drop("_grid", "_w", "_h")


def rgb_bands(bands: Column) -> Column:
    """Three bands: the first three, or one repeated; two bands fail the job."""
    n = F.array_size(bands)
    return (
        F.when(n > 3, F.slice(bands, 1, 3))
        .when(n == 1, F.concat(bands, bands, bands))
        .when(n == 3, bands)
        .otherwise(F.raise_error(F.format_string("cannot make an image of %d bands", n)).cast("array<array<double>>"))
    )


def stretch_value(value: Column, low: Column, high: Column) -> Column:
    """Min-max stretch to 0..255, cut to whole numbers; a constant tile gives 0."""
    span = high - low
    return F.when(span == 0, F.lit(0.0)).otherwise(
        F.floor((value - low) / F.nullif(span, F.lit(0.0)) * 255).cast("double")
    )


def stretch_blocks(blocks: DataFrame) -> DataFrame:
    """Stretch each block over all its bands; 8-bit blocks stay as they are. No shuffle."""
    low = F.array_min(F.transform("bands", F.array_min))
    high = F.array_max(F.transform("bands", F.array_max))
    stretched = F.transform(
        "bands", lambda b: F.transform(b, lambda v: stretch_value(v, F.col("_low"), F.col("_high")))
    )
    return (
        blocks.withColumns({"_low": low, "_high": high})
        .withColumns({"bands": F.when(F.col("dtype") == "uint8", F.col("bands")).otherwise(stretched), "dtype": F.lit("uint8")})
        .drop("_low", "_high")
    )


def stretch_pixels(pixels: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Stretch a pixel table per group; the group minima and maxima are pre-aggregated and joined back."""
    v = F.col(value).cast("double")
    ranges = materialize(
        pixels.groupBy(*by).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count("*").alias("_rows")), "ranges"
    )
    joined = lookup(pixels, ranges, by, "_rows", "inner")
    return joined.withColumn("stretched", stretch_value(v, F.col("low"), F.col("high"))).drop("_rows")


# Channel means and deviations of image queries and of indexed tiles.
QUERY_MEAN, QUERY_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
TILE_MEAN, TILE_STD = (0.430, 0.411, 0.296), (0.213, 0.156, 0.143)


def standardize_value(value: Column, channel: int, kind: str = "tile") -> Column:
    """``(value / 255 - mean) / std`` of a channel counted from 0."""
    mean, std = {"tile": (TILE_MEAN, TILE_STD), "query": (QUERY_MEAN, QUERY_STD)}[kind]
    return (value / 255 - mean[channel]) / std[channel]


def standardize_blocks(blocks: DataFrame, kind: str = "tile") -> DataFrame:
    """Three-band 8-bit blocks to standardized channels."""

    def channel(i: int) -> Column:
        return F.transform(F.element_at("bands", i + 1), lambda v: standardize_value(v, i, kind))

    return blocks.withColumns({"bands": F.array(channel(0), channel(1), channel(2)), "dtype": F.lit("float64")})


def cut_tiles(blocks: DataFrame, size: int = 256) -> DataFrame:
    """Tile table with pixels, from blocks scanned with ``block=size``.

    Scanning at the tile size makes every full block one tile, and blocks carry
    their raster's transform, so tiles are a projection: no pixel is shuffled.
    """
    full = blocks.where((F.col("height") == size) & (F.col("width") == size))
    kept = ("raster_id", "dtype", "nodata", "a", "c", "e", "f", "row_off", "col_off", "height", "width", "bands")
    return full.select(*kept, *[v.alias(k) for k, v in _tile_columns(full, size).items()])
