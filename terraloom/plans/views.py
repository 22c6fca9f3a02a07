"""Domain tables derived from the shared business tables, for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Two-band rasters of 25 x 40 pixels: ``raster_id, row, col, b1, b2``."""
    return table(spark, sf, "events").select(
        F.expr("CAST(event_id DIV 1000 AS STRING)").alias("raster_id"),
        F.expr("CAST((event_id % 1000) DIV 40 AS INT)").alias("row"),
        F.expr("CAST(event_id % 40 AS INT)").alias("col"),
        F.col("value").alias("b1"),
        F.col("user_id").cast("double").alias("b2"),
    )


def band_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """The same rasters, one row per pixel and band."""
    wide = pixels(spark, sf)
    return wide.select("raster_id", "row", "col", F.posexplode(F.array("b1", "b2")).alias("at", "value")).select(
        "raster_id", "row", "col", (F.col("at") + 1).alias("band"), "value"
    )


def pixel_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Headers of ``pixels``: 40 x 25, two bands, origin (1000 * id, 1000), nodata 0."""
    ids = pixels(spark, sf).select("raster_id").distinct()
    return ids.select(
        "raster_id",
        F.concat(F.lit("raw/"), "raster_id", F.lit("/scene_"), "raster_id", F.lit(".b.tif")).alias("path"),
        F.lit(40).alias("width"), F.lit(25).alias("height"), F.lit(2).alias("band_count"), F.lit("float64").alias("dtype"),
        F.lit("EPSG:3857").alias("crs"), F.lit(0.0).alias("nodata"),
        F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), (F.col("raster_id").cast("double") * 1000).alias("c"),
        F.lit(0.0).alias("d"), F.lit(-1.0).alias("e"), F.lit(1000.0).alias("f"),
        F.lit(None).cast("string").alias("error"),
    )


def headers(spark: SparkSession, sf: str) -> DataFrame:
    """One raster per part, of many shapes; some have no width, no reference system or cannot be read."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("raster_id"),
        F.concat(F.lit("raw/part_"), F.col("p_partkey").cast("string"), F.lit(".tif")).alias("path"),
        ((F.col("p_size") - 1) * 10).cast("int").alias("width"),
        F.expr("CAST((p_partkey % 7) * 30 + 20 AS INT)").alias("height"),
        F.expr("CAST(p_partkey % 4 + 1 AS INT)").alias("band_count"),
        F.lit("uint16").alias("dtype"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'EPSG:3067' END").alias("crs"),
        F.lit(None).cast("double").alias("nodata"),
        F.lit(2.0).alias("a"), F.lit(0.0).alias("b"), (F.col("p_partkey") * 10).cast("double").alias("c"),
        F.lit(0.0).alias("d"), F.lit(-2.0).alias("e"), F.lit(5000.0).alias("f"),
        F.expr("CASE WHEN p_partkey % 11 = 5 THEN 'truncated' END").alias("error"),
    )


def patches(spark: SparkSession, sf: str) -> DataFrame:
    """One 64-wide patch per vector, 16 patches a tile, tiles in rows of eight."""
    t = "vec_id DIV 16"
    col, row = "(vec_id % 16) % 4", "(vec_id % 16) DIV 4"
    return table(spark, sf, "embeddings").select(
        F.lit("emb").alias("dataset_id"),
        F.expr(f"concat('tile_', {t})").alias("tile_id"),
        F.expr(f"concat('tile_', {t}, '.tif')").alias("tile_path"),
        F.expr(f"concat('tile_', {t}, '_r', {row}, '_c', {col})").alias("patch_id"),
        F.expr(f"CAST({row} AS INT)").alias("patch_row"),
        F.expr(f"CAST({col} AS INT)").alias("patch_col"),
        F.expr(f"CAST(({t}) % 8 * 256 + ({col}) * 64 AS DOUBLE)").alias("patch_min_x"),
        F.expr(f"CAST(10000 - ({t}) DIV 8 * 256 - ({row}) * 64 - 64 AS DOUBLE)").alias("patch_min_y"),
        F.expr(f"CAST(({t}) % 8 * 256 + ({col}) * 64 + 64 AS DOUBLE)").alias("patch_max_x"),
        F.expr(f"CAST(10000 - ({t}) DIV 8 * 256 - ({row}) * 64 AS DOUBLE)").alias("patch_max_y"),
        "embedding",
    )


def patch_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The tile boxes holding ``patches``."""
    return (
        patches(spark, sf)
        .groupBy("dataset_id", "tile_id", "tile_path")
        .agg(
            F.min("patch_min_x").alias("min_x"), F.min("patch_min_y").alias("min_y"),
            F.max("patch_max_x").alias("max_x"), F.max("patch_max_y").alias("max_y"),
        )
    )


def coords(spark: SparkSession, sf: str) -> DataFrame:
    """One map point per customer, on the patches' plane; many fall outside or on shared edges."""
    return table(spark, sf, "customer").select(
        F.expr("CAST(c_custkey % 37 * 64 AS DOUBLE)").alias("query_x"),
        F.expr("CAST(10000 - c_nationkey * 64 AS DOUBLE)").alias("query_y"),
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.lit("customers").alias("cloud_id"),
        F.col("c_custkey").alias("point_id"),
        (F.col("c_acctbal") / 100).alias("x"),
        F.expr("CAST(c_custkey % 97 AS DOUBLE)").alias("y"),
        F.col("c_nationkey").cast("double").alias("z"),
    )


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """Landed paths, several per id, with mixed extensions."""
    return table(spark, sf, "events").select(
        "event_id", "ts", F.col("user_id").cast("string").alias("file_id"),
        F.expr(
            "concat('raw/', date_format(ts, 'yyyyMMdd_HHmmss'), '_', user_id, '/', event_type, '.v', event_id,"
            " element_at(array('.tif', '.LAS', '.csv', '.txt', '.las'), CAST(event_id % 5 AS INT) + 1))"
        ).alias("path"),
    )


def lonlat(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.expr("24 + (c_custkey % 600) / 100.0D").alias("lon"),
        F.expr("60 + c_nationkey / 10.0D").alias("lat"),
    )
