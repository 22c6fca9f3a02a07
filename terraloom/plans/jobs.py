"""Whole jobs: tiling, embedding, similarity search, ingest and point cloud enrichment."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import catalog, dbscan, embed, neighbours, raster, similarity
from ..schemas import RASTER_HEADER
from ..session import lookup, materialize, shuffled
from ..sources import files, pointclouds, rasters, tables


def tile_rasters(blobs: DataFrame, out_dir: str, size: int = 256) -> DataFrame:
    """Cut raster files into full tiles; writes ``tiles`` (with pixels) and ``index`` tables, returns the index.

    Tables have as many files as tasks, not a folder per raster; a raster's rows lie together.
    """
    cut = raster.cut_tiles(rasters.raster_blocks(blobs, size), size)
    stored = tables.write_table(cut, f"{out_dir}/tiles")
    index = stored.select("dataset_id", "raster_id", "tile_id", "min_x", "min_y", "max_x", "max_y", "crs", "tile_path")
    return tables.write_table(index, f"{out_dir}/index")


def compute_embeddings(spark: SparkSession, tiles_dir: str, out_dir: str, model: Callable, grid: int | None = None) -> DataFrame:
    """Patch table of a tile folder written by ``tile_rasters``, with its quality summary beside it."""
    stored = spark.read.parquet(f"{tiles_dir}/tiles")
    patches = tables.write_table(embed.embed_tiles(stored, model, grid), f"{out_dir}/patches")
    qa = catalog.qa_metrics(spark.read.parquet(f"{tiles_dir}/index"), patches, tiles_dir, out_dir)
    tables.write_json_summary(qa, f"{out_dir}/qa_metrics")
    return patches


def find_similar_patches(patches: DataFrame, path_vectors: DataFrame | None = None, coords: DataFrame | None = None,
                         tiles: DataFrame | None = None, k: int = 5, exclude_self: bool = False,
                         strict: bool = True) -> DataFrame:
    """Match table for image query vectors and for map coordinates, both optional but not both absent."""
    if path_vectors is None and coords is None:
        raise ValueError("no query inputs: give path vectors or coordinates")
    tables.require_columns(patches, {"embedding", "patch_id", "tile_id"}, "patch table")
    if tiles is not None:
        tables.require_columns(tiles, tables.TILE_COLUMNS, "tile index")
    usable = similarity.non_null_embedding(patches)
    if usable.isEmpty():
        raise ValueError("patch table has no embeddings to search")
    by_path = by_coord = None
    if path_vectors is not None:
        by_path = similarity.matches(usable, path_vectors, k, tiles)
    if coords is not None:
        by_coord = coordinate_matches(usable, coords, tiles, k, exclude_self, strict)
    return similarity.union_results(by_path, by_coord)


def coordinate_matches(patches: DataFrame, coords: DataFrame, tiles: DataFrame | None = None, k: int = 5,
                       exclude_self: bool = False, strict: bool = True) -> DataFrame:
    """Matches of each coordinate; points in the same patch share one search.

    The k matches of a patch are packed into one row, so handing them out to many
    coordinates, and those to many repeated queries, are one-to-many lookups.
    """
    vectors, _ = similarity.coords_to_vectors(coords, patches, tiles, strict)
    found = materialize(vectors.drop("patch_id").withColumnRenamed("patch_key", "query_id"), "coords")
    seeds = found.groupBy("query_id").agg(F.any_value("vector").alias("vector"), F.count("*").alias("spots"))
    hits = similarity.matches(patches, seeds.select("query_id", "vector"), k, tiles, exclude_self)
    packed = hits.groupBy("query_id").agg(F.collect_list(F.struct(*[c for c in hits.columns if c != "query_id"])).alias("hits"))
    packed = materialize(packed.join(seeds.select("query_id", "spots"), "query_id"), "hits")
    spots = lookup(found.select("query_x", "query_y", "query_id", "copies"), packed, ["query_id"], "spots", "inner")
    spots = materialize(spots.select("query_x", "query_y", "query_id", "copies", "hits"), "spots")
    return lookup(coords.select("query_x", "query_y"), spots, ["query_x", "query_y"], "copies", "inner").select(
        "query_id", "query_x", "query_y", F.inline("hits")
    )


def ingest_rasters(blobs: DataFrame, table_dir: str, dest: str = "raw", red_band: int = 1, nir_band: int = 1,
                   skip_validation: bool = False, block: int = 256) -> dict[str, DataFrame]:
    """Land files, validate, derive NDVI, and collect statistics, catalog rows and the ingest log.

    Files that cannot be read whole, or lack a band asked for, are logged with the reason
    and give no statistics.
    Source bytes are read once, into the landed table, together with their headers;
    later steps read the columns they need from there. Pixels are never shuffled.
    Each call adds one ``batch`` to every table and returns the rows of that batch.
    """
    batch = uuid.uuid4().hex

    def store(df: DataFrame, name: str) -> DataFrame:
        return tables.write_table(df, f"{table_dir}/{name}/batch={batch}")

    incoming = files.land_files(blobs, dest).withColumn("raster_id", F.col("file_id"))
    with_headers = rasters.raster_headers(incoming, ("content", "file_id", "source_path", "filename", "ingested_at"), pixels=True)
    most = max(red_band, nir_band)
    short = F.format_string(f"band {most} out of range for %d bands", "band_count")
    with_headers = with_headers.withColumn("error", F.coalesce("error", F.when(F.col("band_count") < most, short)))
    landed = files.write_landed(with_headers, f"{table_dir}/landed", batch)
    headers = landed.drop("content")
    good, bad = raster.validate(headers, skip_validation)
    good = good.where("error IS NULL")
    blocks = rasters.raster_blocks(landed.where("error IS NULL").select("raster_id", "path", "content"), block)
    index = raster.ndvi_blocks(blocks, red_band, nir_band)
    index = store(index.withColumn("path", paths.processed_path("path", F.col("raster_id"))), "ndvi")
    index_headers = good.withColumns({"band_count": F.lit(1), "dtype": F.lit("float32")})
    raw_stats = store(raster.block_stats(blocks, good), "raw_stats")
    processed = raster.block_stats(index, index_headers)
    metrics = store(catalog.metrics_side_by_side(raw_stats, processed), "metrics")
    rows = catalog.catalog_rows(
        raw_stats.withColumnRenamed("raster_id", "file_id"), landed.select("file_id", "path", "ingested_at")
    )
    return {
        "landed": landed,
        "headers": headers.select(*[c.split()[0] for c in RASTER_HEADER.split(", ")]),
        "metrics": metrics,
        "ndvi": index,
        "catalog": store(rows, "pc_rasters"),
        "log": store(catalog.ingest_log(good, bad), "pc_metadata"),
    }


def ingest_raster_pairs(blobs: DataFrame, pairs: DataFrame, table_dir: str, dest: str = "raw", red_band: int = 1, nir_band: int = 1,
                        skip_validation: bool = False, block: int = 256) -> dict[str, DataFrame]:
    """``ingest_rasters`` for scenes whose red and near infrared lie in two files.

    ``pairs`` names the source paths of each scene: ``pair_id, red_path, nir_path`` (``nir_path`` null: the red file
    again); ids are unique. Files are landed once, however many pairs use them. Each pair has one row in the log, under
    its id and red path: a path that is not among ``blobs``, a file that is not readable, lacks the band or
    fails validation, and two files of different shape or blocks all give ``failed`` with the reason, and the other pairs go on.
    Statistics are those of the red and the near infrared band (``red_stats``, ``nir_stats``) and of the index (``metrics``),
    by ``pair_id``. Tables get one batch each, as in ``ingest_rasters``.
    """
    batch = uuid.uuid4().hex

    def store(df: DataFrame, name: str) -> DataFrame:
        return tables.write_table(df, f"{table_dir}/{name}/batch={batch}")

    pairs = materialize(pairs.select("pair_id", "red_path", F.coalesce("nir_path", "red_path").alias("nir_path")), "pairs")
    incoming = files.land_files(blobs, dest).withColumn("raster_id", F.col("file_id"))
    kept = ("content", "file_id", "source_path", "filename", "ingested_at")
    landed = files.write_landed(rasters.raster_headers(incoming, kept, pixels=True), f"{table_dir}/landed", batch)
    headers = landed.drop("content")
    checked = raster.header_errors() if not skip_validation else F.array().cast("array<string>")
    told = headers.withColumn("_problem", F.coalesce(F.when(F.size(checked) > 0, F.concat_ws("; ", checked)), "error"))
    facts = F.struct("file_id", "path", "band_count", "width", "height", "_problem")

    def named(side: str) -> DataFrame:
        return told.select(F.col("source_path").alias(f"{side}_path"), facts.alias(side))

    def wrong(side: str, band: int):
        f = F.col(side)
        return (
            F.when(f.isNull(), F.format_string(f"no {side} file %s", f"{side}_path"))
            .when(f["_problem"].isNotNull(), F.concat(F.lit(f"{side}: "), f["_problem"]))
            .when(f["band_count"] < band, F.format_string(f"{side}: band {band} out of range for %d bands", f["band_count"]))
        )

    unequal = (F.col("red.width") != F.col("nir.width")) | (F.col("red.height") != F.col("nir.height"))
    shapes = F.format_string("red and nir differ in shape: %d x %d and %d x %d", "red.width", "red.height", "nir.width", "nir.height")
    resolved = pairs.join(named("red"), "red_path", "left").join(named("nir"), "nir_path", "left").select(
        "pair_id", "red_path", F.col("red.file_id").alias("red_id"), F.col("nir.file_id").alias("nir_id"),
        F.coalesce(wrong("red", red_band), wrong("nir", nir_band), F.when(unequal, shapes)).alias("error"),
    )
    resolved = materialize(resolved, "resolved")
    ready = resolved.where("error IS NULL").select("pair_id", "red_id", "nir_id")
    used = ready.select(F.col("red_id").alias("file_id")).unionByName(ready.select(F.col("nir_id").alias("file_id"))).distinct()
    readable = landed.join(used, "file_id", "left_semi").select("raster_id", "path", "content")
    # Decoded once, the two bands only; places, index and statistics read their columns of it.
    picked = F.array(F.get("bands", F.lit(red_band - 1)), F.get("bands", F.lit(nir_band - 1)))
    blocks = materialize(rasters.raster_blocks(readable, block).withColumn("bands", picked), "blocks")
    good, odd = raster.covered_pairs(blocks, blocks, ready)
    good = materialize(good, "good")
    index = raster.ndvi_pairs(blocks, blocks, good, 1, 2)
    index = store(index.withColumn("path", paths.processed_path("path", F.col("raster_id"))), "ndvi")

    def statistics(side: str, band: int) -> DataFrame:
        own = good.select(F.col(f"{side}_id").alias("raster_id"), "pair_id")
        single = blocks.withColumn("bands", F.array(F.element_at("bands", band)))
        per_file = raster.block_stats(single.join(own.select("raster_id").distinct(), "raster_id", "left_semi"), headers.withColumn("band_count", F.lit(1)))
        return store(per_file.join(own, "raster_id").drop("raster_id"), f"{side}_stats")

    head = headers.withColumns({"band_count": F.lit(1), "dtype": F.lit("float32")}).withColumnRenamed("raster_id", "red_id")
    index_headers = good.join(head, "red_id").withColumn("raster_id", F.col("pair_id"))
    failed = resolved.where("error IS NOT NULL").select("pair_id", "error").unionByName(odd.select("pair_id", "error"))
    log = resolved.drop("error").join(failed, "pair_id", "left").select(
        F.col("pair_id").alias("file_id"), F.col("red_path").alias("source_path"),
        F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("ingest_status"), F.col("error").alias("error_message"),
    )
    return {
        "landed": landed,
        "red_stats": statistics("red", 1),
        "nir_stats": statistics("nir", 2),
        "ndvi": index,
        "metrics": store(raster.block_stats(index, index_headers).withColumnRenamed("raster_id", "pair_id"), "metrics"),
        "log": store(log, "pc_metadata"),
    }


def normals_and_clusters(points: DataFrame, knn: int = 8, min_points: int = 10, eps: float = 2.0,
                         dims: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """Normals, curvature and cluster label per point."""
    return neighbours.normals(points, knn).join(
        shuffled(dbscan.dbscan(points, min_points, eps, dims)), ["cloud_id", "point_id"]
    )


#: Stages of point enrichment by name: each takes ``cloud_id, point_id, x, y, z`` and parameters, and gives columns per point.
POINT_STAGES: dict[str, Callable[..., DataFrame]] = {
    "features": neighbours.eigen_features,
    "normals": neighbours.normals,
    "clusters": dbscan.dbscan,
}


def run_point_stages(points: DataFrame, stages: list[tuple[str, dict]]) -> DataFrame:
    """``points`` with the columns of each declared stage, in order; all their own columns stay as they are.

    Stages see the coordinates alone, and their results come back by ``cloud_id, point_id``,
    which must be unique. A stage that is not known, or would give a column that is there
    already, fails before anything runs.
    """
    key, place = ["cloud_id", "point_id"], ["cloud_id", "point_id", "x", "y", "z"]
    unknown = [name for name, _ in stages if name not in POINT_STAGES]
    if unknown:
        raise ValueError(f"unknown point stages {unknown}; known are {sorted(POINT_STAGES)}")
    coordinates, out = points.select(*place), points
    for name, parameters in stages:
        found = POINT_STAGES[name](coordinates, **parameters)
        added = [c for c in found.columns if c not in place]
        clash = sorted(set(added) & set(out.columns))
        if clash:
            raise ValueError(f"stage {name} gives columns that are there already: {clash}")
        out = out.join(shuffled(found.select(*key, *added)), key, "left")
    return out


def enrich_landed_clouds(landed: DataFrame, out_dir: str, file_ids: DataFrame | None = None,
                         stages: list[tuple[str, dict]] | None = None) -> DataFrame:
    """Enrich landed LAS clouds and write one folder ``file_id=...`` per cloud, with all dimensions of the source.

    ``landed`` is a table of ``files.write_landed``; ``file_ids`` (column ``file_id``) selects clouds, all by default.
    An id that was not landed, was landed twice, or whose file is not a readable LAS cloud fails the job. A cloud
    written before is replaced, others stay. Returns one row per cloud with points: ``file_id, filename,
    enriched_name, path, points``. Rows lie by cloud and point, so a large cloud is written by many tasks.
    """
    spark = landed.sparkSession
    wanted = landed if file_ids is None else landed.join(file_ids.select("file_id").distinct(), "file_id", "left_semi")
    if file_ids is not None:
        lost = file_ids.select("file_id").join(landed.select("file_id"), "file_id", "left_anti").first()
        if lost:
            raise ValueError(f"no landed cloud has the id {lost[0]}")
    twice = wanted.groupBy("file_id").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice[1]} landed files have the id {twice[0]}")
    odd = wanted.where(F.coalesce(paths.extension("filename"), F.lit("")) != ".las").select("filename").first()
    if odd:
        raise ValueError(f"not a LAS cloud: {odd[0]}")
    broken = pointclouds.las_problems(wanted.select("path", "content")).first()
    if broken:
        raise ValueError(f"{broken[0]}: {broken[1]}")
    points = materialize(pointclouds.las_records(wanted, "file_id"), "records")
    names = wanted.select(F.col("file_id").alias("cloud_id"), "filename", paths.enriched_name("filename").alias("enriched_name"))
    enriched = run_point_stages(points, stages or [("features", {"k": 20})])
    placed = enriched.repartitionByRange("cloud_id", "point_id").sortWithinPartitions("cloud_id", "point_id")
    placed.withColumnRenamed("cloud_id", "file_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "file_id"
    ).parquet(out_dir)
    counts = points.groupBy("cloud_id").agg(F.count("*").alias("points"))
    return names.join(counts, "cloud_id").select(
        F.col("cloud_id").alias("file_id"), "filename", "enriched_name",
        F.concat(F.lit(f"{out_dir.rstrip('/')}/file_id="), "cloud_id").alias("path"), "points",
    )


def enrich_pointclouds(spark: SparkSession, root: str, out_dir: str, k: int = 20) -> DataFrame:
    """Features for every cloud file of a folder, written as one table keyed by the enriched file name."""
    points = materialize(pointclouds.pointcloud_scan(spark, root), "points")
    enriched = neighbours.eigen_features(points, k).withColumn("enriched_name", paths.enriched_name("cloud_id"))
    return tables.write_table(enriched, out_dir)
