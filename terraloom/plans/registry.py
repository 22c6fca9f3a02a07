"""The registered queries: every one runs an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, geometry, paths, text
from ..operators import catalog, dbscan, embed, neighbours, raster, similarity, spatial
from ..session import materialize, new_dir
from ..sources import files, pointclouds, queries, rasters, tables
from ..sources.tables import PATCH_BOUNDS
from ..streaming import jobs as streams
from . import jobs, reports, views

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _r(c: Column | str, places: int = 6) -> Column:
    """Rounded double without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), places) + F.lit(0.0)


def _rounded(df: DataFrame, names: list[str], places: int = 6) -> DataFrame:
    return df.withColumns({n: _r(n, places) for n in names})


def _longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# --- similarity -------------------------------------------------------------------------------


def _prototypes(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vector of each label: the image queries of the examples."""
    parts = views.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("at", "v"))
    means = parts.groupBy("label", "at").agg(F.avg(F.col("v").cast("double")).alias("v"))
    vectors = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("cells"))
    return vectors.select(
        F.concat(F.lit("label_"), "label").alias("query_id"), F.transform("cells", lambda c: c["v"]).alias("vector")
    )


def _prototype_matches(spark: SparkSession, sf: str) -> DataFrame:
    patches = views.patches(spark, sf)
    return similarity.matches(patches, _prototypes(spark, sf))


@query
def patch_topk(spark: SparkSession, sf: str) -> DataFrame:
    hits = similarity.top_k(views.patches(spark, sf), _prototypes(spark, sf), 5)
    return _longs(hits.withColumn("score", _r("score")), "rank")


@query
def point_in_patch_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = jobs.find_similar_patches(views.patches(spark, sf), coords=views.coords(spark, sf), strict=False)
    out = found.select(
        "query_x", "query_y", "match_patch_id", _r("score").alias("score"), F.col("rank").cast("bigint").alias("rank"),
        "match_min_x", "match_min_y", "match_max_x", "match_max_y",
    )
    return out


@query
def point_in_tile_topk(spark: SparkSession, sf: str) -> DataFrame:
    bare = views.patches(spark, sf).drop(*PATCH_BOUNDS)
    found = jobs.find_similar_patches(bare, coords=views.coords(spark, sf), tiles=views.patch_tiles(spark, sf), strict=False)
    return found.select(
        "query_x", "query_y", "match_tile_id", "match_patch_id", _r("score").alias("score"),
        F.col("rank").cast("bigint").alias("rank"), "match_min_x", "match_min_y", "match_max_x", "match_max_y",
    )


@query
def point_in_patch_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = spatial.point_in_box(
        views.coords(spark, sf).distinct(), views.patches(spark, sf), "query_x", "query_y", PATCH_BOUNDS
    )
    return pairs.select("query_x", "query_y", "patch_id")


@query
def boxes_in_window(spark: SparkSession, sf: str) -> DataFrame:
    """Patches and tiles of a map window, from tables laid out along a curve, as their own readers give them."""
    window, bounds = (300.0, 9500.0, 900.0, 9850.0), ("min_x", "min_y", "max_x", "max_y")
    where = [new_dir(spark, name) for name in ("patches-by-place", "tiles-by-place")]
    tables.write_by_place(views.patches(spark, sf), where[0], PATCH_BOUNDS, files=8)
    tables.write_by_place(views.patch_tiles(spark, sf), where[1], bounds, files=2)
    patches = tables.in_window(tables.read_patches(spark, where[0]), window, PATCH_BOUNDS)
    tiles = tables.in_window(tables.read_tiles(spark, where[1]), window, bounds)
    ends = [F.col(own).alias(name) for own, name in zip(PATCH_BOUNDS, bounds)]
    return patches.select(F.col("patch_id").alias("box_id"), "tile_id", *ends, F.size("embedding").cast("bigint").alias("dims")).unionByName(
        tiles.select(F.col("tile_path").alias("box_id"), "tile_id", *bounds, F.lit(None).cast("bigint").alias("dims"))
    )


@query
def union_query_results(spark: SparkSession, sf: str) -> DataFrame:
    found = jobs.find_similar_patches(
        views.patches(spark, sf), _prototypes(spark, sf), views.coords(spark, sf), k=3, exclude_self=True, strict=False
    )
    return found.select(
        "query_path", "query_x", "query_y", "match_tile_id", "match_tile_path", "match_patch_id",
        _r("score").alias("score"), F.col("rank").cast("bigint").alias("rank"), "match_min_x", "match_max_y",
    )


@query
def unmatched_queries(spark: SparkSession, sf: str) -> DataFrame:
    _, missed = similarity.coords_to_vectors(views.coords(spark, sf), views.patches(spark, sf), strict=False)
    return missed.select("query_x", "query_y")


@query
def repeated_path_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Image queries of which some are given two or three times: each is answered as often."""
    asked = _prototypes(spark, sf).withColumn("_n", F.expr("CAST(substring(query_id, 7) AS INT) % 3 + 1"))
    again = asked.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("query_id", "vector")
    return _longs(
        similarity.matches(views.patches(spark, sf), again, 2).select("query_id", "match_patch_id", _r("score").alias("score"), "rank"), "rank"
    )


@query
def same_name_rasters_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Two folders with equal file names: every patch id stands twice, and both patches are ranked and told apart."""
    one = views.patches(spark, sf).withColumn("raster_id", F.lit("s1/scene.tif"))
    moved = {b: F.col(b) + 100_000 for b in ("patch_min_x", "patch_max_x")}
    both = one.unionByName(one.withColumns({**moved, "raster_id": F.lit("s2/scene.tif")}))
    found = similarity.matches(both, _prototypes(spark, sf), 6)
    return _longs(found.select("query_id", "match_patch_id", _r("score").alias("score"), "rank", "match_min_x"), "rank")


@query
def qa_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Patches of tiles in odd rows lost their vector."""
    lost = F.expr("CAST((10000 - patch_max_y) / 256 AS INT) % 2 = 1")
    patches = views.patches(spark, sf).withColumn("embedding", F.when(~lost, F.col("embedding")))
    return _longs(catalog.qa_metrics(views.patch_tiles(spark, sf), patches, "tiles", "embeddings"), "embedding_dim")


@query
def drawable_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds come from the tile index; all its tiles have them."""
    bare = views.patches(spark, sf).drop(*PATCH_BOUNDS)
    drawn = similarity.drawable(similarity.matches(bare, _prototypes(spark, sf), tiles=views.patch_tiles(spark, sf)))
    return drawn.select(
        "query_id", "match_patch_id", "rank_class", "label",
        text.fixed(F.col("match_min_x"), 3).alias("min_x_text"),
    )


@query
def results_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Match table written with its CSV twin; the CSV is read back."""
    out = new_dir(spark, "results")
    matches = similarity.union_results(_prototype_matches(spark, sf), None)
    tables.write_results(matches, out + ".parquet")
    back = tables.read_matches_csv(spark, out + ".csv")
    return back.select(
        "query_path", "match_patch_id", _r("score").alias("score"), F.col("rank").cast("bigint").alias("rank"),
        "match_min_x", "match_max_y",
    )


# --- rasters ----------------------------------------------------------------------------------


@query
def ndvi_pixels(spark: SparkSession, sf: str) -> DataFrame:
    p = views.band_pixels(spark, sf)
    return _longs(_rounded(raster.ndvi_bands(p, 1, 2), ["ndvi"]), "row", "col")


@query
def ndvi_stats(spark: SparkSession, sf: str) -> DataFrame:
    wide = views.pixels(spark, sf)
    index = wide.select("raster_id", raster.ndvi_value(F.col("b1"), F.col("b2")).alias("value"))
    return _rounded(raster.raster_stats(index), ["min_val", "max_val", "mean_val", "std_val"])


@query
def raster_stats_nodata(spark: SparkSession, sf: str) -> DataFrame:
    p = views.band_pixels(spark, sf).withColumn("nodata", F.lit(0.0))
    return _rounded(raster.raster_stats(p, nodata="nodata"), ["min_val", "max_val", "mean_val", "std_val"])


@query
def raster_stats_per_band(spark: SparkSession, sf: str) -> DataFrame:
    stats = raster.raster_stats(views.band_pixels(spark, sf), by=("raster_id", "band"))
    return _longs(_rounded(stats, ["min_val", "max_val", "mean_val", "std_val"]), "band")


@query
def raw_vs_processed(spark: SparkSession, sf: str) -> DataFrame:
    wide = views.pixels(spark, sf)
    raw = raster.raster_stats(views.band_pixels(spark, sf))
    done = raster.raster_stats(wide.select("raster_id", raster.ndvi_value(F.col("b1"), F.col("b2")).alias("value")))
    both = catalog.metrics_side_by_side(raw, done)
    return both.select(
        "raster_id",
        *[_r(f"{side}_{n}").alias(f"{side}_{n}") for side in ("raw", "processed") for n in ("min_val", "max_val", "mean_val", "std_val")],
        "raw_pixels", "processed_pixels",
    )


@query
def shape_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    red = views.headers(spark, sf)
    nir = red.withColumn("height", F.expr("CAST((CAST(raster_id AS BIGINT) % 5) * 30 + 20 AS INT)"))
    _, bad = raster.shape_check(red, nir)
    return _longs(bad, "red_width", "red_height", "nir_width", "nir_height")


@query
def band_select(spark: SparkSession, sf: str) -> DataFrame:
    picked = raster.band(views.band_pixels(spark, sf), 2, views.pixel_headers(spark, sf))
    return picked.groupBy("raster_id").agg(F.count("*").alias("pixels"), _r(F.sum("value"), 3).alias("total"))


@query
def tile_grid(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = raster.validate(views.headers(spark, sf))
    tiles = raster.tile_grid(good, 64)
    return tiles.select("dataset_id", "tile_id", "min_x", "min_y", "max_x", "max_y", "crs", "tile_path")


@query
def tile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return raster.tile_counts(raster.tile_grid(views.pixel_headers(spark, sf), 8))


@query
def patch_grid_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles of 8 pixels under models with 10 and with 16 tokens."""
    tiles = raster.tile_grid(views.pixel_headers(spark, sf), 8)
    tokens = F.when(F.col("raster_id").cast("bigint") % 2 == 0, F.lit(10)).otherwise(F.lit(16))
    grid = raster.patch_grid(tiles, geometry.grid_side(tokens), F.lit(8), F.lit(8))
    return _rounded(
        _longs(grid.select("tile_id", "patch_id", "patch_row", "patch_col", *PATCH_BOUNDS), "patch_row", "patch_col"),
        list(PATCH_BOUNDS),
    )


@query
def tile_stretch(spark: SparkSession, sf: str) -> DataFrame:
    p = views.band_pixels(spark, sf).withColumns(
        {"tile_row": F.floor(F.col("row") / 8), "tile_col": F.floor(F.col("col") / 8)}
    )
    out = raster.stretch_pixels(p, ["raster_id", "tile_row", "tile_col"])
    return _longs(out.select("raster_id", "row", "col", "band", "stretched"), "row", "col", "band")


@query
def channel_standardize(spark: SparkSession, sf: str) -> DataFrame:
    held = F.least(F.floor("b1"), F.lit(255)).cast("double")
    values = {f"{kind}_{i}": _r(raster.standardize_value(held, i, kind)) for kind in ("tile", "query") for i in range(3)}
    return _longs(views.pixels(spark, sf).select("raster_id", "row", "col", *[v.alias(n) for n, v in values.items()]), "row", "col")


@query
def dataset_bbox(spark: SparkSession, sf: str) -> DataFrame:
    boxes = rasters.raster_bounds(views.headers(spark, sf))
    named = boxes.join(views.headers(spark, sf).select("raster_id", "band_count"), "raster_id")
    return _longs(raster.bbox(named, ("band_count",)), "band_count")


@query
def validate_split(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = raster.validate(views.headers(spark, sf))
    return good.select("raster_id", F.lit("").alias("errors")).unionByName(
        bad.select("raster_id", F.concat_ws("; ", "errors").alias("errors"))
    )


@query
def ingest_log(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.ingest_log(*raster.validate(views.headers(spark, sf)))


# --- paths and catalog ------------------------------------------------------------------------


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "customer").select(F.format_string(" %d ", "c_custkey").alias("file_id"))


@query
def resolve_first_path(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.resolve_by_id(views.landed(spark, sf), _ids(spark, sf), "first", "raw", "*.tif")


@query
def resolve_latest_path(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.resolve_by_id(views.landed(spark, sf), _ids(spark, sf), "latest", "raw")


@query
def latest_record(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.latest_record(views.landed(spark, sf), "file_id", "ts", "path").select("file_id", "path")


@query
def extension_filter(spark: SparkSession, sf: str) -> DataFrame:
    return files.allow_extensions(views.landed(spark, sf)).select("event_id", "path")


@query
def derived_paths(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("path")
    return views.landed(spark, sf).withColumn("stem", paths.stem(p)).select(
        "event_id",
        paths.basename(p).alias("name"), paths.extension(p).alias("ext"), paths.dataset_name(p).alias("dataset"),
        paths.processed_path(p, F.col("file_id")).alias("processed"), paths.enriched_name(p).alias("enriched"),
        paths.csv_twin(p).alias("twin"), paths.results_path(F.col("stem"), F.lit("emb/")).alias("results"),
        paths.join_uri(F.lit("s3://bucket/"), F.lit("/tiles/"), F.col("file_id"), F.lit("")).alias("uri"),
        paths.landed_id(p).alias("id"), F.date_format(paths.landed_at(p), "yyyy-MM-dd HH:mm:ss").alias("landed"),
    )


@query
def sorted_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct ``.tif`` paths in order, matched by a whole-key glob."""
    keys = views.landed(spark, sf).where(F.col("path").rlike(paths.glob_regex("raw/*_1*/*.tif")))
    return keys.select("path").distinct().orderBy("path")


@query
def catalog_rows(spark: SparkSession, sf: str) -> DataFrame:
    stats = raster.raster_stats(views.band_pixels(spark, sf).withColumn("nodata", F.lit(0.0)), nodata="nodata")
    head = views.pixel_headers(spark, sf)
    full = stats.join(head.select("raster_id", "width", "height", "crs"), "raster_id").withColumnRenamed("raster_id", "file_id")
    landed = views.table(spark, sf, "events").groupBy(F.expr("CAST(event_id DIV 1000 AS STRING)").alias("file_id")).agg(
        F.min("ts").alias("ingested_at")
    )
    landed = landed.join(head.select(F.col("raster_id").alias("file_id"), "path"), "file_id")
    rows = catalog.catalog_rows(full, landed)
    return _longs(_rounded(rows, ["min_val", "max_val", "mean_val", "std_val"]), "width", "height")


@query
def json_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Properties with every seventh text cut short."""
    cut = F.expr("CASE WHEN event_id % 7 = 0 THEN substring(props, 1, length(props) - 1) ELSE props END")
    parsed = text.json_or_empty(cut, "k bigint")
    return views.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query
def parse_query_coords(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinate lists in three notations, with a malformed item each."""
    rows = views.table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(
            "CASE c_custkey % 3"
            " WHEN 0 THEN concat('[{\"x\": ', c_acctbal, ', \"y\": ', c_nationkey, '}, {\"x\": 1}]')"
            " WHEN 1 THEN concat('[[', c_acctbal, ', ', c_nationkey, '], [1, 2, 3]]')"
            " ELSE concat(' ', c_acctbal, '  ', c_nationkey, ' , 7 8,, 9 ') END"
        ).alias("text"),
    )
    return _longs(queries.query_coords(rows, "text", ("c_custkey",)).drop("position"), "c_custkey")


@query
def parse_query_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Path lists as JSON, as broken JSON and as plain text."""
    rows = views.table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(
            "CASE c_custkey % 3"
            " WHEN 0 THEN concat('[\"', c_name, '.tif\", \"b.tif\"]')"
            " WHEN 1 THEN concat('[', c_name, '.tif, b.tif')"
            " ELSE concat(' ', c_name, '.tif , ,b.tif,') END"
        ).alias("text"),
    )
    return _longs(queries.inline_paths(rows, "text", ("c_custkey",)), "position")


# --- point clouds -----------------------------------------------------------------------------


@query
def knn(spark: SparkSession, sf: str) -> DataFrame:
    return _longs(_rounded(neighbours.knn(views.points(spark, sf), 8).drop("cloud_id"), ["d2"]), "rank")


@query
def knn_many_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """The same search cut on two levels, into few parts and many leaves, with probes into neighbouring ones."""
    return neighbours.knn(views.points(spark, sf), 8, leaf_rows=64, most_parts=16).select("point_id", F.col("rank").cast("bigint").alias("rank"), "neighbour_id", _r("d2").alias("d2"))


@query
def knn_eigen(spark: SparkSession, sf: str) -> DataFrame:
    lists = neighbours.neighbour_lists(views.points(spark, sf), 20)
    values = neighbours.neighbourhood_shapes(lists)
    return _rounded(values.select("point_id", "l1", "l2", "l3"), ["l1", "l2", "l3"], 5)


@query
def eigen_features(spark: SparkSession, sf: str) -> DataFrame:
    features = neighbours.eigen_features(views.points(spark, sf), 20)
    names = [c for c in features.columns if c not in ("cloud_id", "point_id", "x", "y", "z", "l1", "l2", "l3", "nx", "ny", "nz")]
    return _rounded(features.select("point_id", *names), names, 4)


@query
def normals(spark: SparkSession, sf: str) -> DataFrame:
    out = neighbours.normals(views.points(spark, sf), 8)
    return out.select(
        "point_id", *[_r(F.abs(F.col(n)), 4).alias(n) for n in ("nx", "ny", "nz")], _r("curvature", 4).alias("curvature")
    )


@query
def dbscan_labels(spark: SparkSession, sf: str) -> DataFrame:
    return dbscan.dbscan(views.points(spark, sf), 10, 8.0).select("point_id", "is_core", "cluster_id")


@query
def dbscan_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters in the x-y plane, numbered from 0, with their sizes."""
    out = dbscan.dbscan(views.points(spark, sf), 5, 1.5, ("x", "y"), renumber=True)
    return out.groupBy("cluster_id").agg(F.count("*").alias("points"), F.count_if("is_core").alias("cores"))


@query
def normals_and_clusters(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.normals_and_clusters(views.points(spark, sf), 8, 10, 8.0)
    return out.groupBy("cluster_id").agg(F.count("*").alias("points"), _r(F.avg("curvature"), 4).alias("mean_curvature"))


@query
def mercator(spark: SparkSession, sf: str) -> DataFrame:
    there = crs.reproject(views.lonlat(spark, sf), "lon", "lat", "EPSG:4326", "EPSG:3857")
    back = crs.reproject(there, "x", "y", "EPSG:3857", "EPSG:4326", ("lon2", "lat2"))
    return back.select("id", *[_r(c, 3).alias(c) for c in ("x", "y", "lon2", "lat2")])


@query
def utm35(spark: SparkSession, sf: str) -> DataFrame:
    there = crs.reproject(views.lonlat(spark, sf), "lon", "lat", "EPSG:4326", "EPSG:3067")
    back = crs.reproject(there, "x", "y", "EPSG:3067", "EPSG:4326", ("lon2", "lat2"))
    return back.select("id", *[_r(c, 3).alias(c) for c in ("x", "y", "lon2", "lat2")])


@query
def crs_by_row(spark: SparkSession, sf: str) -> DataFrame:
    """Each point in its own reference system, named in different ways."""
    named = views.lonlat(spark, sf).withColumn(
        "crs", F.expr("element_at(array('', '3857', ' EPSG:3857', 'EPSG:4326'), CAST(id % 4 AS INT) + 1)")
    )
    out = crs.reproject_by_column(named, "lon", "lat", "crs")
    return out.select("id", crs.normalise_crs(F.col("crs")).alias("crs"), _r("x", 3).alias("x"), _r("y", 3).alias("y"))


# --- reports and streams ----------------------------------------------------------------------


@query
def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    lines = views.table(spark, sf, "lineitem")
    out = reports.profile(lines.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")), exact=True)
    numeric = F.col("mean").isNotNull()
    ends = {f"{end}_number": F.when(numeric, _r(F.col(f"{end}_value").cast("double"), 4)) for end in ("min", "max")}
    return out.select(
        "column_name", "column_type", "rows", "nulls", "distinct_values",
        *[_r(n, 4).alias(n) for n in ("mean", "std", "q25", "q50", "q75")], *[v.alias(n) for n, v in ends.items()],
        F.when(~numeric, F.col("min_value")).alias("min_text"), F.when(~numeric, F.col("max_value")).alias("max_text"),
    )


@query
def dataset_signature(spark: SparkSession, sf: str) -> DataFrame:
    """Over all columns; prices as whole cents, whose text is the same in every engine."""
    lines = views.table(spark, sf, "lineitem")
    doubles = [f.name for f in lines.schema.fields if f.dataType.simpleString() == "double"]
    return reports.signature(lines.withColumns({c: F.round(F.col(c) * 100).cast("bigint") for c in doubles} | {"l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd")}))


@query
def guarded_query_index(spark: SparkSession, sf: str) -> DataFrame:
    for name in ("orders", "lineitem"):
        views.table(spark, sf, name).createOrReplaceTempView(name)
    batch = {
        "status": "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY o_orderstatus",
        "open_limit": "SELECT l_orderkey, l_quantity FROM lineitem ORDER BY l_extendedprice DESC",
        "own_limit": "SELECT * FROM orders ORDER BY o_totalprice LIMIT 45",
        "refused": "CREATE TABLE copy_of_orders USING parquet AS SELECT * FROM orders",
        "broken": "SELECT no_such_column FROM orders",
    }
    index = reports.run_queries(spark, batch, new_dir(spark, "reports"))
    return index.select("name", "status", "row_count")


@query
def runs_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index over two runs, the first of which is given again with another query: it is replaced, the other stays."""
    views.table(spark, sf, "orders").createOrReplaceTempView("orders")
    by_status = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"
    by_customer = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey LIMIT 1000000000"
    out, where = new_dir(spark, "reports"), new_dir(spark, "index")
    for run, batch in (("first", {"a": by_status, "gone": by_status}), ("second", {"b": by_customer, "broken": "SELECT"}), ("first", {"a": by_customer})):
        index = reports.append_run(reports.run_queries(spark, batch, new_dir(spark, "run") if run == "first" else out, run_id=run), where)
    return index.select("run_id", "name", "status", "row_count")


@query
def query_path_union(spark: SparkSession, sf: str) -> DataFrame:
    """Query paths given inline, in a list file with a line for every part, and by a folder of raster files; repeats kept."""
    where = new_dir(spark, "paths")
    views.table(spark, sf, "part").selectExpr("concat('  raw/part_', p_partkey % 100, '.tif ')").write.text(where)
    found = queries.query_paths(spark, "b.tif, a.tif,, b.tif", where, _raster_files(spark, sf))
    name = F.when(F.col("source") == 2, paths.basename("query_path")).otherwise(F.col("query_path"))
    return found.groupBy(F.col("source").cast("bigint").alias("source"), name.alias("query_path")).agg(F.count("*").alias("times"))


@query
def rate_5m(spark: SparkSession, sf: str) -> DataFrame:
    out = streams.event_rate(views.table(spark, sf, "events"))
    return out.withColumn("per_second", _r("per_second"))


@query
def newest_sample(spark: SparkSession, sf: str) -> DataFrame:
    return streams.newest_sample(views.table(spark, sf, "events"))


@query
def stream_newest_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The newest sample of each type, kept by a stream that runs twice."""
    arriving = spark.readStream.schema(views.table(spark, sf, "events").schema).parquet(f"{sf}/events.parque[t]")
    out, state = new_dir(spark, "newest"), new_dir(spark, "newest-state")
    streams.newest_samples(arriving, out, state)
    return streams.newest_samples(arriving, out, state)


@query
def stream_rate_5m(spark: SparkSession, sf: str) -> DataFrame:
    schema = views.table(spark, sf, "events").schema
    arriving = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    rate = streams.event_rate(arriving)
    done = streams.run_to_table(rate, new_dir(spark, "rate"), new_dir(spark, "rate-state"))
    return done.withColumn("per_second", _r("per_second"))


# --- files ------------------------------------------------------------------------------------


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Each raster of the pixel view as one block of 1000 pixels; missing last pixels are 0."""
    wide = views.pixels(spark, sf)
    packed = wide.groupBy("raster_id").agg(F.array_sort(F.collect_list(F.struct("row", "col", "b1", "b2"))).alias("cells"))
    rest = F.array_repeat(F.lit(0.0), 1000 - F.size("cells"))
    bands = [F.concat(F.col(f"cells.{b}"), rest) for b in ("b1", "b2")]
    return packed.select(
        "raster_id", F.concat(F.lit("raster_"), "raster_id").alias("path"), F.lit("float64").alias("dtype"),
        F.lit("EPSG:3857").alias("crs"), F.lit(0.0).alias("nodata"), F.lit(1.0).alias("a"),
        (F.col("raster_id").cast("double") * 1000).alias("c"), F.lit(-1.0).alias("e"), F.lit(1000.0).alias("f"),
        F.lit(0).alias("row_off"), F.lit(0).alias("col_off"), F.lit(25).alias("height"), F.lit(40).alias("width"),
        F.array(*bands).alias("bands"),
    )


def _raster_files(spark: SparkSession, sf: str) -> str:
    """Write the pixel view as raster files below the shared folder."""
    folder = new_dir(spark, "rasters")
    blobs = rasters.blocks_to_blobs(_blocks(spark, sf), folder)
    materialize(files.write_blobs(blobs), "written")
    return folder


@query
def raster_pixel_scan(spark: SparkSession, sf: str) -> DataFrame:
    blobs = files.blob_scan(spark, _raster_files(spark, sf), "*.tif")
    blobs = blobs.withColumn("raster_id", paths.dataset_name("path"))
    return _longs(rasters.raster_pixels(rasters.raster_blocks(blobs, 16)), "row", "col", "band")


@query
def raster_header_scan(spark: SparkSession, sf: str) -> DataFrame:
    blobs = files.blob_scan(spark, _raster_files(spark, sf)).withColumn("raster_id", paths.dataset_name("path"))
    head = rasters.raster_headers(blobs)
    return _longs(
        head.join(rasters.raster_bounds(head), "raster_id").select(
            "raster_id", "width", "height", "band_count", "dtype", "crs", "nodata", "min_x", "min_y", "max_x", "max_y"
        ),
        "width", "height", "band_count",
    )


@query
def raster_ingest(spark: SparkSession, sf: str) -> DataFrame:
    blobs = files.blob_scan(spark, _raster_files(spark, sf))
    done = jobs.ingest_rasters(blobs, new_dir(spark, "ingest"), red_band=1, nir_band=2)
    names = done["catalog"].select(F.col("file_id").alias("raster_id"), "filename", "width", "height", "crs")
    return _longs(
        names.join(done["metrics"], "raster_id").select(
            "filename", "width", "height", "crs",
            *[_r(f"{s}_{n}").alias(f"{s}_{n}") for s in ("raw", "processed") for n in ("min_val", "max_val", "mean_val", "std_val")],
        ),
        "width", "height",
    )


@query
def list_and_land(spark: SparkSession, sf: str) -> DataFrame:
    folder = _raster_files(spark, sf)
    listed = files.list_files(spark, folder, "*.tif").select(paths.basename("path").alias("filename"), F.col("length").alias("listed"))
    landed = files.write_landed(files.land_files(files.blob_scan(spark, folder), "raw"), new_dir(spark, "landed"))
    checked = landed.select(
        "filename", F.length("content").alias("stored"), (paths.landed_id("path") == F.col("file_id")).alias("id_in_path")
    )
    return listed.join(checked, "filename").select(
        "filename", (F.col("listed") == F.col("stored")).alias("whole"), "id_in_path"
    )


@query
def incremental_land(spark: SparkSession, sf: str) -> DataFrame:
    folder = _raster_files(spark, sf)
    target, state = new_dir(spark, "stream"), new_dir(spark, "stream-state")
    streams.incremental_land(spark, folder, target, state)
    streams.incremental_land(spark, folder, target, state)
    log = spark.read.parquet(f"{target}/log")
    return log.select(paths.basename("source_path").alias("filename"), "ingest_status", "error_message")


@query
def tile_and_embed(spark: SparkSession, sf: str) -> DataFrame:
    """Raster files to tiles to patch vectors under the stand-in model, with patch bounds."""
    out = new_dir(spark, "embed")
    blobs = files.blob_scan(spark, _raster_files(spark, sf)).withColumn("raster_id", paths.dataset_name("path"))
    blocks = rasters.raster_blocks(blobs, 8).withColumn("bands", F.slice("bands", 1, 1))
    tiles = tables.write_table(raster.cut_tiles(blocks, 8), f"{out}/tiles")
    patches = embed.embed_tiles(tiles, embed.mean_colour_model(2))
    return _rounded(
        patches.select(
            F.col("dataset_id").cast("string").alias("dataset_id"), "patch_id", *PATCH_BOUNDS,
            F.element_at("embedding", 1).cast("double").alias("v1"), F.size("embedding").cast("bigint").alias("dim"),
        ),
        ["v1", *PATCH_BOUNDS], 4,
    )


def _one_band_files(spark: SparkSession, sf: str) -> DataFrame:
    """The pixel view's first band as raster files, scanned with bytes."""
    folder = new_dir(spark, "one-band")
    materialize(files.write_blobs(rasters.blocks_to_blobs(_blocks(spark, sf).withColumn("bands", F.slice("bands", 1, 1)), folder)), "written")
    return files.blob_scan(spark, folder).withColumn("raster_id", paths.dataset_name("path"))


def _embedded(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Patch table written by the tiling and embedding jobs, and its folder."""
    tiles, out = new_dir(spark, "tiles"), new_dir(spark, "patches")
    jobs.tile_rasters(_one_band_files(spark, sf), tiles, 8)
    return jobs.compute_embeddings(spark, tiles, out, embed.mean_colour_model(2)), out


@query
def embedding_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Tiling and embedding jobs from files to the patch table, all components of every vector."""
    patches, _ = _embedded(spark, sf)
    parts = {f"v{k}": F.element_at("embedding", k).cast("double") for k in (1, 2, 3)}
    return _rounded(patches.select("dataset_id", "patch_id", *PATCH_BOUNDS, *[v.alias(n) for n, v in parts.items()]), [*parts, *PATCH_BOUNDS], 4)


@query
def embedding_qa_json(spark: SparkSession, sf: str) -> DataFrame:
    """Quality summary of the embedding job, read back from its JSON file."""
    _, out = _embedded(spark, sf)
    return spark.read.json(f"{out}/qa_metrics").select("tile_count", "embedding_count", "missing_embeddings", "embedding_dim")


@query
def image_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Whole image files as queries: stretched, standardized, embedded, searched; the best three scores of each."""
    patches, _ = _embedded(spark, sf)
    images = rasters.raster_blocks(_one_band_files(spark, sf), 64).withColumn("path", paths.basename("path"))
    found = jobs.find_similar_patches(patches, embed.embed_images(images, embed.mean_colour_model(2)), k=3)
    return _longs(found.select("query_path", "rank", _r("score", 4).alias("score")), "rank")


@query
def pointcloud_files(spark: SparkSession, sf: str) -> DataFrame:
    """Points written as one LAS file per nation and read back; coordinates keep their 0.0001 steps."""
    folder = new_dir(spark, "clouds")

    def encode(pdf):
        import pandas as pd

        from ..sources import las

        pdf = pdf.sort_values("point_id")
        data = las.write(pdf[["x", "y", "z"]].to_numpy(), 0.0001)
        return pd.DataFrame({"path": [f"{folder}/nation_{int(pdf['nation'].iloc[0])}_{int(pdf['part'].iloc[0])}.las"], "content": [data]})

    # A file holds at most one range of 10000 ids of a nation, so no group grows with the table.
    cut = views.points(spark, sf).withColumns({"nation": F.col("z").cast("int"), "part": F.expr("CAST(point_id DIV 10000 AS INT)")})
    blobs = cut.groupBy("nation", "part").applyInPandas(encode, "path string, content binary")
    materialize(files.write_blobs(blobs), "written")
    points = pointclouds.pointcloud_scan(spark, folder)
    return points.select(
        paths.basename("cloud_id").alias("cloud"), "point_id", _r("x", 4).alias("x"), _r("y", 4).alias("y"), _r("z", 4).alias("z")
    )


@query
def enrich_landed_clouds(spark: SparkSession, sf: str) -> DataFrame:
    """Clouds with intensity, class, time and colour landed as LAS files, enriched by id, and read back with all of these."""
    folder, out = new_dir(spark, "clouds"), new_dir(spark, "enriched")

    def encode(pdf):
        import pandas as pd

        from ..sources import las

        pdf = pdf.sort_values("point_id")
        extra = {n: pdf[n].to_numpy() for n in ("intensity", "classification", "gps_time", "red")}
        data = las.write(pdf[["x", "y", "z"]].to_numpy(), 0.0001, extra)
        return pd.DataFrame({"path": [f"{folder}/cloud_{int(pdf['cut'].iloc[0])}_{int(pdf['part'].iloc[0])}.las"], "content": [data]})

    # A file holds at most one range of 10000 ids, so no group grows with the table.
    told = views.points(spark, sf).withColumns({
        "cut": F.expr("CAST(z % 5 AS INT)"), "part": F.expr("CAST(point_id DIV 10000 AS INT)"), "intensity": F.expr("point_id % 65536"),
        "classification": F.col("z").cast("int"), "gps_time": F.col("x"), "red": F.expr("point_id * 7 % 65536"),
    })
    blobs = told.groupBy("cut", "part").applyInPandas(encode, "path string, content binary")
    materialize(files.write_blobs(blobs), "written")
    landed = files.write_landed(files.land_files(files.blob_scan(spark, folder), "raw"), new_dir(spark, "landed"))
    stages = [("features", {"k": 8}), ("clusters", {"min_points": 10, "eps": 8.0})]
    index = jobs.enrich_landed_clouds(landed, out, landed.select("file_id"), stages)
    rows = spark.read.parquet(out).join(index.select("file_id", "enriched_name"), "file_id")
    return _longs(rows.select(
        F.col("enriched_name").alias("cloud"), "point_id", *[_r(c, 4).alias(c) for c in ("x", "y", "z")], "intensity", "classification",
        _r("gps_time", 4).alias("gps_time"), "red", _r("curvature", 4).alias("curvature"), "is_core", "cluster_id",
    ), "intensity", "classification", "red")


@query
def pointcloud_csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """Points written as CSV files with two orders of header columns and read back by name."""
    folder = new_dir(spark, "csv-clouds")
    points = views.points(spark, sf)
    for name, even, order in (("even", 0, ("point_id", "x", "y", "z")), ("odd", 1, ("z", "x", "point_id", "y"))):
        points.where(F.col("point_id") % 2 == even).select(*order).write.option("header", "true").csv(f"{folder}/{name}")
    read = pointclouds.csv_points(spark, folder)
    return read.select("point_id", _r("x", 4).alias("x"), _r("y", 4).alias("y"), _r("z", 4).alias("z"))


@query
def raster_ingest_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every other raster has one band only: it is logged as failed, with the reason, and gives no index."""
    short = F.col("raster_id").cast("bigint") % 2 == 0
    mixed = _blocks(spark, sf).withColumn("bands", F.when(short, F.slice("bands", 1, 1)).otherwise(F.col("bands")))
    folder = new_dir(spark, "mixed")
    materialize(files.write_blobs(rasters.blocks_to_blobs(mixed, folder)), "written")
    done = jobs.ingest_rasters(files.blob_scan(spark, folder), new_dir(spark, "ingest"), red_band=1, nir_band=2)
    index = done["ndvi"].groupBy("raster_id").agg(F.sum(F.size(F.element_at("bands", 1))).alias("pixels"))
    log = done["log"].join(index, F.col("file_id") == F.col("raster_id"), "left")
    return log.select(paths.basename("source_path").alias("filename"), "ingest_status", "error_message", F.coalesce("pixels", F.lit(0)).alias("index_pixels"))


@query
def raster_ingest_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Scenes of two files ingested by path: unequal and absent near infrared files are logged with the reason, the rest is indexed."""
    folder, number = new_dir(spark, "scenes"), F.col("raster_id").cast("bigint")
    whole = _blocks(spark, sf)
    short = F.when(number % 3 == 1, F.lit(24)).otherwise(F.lit(25))
    for name, band, height in (("red", 1, F.lit(25)), ("nir", 2, short)):
        side = whole.withColumns({
            "bands": F.array(F.slice(F.element_at("bands", band), F.lit(1), height * 40)), "height": height, "raster_id": F.concat(F.lit(name + "_"), "raster_id"),
        })
        materialize(files.write_blobs(rasters.blocks_to_blobs(side, folder)), "written")
    blobs = files.blob_scan(spark, folder).withColumn("path", paths.basename("path"))
    pairs = views.pixel_headers(spark, sf).select(
        F.col("raster_id").alias("pair_id"), F.concat(F.lit("red_"), "raster_id", F.lit(".tif")).alias("red_path"),
        F.concat(F.when(number % 5 == 4, F.lit("none_")).otherwise(F.lit("nir_")), "raster_id", F.lit(".tif")).alias("nir_path"),
    )
    done = jobs.ingest_raster_pairs(blobs, pairs, new_dir(spark, "ingest"))
    means = [done[n].select(F.col("pair_id").alias("file_id"), _r("mean_val", 5).alias(m)) for n, m in (("metrics", "ndvi_mean"), ("red_stats", "red_mean"), ("nir_stats", "nir_mean"))]
    pixels = done["ndvi"].groupBy(F.col("raster_id").alias("file_id")).agg(F.sum(F.size(F.element_at("bands", 1)).cast("bigint")).alias("pixels"))
    out = done["log"]
    for more in (*means, pixels):
        out = out.join(more, "file_id", "left")
    return out


@query
def ndvi_two_files(spark: SparkSession, sf: str) -> DataFrame:
    """Red and near infrared in two files a scene, paired block by block while packed."""
    sides = {}
    for name, band in (("red", 1), ("nir", 2)):
        sides[name] = _blocks(spark, sf).withColumns({"bands": F.slice("bands", band, 1), "raster_id": F.concat(F.lit(name + "_"), "raster_id")})
    pairs = views.pixel_headers(spark, sf).select(
        F.col("raster_id").alias("pair_id"), F.concat(F.lit("red_"), "raster_id").alias("red_id"), F.concat(F.lit("nir_"), "raster_id").alias("nir_id")
    )
    found = rasters.raster_pixels(raster.ndvi_pairs(sides["red"], sides["nir"], pairs))
    return _longs(found.select("raster_id", "row", "col", _r("value", 5).alias("ndvi")), "row", "col")


@query
def catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest log appended to a catalog-style table in two runs and read back."""
    out = new_dir(spark, "catalog")
    log = catalog.ingest_log(*raster.validate(views.headers(spark, sf)))
    tables.write_table(log.where("ingest_status = 'ok'"), out, mode="append")
    tables.write_table(log.where("ingest_status <> 'ok'"), out, mode="append")
    return spark.read.parquet(out).groupBy("ingest_status").agg(F.count("*").alias("files"))


@query
def published_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The log published in batches by outcome: one batch is repeated, another is written and never published."""
    out = new_dir(spark, "published")
    log = catalog.ingest_log(*raster.validate(views.headers(spark, sf)))
    for batch, rows in (("ok", log), ("failed", log.where("ingest_status = 'failed'")), ("ok", log.where("ingest_status = 'ok'"))):
        tables.publish(rows, out, batch)
    log.write.parquet(f"{out}/data/unfinished")
    return tables.read_published(spark, out)
