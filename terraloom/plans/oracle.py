"""SQL counterparts of the registered queries, over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _r(expr: str, places: int = 6) -> str:
    return f"(ROUND(CAST({expr} AS DOUBLE), {places}) + 0.0)"


# --- views ------------------------------------------------------------------------------------

PIX = """pix AS (
  SELECT CAST(event_id // 1000 AS VARCHAR) AS raster_id, (event_id % 1000) // 40 AS "row", event_id % 40 AS "col",
         value AS b1, CAST(user_id AS DOUBLE) AS b2
  FROM events)"""
BANDS = """bands AS (
  SELECT raster_id, "row", "col", CAST(1 AS BIGINT) AS band, b1 AS value FROM pix
  UNION ALL SELECT raster_id, "row", "col", 2, b2 FROM pix)"""
IDX = """idx AS (
  SELECT raster_id, "row", "col",
         CASE WHEN b1 + b2 = 0 AND b1 = b2 THEN 0.0
              WHEN b1 + b2 = 0 THEN CASE WHEN b2 > b1 THEN 'Infinity'::DOUBLE ELSE '-Infinity'::DOUBLE END
              ELSE (b2 - b1) / (b2 + b1) END AS value
  FROM pix)"""
HEAD = """head AS (
  SELECT CAST(p_partkey AS VARCHAR) AS raster_id, 'raw/part_' || p_partkey || '.tif' AS path,
         'part_' || p_partkey AS dataset_id, CAST((p_size - 1) * 10 AS BIGINT) AS width,
         CAST((p_partkey % 7) * 30 + 20 AS BIGINT) AS height, CAST(p_partkey % 4 + 1 AS BIGINT) AS band_count,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'EPSG:3067' END AS crs, CAST(p_partkey * 10 AS DOUBLE) AS c,
         CASE WHEN p_partkey % 11 = 5 THEN 'truncated' END AS error, p_partkey
  FROM part)"""
ERRORS = """checked AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN 'unreadable: ' || error
                 WHEN width <= 0 OR height <= 0 THEN 'invalid raster dimensions' ELSE '' END AS errors
  FROM head)"""
PATCHES = """base AS (
  SELECT vec_id // 16 AS t, (vec_id % 16) // 4 AS pr, vec_id % 4 AS pc, CAST(embedding AS DOUBLE[]) AS v, label
  FROM embeddings),
patches AS (
  SELECT 'tile_' || t AS tile_id, 'tile_' || t || '.tif' AS tile_path, 'tile_' || t || '_r' || pr || '_c' || pc AS patch_id,
         CAST(t % 8 * 256 + pc * 64 AS DOUBLE) AS x0, CAST(10000 - t // 8 * 256 - pr * 64 - 64 AS DOUBLE) AS y0,
         CAST(t % 8 * 256 + pc * 64 + 64 AS DOUBLE) AS x1, CAST(10000 - t // 8 * 256 - pr * 64 AS DOUBLE) AS y1, v, label
  FROM base),
tiles AS (
  SELECT tile_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM patches GROUP BY tile_id),
units AS (
  SELECT patch_id, tile_id, list_transform(v, lambda x: x / CASE WHEN n = 0 THEN 1.0 ELSE n END) AS u
  FROM (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM patches))"""
COORDS = """coords AS (
  SELECT CAST(c_custkey % 37 * 64 AS DOUBLE) AS query_x, CAST(10000 - c_nationkey * 64 AS DOUBLE) AS query_y
  FROM customer),
spots AS (SELECT DISTINCT query_x, query_y FROM coords)"""
PROTO = """cells AS (
  SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM patches),
means AS (SELECT label, i, avg(x) AS x FROM cells GROUP BY label, i),
proto AS (SELECT 'label_' || label AS query_id, list(x ORDER BY i) AS v FROM means GROUP BY label),
seeds AS (
  SELECT query_id, list_transform(v, lambda x: x / CASE WHEN n = 0 THEN 1.0 ELSE n END) AS u
  FROM (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM proto))"""
IN_PATCH = """hit AS (
  SELECT query_x, query_y, min(patch_id) AS seed FROM spots JOIN patches
    ON x0 <= query_x AND x1 > query_x AND y0 <= query_y AND y1 > query_y GROUP BY 1, 2)"""
IN_TILE = """in_tile AS (
  SELECT query_x, query_y, min(tile_id) AS tile_id FROM spots JOIN tiles
    ON x0 <= query_x AND x1 > query_x AND y0 <= query_y AND y1 > query_y GROUP BY 1, 2),
hit AS (
  SELECT query_x, query_y, min(patch_id) AS seed FROM in_tile JOIN patches USING (tile_id) GROUP BY 1, 2)"""


def _ranked(name: str, seeds: str, k: int, skip_self: bool = False) -> str:
    skip = "WHERE s.query_id <> p.patch_id" if skip_self else ""
    return f"""{name} AS (
  SELECT * FROM (
    SELECT query_id, patch_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, patch_id) AS rank
    FROM (SELECT s.query_id, p.patch_id, ROUND(list_dot_product(s.u, p.u), 9) AS score
          FROM {seeds} s CROSS JOIN units p {skip}))
  WHERE rank <= {k})"""


COORD_SEEDS = "coord_seeds AS (SELECT patch_id AS query_id, u FROM units WHERE patch_id IN (SELECT seed FROM hit))"

# --- similarity -------------------------------------------------------------------------------

ORACLE["patch_topk"] = _with(PATCHES, PROTO, _ranked("best", "seeds", 5)) + f"""
SELECT query_id, patch_id, {_r('score')} AS score, rank FROM best"""

ORACLE["point_in_patch_topk"] = _with(PATCHES, COORDS, IN_PATCH, COORD_SEEDS, _ranked("best", "coord_seeds", 5)) + f"""
SELECT c.query_x, c.query_y, b.patch_id AS match_patch_id, {_r('b.score')} AS score, b.rank,
       p.x0 AS match_min_x, p.y0 AS match_min_y, p.x1 AS match_max_x, p.y1 AS match_max_y
FROM coords c JOIN hit h ON c.query_x = h.query_x AND c.query_y = h.query_y
JOIN best b ON b.query_id = h.seed JOIN patches p ON p.patch_id = b.patch_id"""

ORACLE["point_in_tile_topk"] = _with(PATCHES, COORDS, IN_TILE, COORD_SEEDS, _ranked("best", "coord_seeds", 5)) + f"""
SELECT c.query_x, c.query_y, t.tile_id AS match_tile_id, b.patch_id AS match_patch_id, {_r('b.score')} AS score, b.rank,
       t.x0 AS match_min_x, t.y0 AS match_min_y, t.x1 AS match_max_x, t.y1 AS match_max_y
FROM coords c JOIN hit h ON c.query_x = h.query_x AND c.query_y = h.query_y
JOIN best b ON b.query_id = h.seed JOIN patches p ON p.patch_id = b.patch_id JOIN tiles t ON t.tile_id = p.tile_id"""

ORACLE["point_in_patch_pairs"] = _with(PATCHES, COORDS) + """
SELECT query_x, query_y, patch_id FROM spots JOIN patches
  ON x0 <= query_x AND x1 > query_x AND y0 <= query_y AND y1 > query_y"""

_WINDOW = "x0 < 900 AND x1 > 300 AND y0 < 9850 AND y1 > 9500"
ORACLE["boxes_in_window"] = _with(PATCHES) + f"""
SELECT patch_id AS box_id, tile_id, x0 AS min_x, y0 AS min_y, x1 AS max_x, y1 AS max_y, CAST(len(v) AS BIGINT) AS dims FROM patches WHERE {_WINDOW}
UNION ALL SELECT tile_id || '.tif', tile_id, x0, y0, x1, y1, NULL FROM tiles WHERE {_WINDOW}"""

ORACLE["union_query_results"] = _with(
    PATCHES, PROTO, COORDS, IN_PATCH, COORD_SEEDS, _ranked("by_path", "seeds", 3), _ranked("by_coord", "coord_seeds", 3, True)
) + f"""
SELECT m.query_path, m.query_x, m.query_y, p.tile_id AS match_tile_id, p.tile_path AS match_tile_path,
       p.patch_id AS match_patch_id, {_r('m.score')} AS score, m.rank, p.x0 AS match_min_x, p.y1 AS match_max_y
FROM (
  SELECT query_id AS query_path, NULL::DOUBLE AS query_x, NULL::DOUBLE AS query_y, patch_id, score, rank FROM by_path
  UNION ALL
  SELECT NULL, c.query_x, c.query_y, b.patch_id, b.score, b.rank FROM coords c
  JOIN hit h ON c.query_x = h.query_x AND c.query_y = h.query_y JOIN by_coord b ON b.query_id = h.seed) m
JOIN patches p ON p.patch_id = m.patch_id"""

ORACLE["unmatched_queries"] = _with(PATCHES, COORDS, IN_PATCH) + """
SELECT c.query_x, c.query_y FROM coords c
WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.query_x = c.query_x AND h.query_y = c.query_y)"""

ORACLE["qa_metrics"] = _with(PATCHES) + """
SELECT (SELECT count(*) FROM tiles) AS tile_count, count(*) AS embedding_count,
       count(*) FILTER (lost) AS missing_embeddings,
       CAST((SELECT CASE WHEN CAST(floor((10000 - y1) / 256) AS INT) % 2 = 1 THEN NULL ELSE len(v) END FROM patches ORDER BY patch_id LIMIT 1) AS BIGINT) AS embedding_dim,
       'tiles' AS tiles_dir, 'embeddings' AS embeddings_dir
FROM (SELECT CAST(floor((10000 - y1) / 256) AS INT) % 2 = 1 AS lost FROM patches)"""

ORACLE["drawable_matches"] = _with(PATCHES, PROTO, _ranked("best", "seeds", 5)) + """
SELECT query_id, b.patch_id AS match_patch_id,
       CASE rank WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'other' END AS rank_class,
       'patch_id=' || b.patch_id || ' · tile_id=' || t.tile_id || ' · score=' || printf('%.4f', round(score, 4)) || ' · rank=' || rank AS label,
       printf('%.3f', t.x0) AS min_x_text
FROM best b JOIN patches p USING (patch_id) JOIN tiles t ON t.tile_id = p.tile_id"""

ORACLE["results_csv"] = _with(PATCHES, PROTO, _ranked("best", "seeds", 5)) + f"""
SELECT query_id AS query_path, patch_id AS match_patch_id, {_r('score')} AS score, rank, x0 AS match_min_x, y1 AS match_max_y
FROM best JOIN patches USING (patch_id)"""

# --- rasters ----------------------------------------------------------------------------------


def _stats(src: str, by: str = "raster_id", extra: str = "") -> str:
    return f"""SELECT {by}, {_r('min(value)')} AS min_val, {_r('max(value)')} AS max_val, {_r('avg(value)')} AS mean_val,
       {_r('stddev_pop(value)')} AS std_val, count(value) AS pixels{extra} FROM {src} GROUP BY {by}"""


ORACLE["ndvi_pixels"] = _with(PIX, IDX) + f"""SELECT raster_id, "row", "col", {_r('value')} AS ndvi FROM idx"""
ORACLE["ndvi_stats"] = _with(PIX, IDX) + _stats("idx")
ORACLE["raster_stats_nodata"] = _with(PIX, BANDS) + _stats("(SELECT raster_id, nullif(value, 0) AS value FROM bands)")
ORACLE["raster_stats_per_band"] = _with(PIX, BANDS) + _stats("bands", "raster_id, band")
ORACLE["raw_vs_processed"] = _with(
    PIX, BANDS, IDX, f"raw AS ({_stats('bands')})", f"done AS ({_stats('idx')})"
) + """
SELECT raster_id, raw.min_val AS raw_min_val, raw.max_val AS raw_max_val, raw.mean_val AS raw_mean_val, raw.std_val AS raw_std_val,
       done.min_val AS processed_min_val, done.max_val AS processed_max_val, done.mean_val AS processed_mean_val,
       done.std_val AS processed_std_val, raw.pixels AS raw_pixels, done.pixels AS processed_pixels
FROM raw JOIN done USING (raster_id)"""
ORACLE["shape_mismatch"] = _with(HEAD) + """
SELECT raster_id, width AS red_width, height AS red_height, width AS nir_width, (p_partkey % 5) * 30 + 20 AS nir_height
FROM head WHERE height <> (p_partkey % 5) * 30 + 20"""
ORACLE["band_select"] = _with(PIX) + f"SELECT raster_id, count(*) AS pixels, {_r('sum(b2)', 3)} AS total FROM pix GROUP BY raster_id"
ORACLE["tile_grid"] = _with(HEAD, ERRORS) + """
SELECT dataset_id, tile_id, min_x, min_y, max_x, max_y, crs, tile_id || '.tif' AS tile_path FROM (
  SELECT dataset_id, dataset_id || '_x' || co || '_y' || ro AS tile_id, c + co * 2.0::DOUBLE AS min_x, 5000.0::DOUBLE - (ro + 64) * 2.0::DOUBLE AS min_y,
         c + (co + 64) * 2.0::DOUBLE AS max_x, 5000.0::DOUBLE - ro * 2.0::DOUBLE AS max_y, coalesce(crs, 'None') AS crs
  FROM (SELECT *, unnest(range(0, width, 64)) AS co FROM checked WHERE errors = '') CROSS JOIN LATERAL (SELECT unnest(range(0, height, 64)) AS ro)
  WHERE co + 64 <= width AND ro + 64 <= height)"""
ORACLE["tile_counts"] = _with(PIX) + """
SELECT 'scene_' || raster_id AS dataset_id, CAST(15 AS BIGINT) AS tiles FROM (SELECT DISTINCT raster_id FROM pix)"""
ORACLE["patch_grid_bounds"] = _with(PIX) + f"""
SELECT tile_id, tile_id || '_r' || pr || '_c' || pc AS patch_id, pr AS patch_row, pc AS patch_col,
       {_r('x0 + pc * (8.0 / g)')} AS patch_min_x, {_r('y1 - (pr + 1) * (8.0 / g)')} AS patch_min_y,
       {_r('x0 + (pc + 1) * (8.0 / g)')} AS patch_max_x, {_r('y1 - pr * (8.0 / g)')} AS patch_max_y
FROM (
  SELECT 'scene_' || raster_id || '_x' || co || '_y' || ro AS tile_id, CAST(raster_id AS DOUBLE) * 1000 + co AS x0, 1000.0::DOUBLE - ro AS y1,
         CASE WHEN CAST(raster_id AS BIGINT) % 2 = 0 THEN 3 ELSE 4 END AS g
  FROM (SELECT DISTINCT raster_id FROM pix) CROSS JOIN range(0, 40, 8) a(co) CROSS JOIN range(0, 24, 8) b(ro))
CROSS JOIN range(0, 4) r(pr) CROSS JOIN range(0, 4) s(pc) WHERE pr < g AND pc < g"""
ORACLE["tile_stretch"] = _with(PIX, BANDS) + """
SELECT raster_id, "row", "col", band, CASE WHEN hi = lo THEN 0.0 ELSE floor((value - lo) / (hi - lo) * 255) END AS stretched
FROM (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM bands WINDOW w AS (PARTITION BY raster_id, "row" // 8, "col" // 8))"""
_MEAN = {"tile": ((0.430, 0.411, 0.296), (0.213, 0.156, 0.143)), "query": ((0.485, 0.456, 0.406), (0.229, 0.224, 0.225))}
ORACLE["channel_standardize"] = _with(PIX) + 'SELECT raster_id, "row", "col", ' + ", ".join(
    f"{_r(f'(least(floor(b1), 255.0::DOUBLE) / 255 - {m[i]}::DOUBLE) / {s[i]}::DOUBLE')} AS {kind}_{i}"
    for kind, (m, s) in _MEAN.items() for i in range(3)
) + " FROM pix"
ORACLE["dataset_bbox"] = _with(HEAD) + """
SELECT band_count, min(c) AS min_x, min(5000.0::DOUBLE - 2 * height) AS min_y, max(c + 2.0::DOUBLE * width) AS max_x, CAST(5000 AS DOUBLE) AS max_y
FROM head GROUP BY band_count"""
ORACLE["validate_split"] = _with(HEAD, ERRORS) + "SELECT raster_id, errors FROM checked"
ORACLE["ingest_log"] = _with(HEAD, ERRORS) + """
SELECT raster_id AS file_id, path AS source_path, CASE WHEN errors = '' THEN 'ok' ELSE 'failed' END AS ingest_status,
       nullif(errors, '') AS error_message FROM checked"""
ORACLE["published_catalog"] = ORACLE["ingest_log"]
ORACLE["catalog_table"] = _with(HEAD, ERRORS) + """
SELECT CASE WHEN errors = '' THEN 'ok' ELSE 'failed' END AS ingest_status, count(*) AS files FROM checked GROUP BY 1"""

# --- paths and catalog ------------------------------------------------------------------------

LANDED = """landed AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS file_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, event_type || '.v' || event_id AS stem,
         (['.tif', '.LAS', '.csv', '.txt', '.las'])[event_id % 5 + 1] AS ext
  FROM events),
paths AS (SELECT *, 'raw/' || stamp || '_' || file_id || '/' || stem || ext AS path FROM landed)"""
ORACLE["resolve_first_path"] = _with(LANDED) + """
SELECT file_id, min(path) AS path FROM paths WHERE ext = '.tif' AND file_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) GROUP BY file_id"""
ORACLE["resolve_latest_path"] = _with(LANDED) + """
SELECT file_id, max(path) AS path FROM paths WHERE file_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) GROUP BY file_id"""
ORACLE["latest_record"] = _with(LANDED) + """
SELECT file_id, path FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ts DESC, path DESC) AS n FROM paths) WHERE n = 1"""
ORACLE["extension_filter"] = _with(LANDED) + "SELECT event_id, path FROM paths WHERE lower(ext) IN ('.las', '.csv')"
ORACLE["derived_paths"] = _with(LANDED) + """
SELECT event_id, stem || ext AS name, lower(ext) AS ext, split_part(stem, '.', 1) AS dataset,
       CASE WHEN ext = '.tif' THEN 'processed/' || stamp || '_' || file_id || '/' || stem || '_ndvi.tif' ELSE 'processed/' || file_id || '/ndvi.tif' END AS processed,
       stem || '_enriched' || ext AS enriched, 'raw/' || stamp || '_' || file_id || '/' || stem || '.csv' AS twin,
       stem AS results, 's3://bucket/tiles/' || file_id AS uri, file_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS landed
FROM paths"""
ORACLE["sorted_listing"] = _with(LANDED) + "SELECT DISTINCT path FROM paths WHERE path LIKE 'raw/%\\_1%/%.tif' ESCAPE '\\'"
ORACLE["catalog_rows"] = _with(PIX, BANDS, f"st AS ({_stats('(SELECT raster_id, nullif(value, 0) AS value FROM bands)')})") + """
SELECT raster_id AS file_id, 'scene_' || raster_id || '.b.tif' AS filename, ingested_at, CAST(40 AS BIGINT) AS width, CAST(25 AS BIGINT) AS height,
       'EPSG:3857' AS crs, min_val, max_val, mean_val, std_val, 'raw/' || raster_id || '/scene_' || raster_id || '.b.tif' AS s3_path
FROM st JOIN (SELECT CAST(event_id // 1000 AS VARCHAR) AS raster_id, min(ts) AS ingested_at FROM events GROUP BY 1) USING (raster_id)"""
ORACLE["json_fallback"] = """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events"""
ORACLE["parse_query_coords"] = """
SELECT c_custkey, c_acctbal AS query_x, CAST(c_nationkey AS DOUBLE) AS query_y FROM customer
UNION ALL SELECT c_custkey, 7.0::DOUBLE, 8.0::DOUBLE FROM customer WHERE c_custkey % 3 = 2"""
ORACLE["parse_query_paths"] = """
SELECT c_custkey, CAST(0 AS BIGINT) AS position, CASE WHEN c_custkey % 3 = 1 THEN '[' ELSE '' END || c_name || '.tif' AS query_path FROM customer
UNION ALL SELECT c_custkey, 1, 'b.tif' FROM customer"""

# --- point clouds -----------------------------------------------------------------------------

POINTS = """pts AS (
  SELECT c_custkey AS id, c_acctbal / 100 AS x, CAST(c_custkey % 97 AS DOUBLE) AS y, CAST(c_nationkey AS DOUBLE) AS z FROM customer)"""


def _near(k: int, same: str = "") -> str:
    return f"""near AS (
  SELECT * FROM (
    SELECT a.id, b.id AS nid, b.x, b.y, b.z, d2, row_number() OVER (PARTITION BY a.id ORDER BY d2, b.id) AS rank
    FROM (SELECT a.id, b.id AS bid, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2
          FROM pts a JOIN pts b ON a.id <> b.id{same}) a JOIN pts b ON b.id = a.bid)
  WHERE rank <= {k})"""


COV = """cov AS (
  SELECT id, covar_pop(x, x) AS c_xx, covar_pop(x, y) AS c_xy, covar_pop(x, z) AS c_xz, covar_pop(y, y) AS c_yy,
         covar_pop(y, z) AS c_yz, covar_pop(z, z) AS c_zz, max(z) - min(z) AS height_range, sqrt(max(d2)) AS radius, count(*) AS n
  FROM near GROUP BY id),
mid AS (
  SELECT *, (c_xx + c_yy + c_zz) / 3 AS q FROM cov),
dev AS (
  SELECT *, sqrt(((c_xx - q) * (c_xx - q) + (c_yy - q) * (c_yy - q) + (c_zz - q) * (c_zz - q)
                  + 2 * (c_xy * c_xy + c_xz * c_xz + c_yz * c_yz)) / 6) AS p FROM mid),
ang AS (
  SELECT *, acos(greatest(-1.0, least(1.0, ((c_xx - q) * ((c_yy - q) * (c_zz - q) - c_yz * c_yz) - c_xy * (c_xy * (c_zz - q) - c_yz * c_xz)
         + c_xz * (c_xy * c_yz - (c_yy - q) * c_xz)) / (2 * p * p * p)))) / 3 AS phi FROM dev),
eig AS (
  SELECT *, greatest(q + 2 * p * cos(phi), 0.0) AS l1, greatest(q + 2 * p * cos(phi + 2 * pi() / 3), 0.0) AS l3,
         greatest(q - 2 * p * cos(phi) - 2 * p * cos(phi + 2 * pi() / 3), 0.0) AS l2 FROM ang),
crosses AS (
  SELECT *, [c_xy * c_yz - c_xz * (c_yy - l3), c_xz * c_xy - (c_xx - l3) * c_yz, (c_xx - l3) * (c_yy - l3) - c_xy * c_xy] AS va,
         [c_xy * (c_zz - l3) - c_xz * c_yz, c_xz * c_xz - (c_xx - l3) * (c_zz - l3), (c_xx - l3) * c_yz - c_xy * c_xz] AS vb,
         [(c_yy - l3) * (c_zz - l3) - c_yz * c_yz, c_yz * c_xz - c_xy * (c_zz - l3), c_xy * c_yz - (c_yy - l3) * c_xz] AS vc FROM eig),
longest AS (
  SELECT *, CASE WHEN list_dot_product(va, va) >= list_dot_product(vb, vb) AND list_dot_product(va, va) >= list_dot_product(vc, vc) THEN va
                 WHEN list_dot_product(vb, vb) >= list_dot_product(vc, vc) THEN vb ELSE vc END AS v FROM crosses),
normal AS (
  SELECT *, v[1] / sqrt(list_dot_product(v, v)) AS nx, v[2] / sqrt(list_dot_product(v, v)) AS ny, v[3] / sqrt(list_dot_product(v, v)) AS nz FROM longest)"""
_EIGEN_NAMES = ("l1", "l2", "l3")
ORACLE["knn"] = _with(POINTS, _near(8)) + f"SELECT id AS point_id, rank, nid AS neighbour_id, {_r('d2')} AS d2 FROM near"
ORACLE["knn_eigen"] = _with(POINTS, _near(20), COV) + "SELECT id AS point_id, " + ", ".join(
    f"{_r(n, 5)} AS {n}" for n in _EIGEN_NAMES
) + " FROM eig"
_PART = "CASE WHEN {0} / (l1 + l2 + l3) > 0 THEN -({0} / (l1 + l2 + l3)) * ln({0} / (l1 + l2 + l3)) ELSE 0 END"
_FEATURES = {
    "linearity": "(l1 - l2) / l1", "planarity": "(l2 - l3) / l1", "sphericity": "l3 / l1", "anisotropy": "(l1 - l3) / l1",
    "omnivariance": "cbrt(l1 * l2 * l3)", "eigenentropy": " + ".join(_PART.format(v) for v in ("l1", "l2", "l3")),
    "eigen_sum": "l1 + l2 + l3", "curvature": "l3 / (l1 + l2 + l3)", "verticality": "1 - abs(nz)", "height_range": "height_range",
    "height_std": "sqrt(c_zz)", "density": "n / (4 * pi() / 3 * radius * radius * radius)",
}
ORACLE["eigen_features"] = _with(POINTS, _near(20), COV) + "SELECT id AS point_id, " + ", ".join(
    f"{_r(v, 4)} AS {n}" for n, v in _FEATURES.items()
) + " FROM normal"
ORACLE["normals"] = _with(POINTS, _near(8), COV) + "SELECT id AS point_id, " + ", ".join(
    f"{_r(v, 4)} AS {n}" for n, v in (("nx", "abs(nx)"), ("ny", "abs(ny)"), ("nz", "abs(nz)"), ("curvature", _FEATURES["curvature"]))
) + " FROM normal"


def _clusters(eps: float, min_points: int, dims: str, same: str = "") -> str:
    d2 = " + ".join(f"(a.{d} - b.{d}) * (a.{d} - b.{d})" for d in dims)
    return f"""pairs AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON {d2} <= {eps} * {eps}{same}),
core AS (SELECT a AS id FROM pairs GROUP BY a HAVING count(*) >= {min_points}),
links AS (SELECT a, b FROM pairs WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id AS root, id FROM core UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.id),
names AS (SELECT id, min(root) AS cluster_id FROM reach GROUP BY id),
labels AS (
  SELECT p.id, c.id IS NOT NULL AS is_core, coalesce(n.cluster_id, e.cluster_id, -1) AS cluster_id
  FROM pts p LEFT JOIN core c ON c.id = p.id LEFT JOIN names n ON n.id = p.id
  LEFT JOIN (SELECT a AS id, min(cluster_id) AS cluster_id FROM pairs JOIN names ON names.id = pairs.b GROUP BY a) e ON e.id = p.id)"""


ORACLE["dbscan_labels"] = _with(POINTS, _clusters(8.0, 10, "xyz")) + "SELECT id AS point_id, is_core, cluster_id FROM labels"
ORACLE["dbscan_numbered"] = _with(POINTS, _clusters(1.5, 5, "xy")) + """
SELECT CASE WHEN l.cluster_id < 0 THEN -1 ELSE k.number END AS cluster_id, count(*) AS points, count(*) FILTER (is_core) AS cores
FROM labels l LEFT JOIN (SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) - 1 AS number
                         FROM (SELECT DISTINCT cluster_id FROM names)) k ON k.cluster_id = l.cluster_id GROUP BY 1"""
ORACLE["normals_and_clusters"] = _with(POINTS, _near(8), COV, _clusters(8.0, 10, "xyz")) + f"""
SELECT cluster_id, count(*) AS points, {_r('avg(l3 / (l1 + l2 + l3))', 4)} AS mean_curvature FROM labels JOIN eig USING (id) GROUP BY cluster_id"""

# --- reference systems ------------------------------------------------------------------------

LONLAT = """ll AS (SELECT c_custkey AS id, 24 + (c_custkey % 600) / 100.0::DOUBLE AS lon, 60 + c_nationkey / 10.0::DOUBLE AS lat FROM customer)"""
_MX, _MY = "6378137.0::DOUBLE * radians(lon)", "6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2))"
ORACLE["mercator"] = _with(LONLAT) + f"SELECT id, {_r(_MX, 3)} AS x, {_r(_MY, 3)} AS y, {_r('lon', 3)} AS lon2, {_r('lat', 3)} AS lat2 FROM ll"
ORACLE["crs_by_row"] = _with(LONLAT) + f"""
SELECT id, CASE WHEN id % 4 IN (0, 3) THEN 'EPSG:4326' ELSE 'EPSG:3857' END AS crs,
       {_r(f'CASE WHEN id % 4 IN (0, 3) THEN lon ELSE {_MX} END', 3)} AS x, {_r(f'CASE WHEN id % 4 IN (0, 3) THEN lat ELSE {_MY} END', 3)} AS y FROM ll"""
# Meridian-arc form of the transverse Mercator projection, independent of the series the library uses.
ORACLE["utm35"] = _with(
    LONLAT,
    "k AS (SELECT 6378137.0::DOUBLE AS a, 1 / 298.257223563::DOUBLE AS f)",
    """e AS (SELECT *, f / (2 - f) AS n, f * (2 - f) AS e2, f * (2 - f) / (1 - f * (2 - f)) AS ep2, radians(lat) AS p, radians(lon - 27) AS dl FROM ll CROSS JOIN k)""",
    """t AS (SELECT *, a / sqrt(1 - e2 * sin(p) * sin(p)) AS nu, tan(p) * tan(p) AS tt, ep2 * cos(p) * cos(p) AS cc, cos(p) * dl AS aa,
       a / (1 + n) * ((1 + n ** 2 / 4 + n ** 4 / 64) * p - 3 / 2.0::DOUBLE * (n - n ** 3 / 8) * sin(2 * p)
          + 15 / 16.0::DOUBLE * (n ** 2 - n ** 4 / 4) * sin(4 * p) - 35 / 48.0::DOUBLE * n ** 3 * sin(6 * p)
          + 315 / 512.0::DOUBLE * n ** 4 * sin(8 * p)) AS m FROM e)""",
) + f"""
SELECT id, {_r('''500000 + 0.9996::DOUBLE * nu * (aa + (1 - tt + cc) * aa ** 3 / 6
         + (5 - 18 * tt + tt * tt + 14 * cc - 58 * tt * cc + 13 * cc * cc + 4 * cc ** 3 - 64 * cc * cc * tt - 24 * cc ** 3 * tt) * aa ** 5 / 120
         + (61 - 479 * tt + 179 * tt * tt - tt ** 3) * aa ** 7 / 5040)''', 3)} AS x,
       {_r('''0.9996::DOUBLE * (m + nu * tan(p) * (aa ** 2 / 2 + (5 - tt + 9 * cc + 4 * cc * cc) * aa ** 4 / 24
         + (61 - 58 * tt + tt * tt + 270 * cc - 330 * tt * cc + 445 * cc * cc + 324 * cc ** 3 - 680 * cc * cc * tt + 88 * cc ** 4 - 600 * cc ** 3 * tt - 192 * cc ** 4 * tt) * aa ** 6 / 720
         + (1385 - 3111 * tt + 543 * tt * tt - tt ** 3) * aa ** 8 / 40320))''', 3)} AS y,
       {_r('lon', 3)} AS lon2, {_r('lat', 3)} AS lat2 FROM t"""

# --- reports and streams ----------------------------------------------------------------------

_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _profile(column: str, number: bool) -> str:
    # The smallest value whose rank reaches the share.
    cuts = [f"(SELECT v FROM (SELECT {column} AS v, row_number() OVER (ORDER BY {column}) AS n, count({column}) OVER () AS m FROM lineitem"
            f" WHERE {column} IS NOT NULL) WHERE n = ceil({q} * m))" for q in (0.25, 0.5, 0.75)]
    stats = [f"avg({column})", f"stddev_samp({column})", *cuts] if number else ["NULL"] * 5
    names = ("mean", "std", "q25", "q50", "q75")
    kind = "int" if column == "l_linenumber" else "bigint" if column.endswith("key") else "double" if number else "string"
    ends = (f"{_r(f'min({column})', 4)}", f"{_r(f'max({column})', 4)}") if number else ("NULL::DOUBLE", "NULL::DOUBLE")
    shown = f"strftime({column}, '%Y-%m-%d')" if column == "l_shipdate" else column
    text = ("NULL::VARCHAR", "NULL::VARCHAR") if number else (f"min({shown})", f"max({shown})")
    return (
        f"SELECT '{column}' AS column_name, '{kind}' AS column_type, count(*) AS rows, count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS distinct_values, "
        + ", ".join(f"{_r(s, 4)} AS {n}" for s, n in zip(stats, names))
        + f", {ends[0]} AS min_number, {ends[1]} AS max_number, {text[0]} AS min_text, {text[1]} AS max_text FROM lineitem"
    )


ORACLE["dataset_profile"] = "\nUNION ALL ".join(
    [_profile(c, True) for c in _NUMBERS] + [_profile(c, False) for c in ("l_returnflag", "l_linestatus", "l_shipdate")]
)
_LINE_CELLS = {
    c: f"CAST(CAST(ROUND({c} * 100) AS BIGINT) AS VARCHAR)" if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    else "strftime(l_shipdate, '%Y-%m-%d')" if c == "l_shipdate" else f"CAST({c} AS VARCHAR)"
    for c in sorted((*_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"))
}
ORACLE["dataset_signature"] = "SELECT count(*) AS rows, CAST(CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws(chr(31), " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 'N' ELSE 'V' || {v} END" for c, v in _LINE_CELLS.items()
) + ")), 1, 15) AS BIGINT) AS HUGEINT)) AS HUGEINT) AS VARCHAR) AS signature FROM lineitem"
ORACLE["guarded_query_index"] = """
SELECT 'status' AS name, 'ok' AS status, least(count(DISTINCT o_orderstatus), 30) AS row_count FROM orders
UNION ALL SELECT 'open_limit', 'ok', least(count(*), 30) FROM lineitem
UNION ALL SELECT 'own_limit', 'ok', least(count(*), 45) FROM orders
UNION ALL SELECT 'refused', 'failed', NULL UNION ALL SELECT 'broken', 'failed', NULL"""
ORACLE["runs_index"] = """
WITH c AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT 'first' AS run_id, 'a' AS name, 'ok' AS status, n AS row_count FROM c
UNION ALL SELECT 'second', 'b', 'ok', n FROM c UNION ALL SELECT 'second', 'broken', 'failed', NULL"""
ORACLE["query_path_union"] = _with(PIX) + """
SELECT CAST(0 AS BIGINT) AS source, 'a.tif' AS query_path, CAST(1 AS BIGINT) AS times UNION ALL SELECT 0, 'b.tif', 2
UNION ALL SELECT 1, 'raw/part_' || p_partkey % 100 || '.tif', count(*) FROM part GROUP BY 2
UNION ALL SELECT 2, raster_id || '.tif', 1 FROM (SELECT DISTINCT raster_id FROM pix)"""
RATE = """rate AS (
  SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) AS window_start, time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
         count(*) AS events FROM events GROUP BY 1, 2, 3)"""
ORACLE["rate_5m"] = _with(RATE) + f"SELECT *, {_r('events / 300.0::DOUBLE')} AS per_second FROM rate"
ORACLE["stream_rate_5m"] = _with(RATE) + f"""
SELECT *, {_r('events / 300.0::DOUBLE')} AS per_second FROM rate
WHERE window_end <= (SELECT max(date_trunc('milliseconds', ts)) - INTERVAL '10 minutes' FROM events)"""
ORACLE["newest_sample"] = """
SELECT event_type, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
ORACLE["stream_newest_sample"] = ORACLE["newest_sample"]

# --- files ------------------------------------------------------------------------------------

ORACLE["raster_pixel_scan"] = _with(PIX, BANDS) + "SELECT * FROM bands"
ORACLE["raster_header_scan"] = _with(PIX) + """
SELECT raster_id, CAST(40 AS BIGINT) AS width, CAST(25 AS BIGINT) AS height, CAST(2 AS BIGINT) AS band_count, 'float64' AS dtype, 'EPSG:3857' AS crs,
       0.0::DOUBLE AS nodata, CAST(raster_id AS DOUBLE) * 1000 AS min_x, 975.0::DOUBLE AS min_y, CAST(raster_id AS DOUBLE) * 1000 + 40 AS max_x, 1000.0::DOUBLE AS max_y
FROM (SELECT DISTINCT raster_id FROM pix)"""
ORACLE["raster_ingest_pairs"] = _with(
    PIX, BANDS, IDX, "scenes AS (SELECT DISTINCT raster_id, CAST(raster_id AS BIGINT) AS n FROM pix)",
    "bad AS (SELECT raster_id, CASE WHEN n % 5 = 4 THEN 'no nir file none_' || raster_id || '.tif'"
    " WHEN n % 3 = 1 THEN 'red and nir differ in shape: 40 x 25 and 40 x 24' END AS error FROM scenes)",
    "side AS (SELECT raster_id, avg(nullif(value, 0)) FILTER (band = 1) AS red_mean, avg(nullif(value, 0)) FILTER (band = 2) AS nir_mean FROM bands GROUP BY raster_id)",
    "done AS (SELECT raster_id, avg(nullif(CAST(value AS FLOAT)::DOUBLE, 0)) AS ndvi_mean, count(*) AS pixels FROM idx GROUP BY raster_id)",
) + f"""
SELECT b.raster_id AS file_id, 'red_' || b.raster_id || '.tif' AS source_path, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS ingest_status,
       error AS error_message, {_r('ndvi_mean', 5)} AS ndvi_mean, {_r('red_mean', 5)} AS red_mean, {_r('nir_mean', 5)} AS nir_mean, pixels
FROM bad b LEFT JOIN side s ON s.raster_id = b.raster_id AND error IS NULL LEFT JOIN done d ON d.raster_id = b.raster_id AND error IS NULL"""
ORACLE["raster_ingest"] = _with(
    PIX, BANDS, IDX, "raw AS (SELECT raster_id, nullif(value, 0) AS value FROM bands)",
    "done AS (SELECT raster_id, nullif(CAST(value AS FLOAT), 0)::DOUBLE AS value FROM idx)",
) + """
SELECT r.raster_id || '.tif' AS filename, CAST(40 AS BIGINT) AS width, CAST(25 AS BIGINT) AS height, 'EPSG:3857' AS crs, """ + ", ".join(
    f"{_r(f'{s[0]}.{n}')} AS {s}_{n}" for s in ("raw", "processed") for n in ("min_val", "max_val", "mean_val", "std_val")
) + """
FROM (SELECT raster_id, min(value) AS min_val, max(value) AS max_val, avg(value) AS mean_val, stddev_pop(value) AS std_val FROM raw GROUP BY 1) r
JOIN (SELECT raster_id, min(value) AS min_val, max(value) AS max_val, avg(value) AS mean_val, stddev_pop(value) AS std_val FROM done GROUP BY 1) p USING (raster_id)"""
ORACLE["incremental_land"] = _with(PIX) + """
SELECT raster_id || '.tif' AS filename, 'ok' AS ingest_status, NULL::VARCHAR AS error_message FROM (SELECT DISTINCT raster_id FROM pix)"""
ORACLE["list_and_land"] = _with(PIX) + """
SELECT raster_id || '.tif' AS filename, true AS whole, true AS id_in_path FROM (SELECT DISTINCT raster_id FROM pix)"""
ORACLE["pointcloud_files"] = """
SELECT 'nation_' || c_nationkey || '_' || c_custkey // 10000 || '.las' AS cloud,
       row_number() OVER (PARTITION BY c_nationkey, c_custkey // 10000 ORDER BY c_custkey) - 1 AS point_id,
       ROUND(c_acctbal / 100, 4) AS x, CAST(c_custkey % 97 AS DOUBLE) AS y, CAST(c_nationkey AS DOUBLE) AS z FROM customer"""
_OWN = " AND a.cloud = b.cloud"
ORACLE["enrich_landed_clouds"] = _with("""pts AS (
  SELECT c_custkey AS id, c_nationkey % 5 || '_' || c_custkey // 10000 AS cloud, c_acctbal / 100 AS x, CAST(c_custkey % 97 AS DOUBLE) AS y,
         CAST(c_nationkey AS DOUBLE) AS z FROM customer)""", """place AS (
  SELECT id, row_number() OVER (PARTITION BY cloud ORDER BY id) - 1 AS point_id FROM pts)""", _near(8, _OWN), COV, _clusters(8.0, 10, "xyz", _OWN)) + f"""
SELECT 'cloud_' || p.cloud || '_enriched.las' AS cloud, i.point_id, ROUND(p.x, 4) AS x, p.y, p.z, p.id % 65536 AS intensity,
       CAST(p.z AS BIGINT) AS classification, ROUND(p.x, 4) AS gps_time, p.id * 7 % 65536 AS red,
       {_r(_FEATURES['curvature'], 4)} AS curvature, l.is_core, coalesce(n.point_id, -1) AS cluster_id
FROM pts p JOIN place i USING (id) JOIN eig USING (id) JOIN labels l USING (id) LEFT JOIN place n ON n.id = l.cluster_id"""
# Channel means and deviations of indexed tiles (0.430 ...) and of image queries (0.485 ...).
_VECTORS = (
    PIX,
    """cell AS (SELECT raster_id, "row" // 8 AS tr, "col" // 8 AS tc, ("row" % 8) // 4 AS pr, ("col" % 8) // 4 AS pc, b1,
       min(b1) OVER w AS lo, max(b1) OVER w AS hi FROM pix WHERE "row" < 24 WINDOW w AS (PARTITION BY raster_id, "row" // 8, "col" // 8))""",
    """mean AS (SELECT raster_id, tr, tc, pr, pc, avg(CASE WHEN hi = lo THEN 0 ELSE floor((b1 - lo) / (hi - lo) * 255) END) / 255 AS m FROM cell GROUP BY ALL)""",
    """vec AS (SELECT *, (m - 0.430::DOUBLE) / 0.213::DOUBLE AS v1, (m - 0.411::DOUBLE) / 0.156::DOUBLE AS v2, (m - 0.296::DOUBLE) / 0.143::DOUBLE AS v3 FROM mean)""",
)
ORACLE["tile_and_embed"] = _with(*_VECTORS) + f"""
SELECT raster_id AS dataset_id, raster_id || '_x' || tc * 8 || '_y' || tr * 8 || '_r' || pr || '_c' || pc AS patch_id,
       CAST(raster_id AS DOUBLE) * 1000 + tc * 8 + pc * 4 AS patch_min_x, CAST(1000 - tr * 8 - pr * 4 - 4 AS DOUBLE) AS patch_min_y,
       CAST(raster_id AS DOUBLE) * 1000 + tc * 8 + pc * 4 + 4 AS patch_max_x, CAST(1000 - tr * 8 - pr * 4 AS DOUBLE) AS patch_max_y,
       {_r('v1 / sqrt(v1 * v1 + v2 * v2 + v3 * v3)', 4)} AS v1, CAST(3 AS BIGINT) AS dim FROM vec"""
ORACLE["repeated_path_queries"] = _with(PATCHES, PROTO, _ranked("best", "seeds", 2)) + f"""
SELECT query_id, patch_id AS match_patch_id, {_r('score')} AS score, rank
FROM best JOIN (SELECT unnest([1, 2, 3]) AS k) ON k <= CAST(substr(query_id, 7) AS INT) % 3 + 1"""
ORACLE["same_name_rasters_topk"] = _with(PATCHES, PROTO, _ranked("best", "seeds", 6)) + f"""
SELECT query_id, patch_id AS match_patch_id, {_r('score')} AS score, 2 * rank - 1 + far AS rank, x0 + 100000 * far AS match_min_x
FROM best JOIN patches USING (patch_id), (SELECT unnest([0, 1]) AS far) WHERE rank <= 3"""
ORACLE["knn_many_leaves"] = ORACLE["knn"]
ORACLE["pointcloud_csv_files"] = f"""
SELECT c_custkey AS point_id, {_r('c_acctbal / 100', 4)} AS x, CAST(c_custkey % 97 AS DOUBLE) AS y, CAST(c_nationkey AS DOUBLE) AS z FROM customer"""
ORACLE["raster_ingest_log"] = _with(PIX) + """
SELECT raster_id || '.tif' AS filename, CASE WHEN short THEN 'failed' ELSE 'ok' END AS ingest_status,
       CASE WHEN short THEN 'unreadable: band 2 out of range for 1 bands' END AS error_message, CAST(CASE WHEN short THEN 0 ELSE 1000 END AS BIGINT) AS index_pixels
FROM (SELECT DISTINCT raster_id, CAST(raster_id AS BIGINT) % 2 = 0 AS short FROM pix)"""
ORACLE["ndvi_two_files"] = _with(PIX, IDX) + f"""
SELECT raster_id, "row", "col", {_r('CAST(value AS FLOAT)', 5)} AS ndvi FROM idx"""
_LENGTH = "sqrt(v1 * v1 + v2 * v2 + v3 * v3)"
ORACLE["embedding_jobs"] = _with(*_VECTORS) + f"""
SELECT raster_id AS dataset_id, raster_id || '_x' || tc * 8 || '_y' || tr * 8 || '_r' || pr || '_c' || pc AS patch_id,
       CAST(raster_id AS DOUBLE) * 1000 + tc * 8 + pc * 4 AS patch_min_x, CAST(1000 - tr * 8 - pr * 4 - 4 AS DOUBLE) AS patch_min_y,
       CAST(raster_id AS DOUBLE) * 1000 + tc * 8 + pc * 4 + 4 AS patch_max_x, CAST(1000 - tr * 8 - pr * 4 AS DOUBLE) AS patch_max_y,
       {_r(f'v1 / {_LENGTH}', 4)} AS v1, {_r(f'v2 / {_LENGTH}', 4)} AS v2, {_r(f'v3 / {_LENGTH}', 4)} AS v3 FROM vec"""
ORACLE["embedding_qa_json"] = _with(PIX) + """
SELECT count(DISTINCT raster_id) * 15 AS tile_count, count(DISTINCT raster_id) * 60 AS embedding_count, CAST(0 AS BIGINT) AS missing_embeddings,
       CAST(3 AS BIGINT) AS embedding_dim FROM pix"""
ORACLE["image_queries"] = _with(
    *_VECTORS,
    """whole AS (SELECT raster_id, avg(CASE WHEN hi = lo THEN 0 ELSE floor((b1 - lo) / (hi - lo) * 255) END) / 255 AS m
       FROM (SELECT raster_id, b1, min(b1) OVER (PARTITION BY raster_id) AS lo, max(b1) OVER (PARTITION BY raster_id) AS hi FROM pix) GROUP BY 1)""",
    """q AS (SELECT raster_id, (m - 0.485::DOUBLE) / 0.229::DOUBLE AS q1, (m - 0.456::DOUBLE) / 0.224::DOUBLE AS q2, (m - 0.406::DOUBLE) / 0.225::DOUBLE AS q3 FROM whole)""",
) + f"""
SELECT query_path, rank, {_r('score', 4)} AS score FROM (
  SELECT query_path, score, row_number() OVER (PARTITION BY query_path ORDER BY score DESC) AS rank FROM (
    SELECT q.raster_id || '.tif' AS query_path, (q1 * v1 + q2 * v2 + q3 * v3) / sqrt(q1 * q1 + q2 * q2 + q3 * q3) / {_LENGTH} AS score FROM q, vec))
WHERE rank <= 3"""
