"""Table schemas, as DDL."""

RASTER_HEADER = (
    "raster_id string, path string, width int, height int, band_count int, dtype string, crs string, "
    "nodata double, a double, b double, c double, d double, e double, f double, error string"
)
RASTER_BLOCK = (
    "raster_id string, path string, dtype string, crs string, nodata double, a double, c double, e double, f double, "
    "row_off int, col_off int, height int, width int, bands array<array<double>>"
)
PIXEL = "raster_id string, row int, col int, band int, value double"
TILE = (
    "dataset_id string, tile_id string, min_x double, min_y double, max_x double, max_y double, "
    "crs string, tile_path string"
)
PATCH = (
    "dataset_id string, tile_id string, tile_path string, patch_id string, patch_row int, patch_col int, "
    "patch_min_x double, patch_min_y double, patch_max_x double, patch_max_y double, embedding array<float>"
)
MATCH = (
    "query_path string, query_x double, query_y double, match_tile_id string, match_tile_path string, "
    "match_patch_id string, score double, rank int, match_min_x double, match_min_y double, "
    "match_max_x double, match_max_y double"
)
CATALOG_RASTER = (
    "file_id string not null, filename string not null, ingested_at timestamp not null, width int not null, "
    "height int not null, crs string not null, min_val double, max_val double, mean_val double, "
    "std_val double, s3_path string not null"
)
INGEST_LOG = (
    "file_id string not null, source_path string not null, ingest_status string not null, error_message string"
)
POINT = "cloud_id string, point_id bigint, x double, y double, z double"
#: What a record of a LAS file may have besides its coordinates; null where the file's point format lacks it.
LAS_DIMENSIONS = (
    "intensity int, return_number int, number_of_returns int, scan_direction int, edge_of_flight_line int, classification int, "
    "class_flags int, scanner_channel int, scan_angle double, user_data int, point_source_id int, gps_time double, "
    "red int, green int, blue int, nir int, extra_bytes binary"
)
BLOB = "path string, modificationTime timestamp, length bigint, content binary"
