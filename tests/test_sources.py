import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import catalog, raster
from terraloom.plans import jobs
from terraloom.sources import files, geotiff, las, pointclouds, queries, rasters, tables
from terraloom.streaming import jobs as streams


@pytest.fixture
def raster_dir(tmp_path):
    (tmp_path / "sub").mkdir()
    ramp = np.arange(16, dtype="uint8").reshape(1, 4, 4)
    (tmp_path / "ramp.tif").write_bytes(geotiff.write(ramp, 1.0, 0.0, -1.0, 0.0, 4326))
    (tmp_path / "sub" / "zero.TIF").write_bytes(geotiff.write(np.zeros((3, 512, 512), "uint8"), 1.0, 0.0, -1.0, 512.0, 4326))
    (tmp_path / "broken.tif").write_bytes(b"not a raster")
    return str(tmp_path)


@pytest.mark.parametrize("dtype", ["uint8", "int16", "uint16", "float32", "float64"])
@pytest.mark.parametrize("deflate", [False, True])
def test_raster_codec_round_trip(dtype, deflate):
    array = np.arange(2 * 5 * 7).reshape(2, 5, 7).astype(dtype)
    data = geotiff.write(array, 2.0, 10.0, -2.0, 50.0, 3067, 7.0, deflate)
    head = geotiff.read_header(data)
    assert (geotiff.read_array(data) == array).all() and geotiff.read_array(data).dtype == dtype
    assert (head["width"], head["height"], head["band_count"], head["dtype"]) == (7, 5, 2, dtype)
    assert head["crs"] == "EPSG:3067" and head["nodata"] == 7.0
    assert [head[k] for k in "abcdef"] == [2.0, 0.0, 10.0, 0.0, -2.0, 50.0]


def test_las_codec_round_trip():
    points = np.round(np.random.default_rng(0).normal(size=(50, 3)) * 100, 2)
    data = las.write(points)
    head = las.read_header(data)
    assert head["count"] == 50
    assert np.allclose(las.read_points(data, 0, 50, head), points, atol=1e-9)
    assert np.allclose(las.read_points(data, 10, 5, head), points[10:15], atol=1e-9)


def test_list_files(spark, raster_dir):
    names = {r[0].split("/")[-1] for r in files.list_files(spark, raster_dir).select("path").collect()}
    assert names == {"ramp.tif", "zero.TIF", "broken.tif"}
    assert files.list_files(spark, raster_dir, "*.TIF").count() == 1
    assert files.list_files(spark, raster_dir, "*.TIF", cross_slash=False).count() == 0
    assert files.list_files(spark, raster_dir + "/none", "*").count() == 0
    plan = files.list_files(spark, raster_dir)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_headers_bounds_and_quarantine(spark, raster_dir):
    heads = rasters.raster_headers(files.blob_scan(spark, raster_dir))
    good, bad = raster.validate(heads)
    assert good.count() == 2
    row = bad.first()
    assert row.path.endswith("broken.tif") and row.errors[0].startswith("unreadable")
    box = rasters.raster_bounds(good.where("width = 512")).first()
    assert (box.min_x, box.min_y, box.max_x, box.max_y) == (0.0, 0.0, 512.0, 512.0)
    assert raster.validate(heads, skip=True)[0].count() == 3


def test_stats_of_the_ramp(spark, raster_dir):
    blobs = files.blob_scan(spark, raster_dir, "ramp.tif")
    heads = rasters.raster_headers(blobs)
    row = raster.block_stats(rasters.raster_blocks(blobs, 3), heads).first()
    assert (row.min_val, row.max_val, row.mean_val) == (0.0, 15.0, 7.5)
    assert row.std_val == pytest.approx(21.25**0.5)
    assert (row.width, row.height, row.crs, row.band_count) == (4, 4, "EPSG:4326", 1)
    pixels = rasters.raster_pixels(rasters.raster_blocks(blobs, 3))
    assert pixels.where("value <> row * 4 + col").count() == 0 and pixels.count() == 16


def test_ndvi_of_one_band_is_zero(spark, raster_dir):
    blobs = files.blob_scan(spark, raster_dir, "ramp.tif")
    index = raster.ndvi_blocks(rasters.raster_blocks(blobs), 1, 1)
    assert {v for (v,) in rasters.raster_pixels(index).select("value").distinct().collect()} == {0.0}


def test_tiling_job(spark, raster_dir, tmp_path):
    index = jobs.tile_rasters(files.blob_scan(spark, raster_dir, "zero.TIF"), str(tmp_path / "out"), 256)
    rows = {r.tile_id: (r.min_x, r.min_y, r.max_x, r.max_y) for r in index.collect()}
    assert rows == {
        "zero_x0_y0": (0, 256, 256, 512), "zero_x0_y256": (0, 0, 256, 256),
        "zero_x256_y0": (256, 256, 512, 512), "zero_x256_y256": (256, 0, 512, 256),
    }
    stored = spark.read.parquet(str(tmp_path / "out" / "tiles"))
    assert stored.select(F.size(F.element_at("bands", 3))).distinct().collect()[0][0] == 65536
    blobs = rasters.blocks_to_blobs(stored, str(tmp_path / "tif"))
    assert files.write_blobs(blobs).count() == 4
    back = rasters.raster_bounds(rasters.raster_headers(files.blob_scan(spark, str(tmp_path / "tif"))))
    assert sorted(tuple(r)[1:] for r in back.collect()) == sorted(rows.values())


def test_embedding_job(spark, raster_dir, tmp_path):
    from terraloom.operators.embed import embed_images, mean_colour_model

    out = str(tmp_path / "out")
    jobs.tile_rasters(files.blob_scan(spark, raster_dir, "zero.TIF"), out, 256)
    patches = jobs.compute_embeddings(spark, out, str(tmp_path / "emb"), mean_colour_model(3))
    assert patches.count() == 4 * 9
    first = patches.where("patch_id = 'zero_x0_y0_r0_c0'").first()
    assert first.patch_max_y == 512 and first.patch_max_x == pytest.approx(256 / 3)
    assert sum(v * v for v in first.embedding) == pytest.approx(1, abs=1e-6)
    qa = spark.read.json(str(tmp_path / "emb" / "qa_metrics")).first()
    assert (qa.tile_count, qa.embedding_count, qa.missing_embeddings, qa.embedding_dim) == (4, 36, 0, 3)
    images = rasters.raster_blocks(files.blob_scan(spark, raster_dir, "ramp.tif"))
    assert embed_images(images, mean_colour_model(2)).first().query_id.endswith("ramp.tif")


def test_ingest_job(spark, raster_dir, tmp_path):
    for _ in range(2):
        done = jobs.ingest_rasters(files.blob_scan(spark, raster_dir, "*.[tT][iI][fF]"), str(tmp_path / "t"), red_band=1, nir_band=1)
        assert done["catalog"].count() == 2 and done["metrics"].count() == 2
        log = {r.ingest_status: r["count"] for r in done["log"].groupBy("ingest_status").count().collect()}
        assert log == {"ok": 2, "failed": 1}
    row = done["catalog"].where("width = 4").first()
    assert row.filename == "ramp.tif" and row.std_val == pytest.approx(21.25**0.5)
    assert row.s3_path == f"raw/{row.ingested_at:%Y%m%d_%H%M%S}_{row.file_id}/ramp.tif"
    assert done["ndvi"].where("path LIKE 'processed/%ramp_ndvi.tif'").count() == 1
    assert spark.read.parquet(str(tmp_path / "t" / "pc_rasters")).count() == 4


def test_paired_ingest(spark, tmp_path):
    ramp = np.arange(16, dtype="uint8").reshape(1, 4, 4)
    data = {
        "in/red.tif": geotiff.write(ramp, 1.0, 0.0, -1.0, 0.0, 4326), "in/nir.tif": geotiff.write(ramp * 3, 1.0, 0.0, -1.0, 0.0, 4326),
        "in/flat.tif": geotiff.write(ramp.reshape(1, 2, 8), 1.0, 0.0, -1.0, 0.0, 4326), "in/bad.tif": b"no raster",
        "in/two.tif": geotiff.write(np.concatenate([ramp, ramp * 3]), 1.0, 0.0, -1.0, 0.0, 4326),
    }
    blobs = spark.createDataFrame(list(data.items()), "path string, content binary")
    pairs = [("good", "in/red.tif", "in/nir.tif"), ("same", "in/red.tif", None), ("flat", "in/red.tif", "in/flat.tif"), ("bad", "in/bad.tif", "in/nir.tif"), ("gone", "in/red.tif", "in/gone.tif")]
    told = spark.createDataFrame(pairs, "pair_id string, red_path string, nir_path string")
    done = jobs.ingest_raster_pairs(blobs, told, str(tmp_path / "t"), block=2)
    log = {r.file_id: r for r in done["log"].collect()}
    assert {k: r.ingest_status for k, r in log.items()} == {"good": "ok", "same": "ok", "flat": "failed", "bad": "failed", "gone": "failed"}
    assert log["flat"].error_message == "red and nir differ in shape: 4 x 4 and 8 x 2" and log["gone"].error_message == "no nir file in/gone.tif"
    assert log["bad"].error_message.startswith("red: unreadable")
    index = {r.raster_id: r for r in done["ndvi"].groupBy("raster_id").agg(F.sum(F.size(F.element_at("bands", 1))).alias("n"), F.max(F.array_max(F.element_at("bands", 1))).alias("top")).collect()}
    assert {k: (r.n, r.top) for k, r in index.items()} == {"good": (16, 0.5), "same": (16, 0.0)}
    assert {r.pair_id: (r.min_val, r.max_val) for r in done["nir_stats"].collect()} == {"good": (0.0, 45.0), "same": (0.0, 15.0)}
    later = jobs.ingest_raster_pairs(blobs, told.limit(0).unionByName(spark.createDataFrame([("x", "in/two.tif", None), ("y", "in/red.tif", "in/red.tif")], told.schema)), str(tmp_path / "u"), nir_band=2)
    assert {r.file_id: r.error_message for r in later["log"].collect()} == {"x": None, "y": "nir: band 2 out of range for 1 bands"}
    # Files whose blocks differ although their headers agree are named by the coverage check.
    blocks = rasters.raster_blocks(blobs.where("path <> 'in/bad.tif'").withColumn("raster_id", F.col("path")), 2)
    lossy = blocks.where("raster_id <> 'in/nir.tif' OR row_off = 0")
    ids = spark.createDataFrame([("a", "in/red.tif", "in/nir.tif"), ("b", "in/red.tif", "in/red.tif"), ("c", "in/none.tif", "in/red.tif")], "pair_id string, red_id string, nir_id string")
    good, odd = raster.covered_pairs(blocks, lossy, ids)
    assert [r.pair_id for r in good.collect()] == ["b"]
    assert {r.pair_id: r.error for r in odd.collect()} == {"a": "red and nir differ in shape: 2 of 4 and 2 blocks in common", "c": "no pixels of red"}


def test_landing_refuses_nameless_and_filters_extensions(spark):
    blobs = spark.createDataFrame([("a/x.LAS", b"1"), ("a/x.txt", b"2")], "path string, content binary")
    landed = files.land_files(blobs, "pointcloud/raw", allowed=(".las", ".csv")).collect()
    assert [r.filename for r in landed] == ["x.LAS"]
    with pytest.raises(Exception, match="cannot derive a file name"):
        files.land_files(spark.createDataFrame([("s3://bucket/", b"1")], "path string, content binary"), "raw").collect()


def test_point_scan(spark, tmp_path):
    points = np.round(np.random.default_rng(0).normal(size=(30, 3)), 2)
    (tmp_path / "a.LAS").write_bytes(las.write(points))
    (tmp_path / "b.csv").write_text("point_id,x,y,z\n" + "\n".join(f"{i},{x},{y},{z}" for i, (x, y, z) in enumerate(points)))
    got = pointclouds.pointcloud_scan(spark, str(tmp_path))
    assert got.groupBy("cloud_id").count().count() == 2
    both = got.groupBy("point_id").agg(F.max("x") - F.min("x"), F.count("*")).collect()
    assert all(abs(r[1]) < 1e-9 and r[2] == 2 for r in both)
    out = jobs.enrich_pointclouds(spark, str(tmp_path), str(tmp_path / "enriched"), 8)
    assert {r[0] for r in out.select("enriched_name").distinct().collect()} == {"a_enriched.LAS", "b_enriched.csv"}
    (tmp_path / "c.txt").write_text("x")
    with pytest.raises(ValueError, match="unsupported"):
        pointclouds.pointcloud_scan(spark, str(tmp_path))


def _las_of_format(kind: int, extra: int = 0) -> bytes:
    """Two records of any point format: known bytes in every field."""
    size = las.RECORD_SIZES[kind] + extra
    records = bytearray(2 * size)
    for k in range(2):
        at = k * size
        struct.pack_into("<3iH", records, at, 100 + k, 200, 300, 1000 + k)
        if kind < 6:
            struct.pack_into("<BBbBH", records, at + 14, 0b11_010_001, 0b011_00110, -7, 9, 77)
        else:
            struct.pack_into("<BBBBhH", records, at + 14, 0b1110_0101, 0b11_10_1001, 200, 9, -500, 77)
            struct.pack_into("<d", records, at + 22, 5.5)
        if kind in las.GPS_AT:
            struct.pack_into("<d", records, at + las.GPS_AT[kind], 5.5)
        if kind in las.COLOUR_AT:
            struct.pack_into("<3H", records, at + las.COLOUR_AT[kind], 11, 22, 33)
        if kind in las.NIR_AT:
            struct.pack_into("<H", records, at + las.NIR_AT[kind], 44)
        records[at + las.RECORD_SIZES[kind] : at + size] = bytes([k + 1]) * extra
    head = bytearray(las.write(np.zeros((0, 3)), 0.5))
    struct.pack_into("<BHI", head, las.FORMAT_AT, kind, size, 2)
    return bytes(head + records)


def test_las_records_of_every_format(spark):
    rows = [(f"{kind}.las", _las_of_format(kind, extra)) for kind in range(11) for extra in (0, 3)]
    rows = [(f"{extra % 2}_{name}", data) for extra, (name, data) in enumerate(rows)]
    rows += [("bad.las", _las_of_format(3)[:-1]), ("none.las", None), ("odd.las", _las_of_format(0)[:104] + b"\x0b" + _las_of_format(0)[105:])]
    got = {(r.cloud_id, r.point_id): r for r in pointclouds.las_records(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert len(got) == 44
    for kind in range(11):
        for extra in (0, 1):
            r = got[f"{extra}_{kind}.las", 1]
            assert (r.x, r.y, r.z, r.intensity, r.user_data, r.point_source_id) == (50.5, 100.0, 150.0, 1001, 9, 77)
            new = kind >= 6
            assert (r.return_number, r.number_of_returns) == ((5, 14) if new else (1, 2))
            assert (r.scan_direction, r.edge_of_flight_line, r.class_flags) == (1, 1, 9 if new else 3)
            assert (r.classification, r.scanner_channel) == ((200, 2) if new else (6, None))
            assert abs(r.scan_angle - (-3.0 if new else -7.0)) < 1e-9
            assert r.gps_time == (5.5 if new or kind in las.GPS_AT else None)
            assert (r.red, r.green, r.blue) == ((11, 22, 33) if kind in las.COLOUR_AT else (None,) * 3)
            assert r.nir == (44 if kind in las.NIR_AT else None)
            assert r.extra_bytes == (b"\x02\x02\x02" if extra else None)


def test_enrich_landed_clouds(spark, tmp_path):
    rng = np.random.default_rng(4)
    data = {}
    for name in ("a", "b"):
        xyz = np.round(rng.normal(size=(40, 3)), 2)
        data[name] = (xyz, {"intensity": rng.integers(0, 65536, 40), "classification": rng.integers(0, 32, 40), "gps_time": rng.normal(size=40)})
    blobs = spark.createDataFrame([(f"in/{n}.las", las.write(x, 0.01, d)) for n, (x, d) in data.items()], "path string, content binary")
    landed = files.write_landed(files.land_files(blobs, "raw"), str(tmp_path / "landed"))
    ids = {r.filename: r.file_id for r in landed.select("filename", "file_id").collect()}
    one = spark.createDataFrame([(ids["a.las"],)] * 2, "file_id string")
    out = str(tmp_path / "enriched")
    stages = [("features", {"k": 5}), ("clusters", {"min_points": 3, "eps": 0.8})]
    index = jobs.enrich_landed_clouds(landed, out, one, stages).collect()
    assert [(r.file_id, r.enriched_name, r.points, r.path) for r in index] == [(ids["a.las"], "a_enriched.las", 40, f"{out}/file_id={ids['a.las']}")]
    jobs.enrich_landed_clouds(landed, out, None, stages)
    jobs.enrich_landed_clouds(landed, out, one, stages)
    rows = spark.read.parquet(out)
    assert rows.count() == 80
    for name, (xyz, dims) in data.items():
        got = rows.where(F.col("file_id") == ids[f"{name}.las"]).orderBy("point_id").toPandas()
        assert np.allclose(got[["x", "y", "z"]], xyz) and np.allclose(got["gps_time"], dims["gps_time"])
        assert got["intensity"].tolist() == dims["intensity"].tolist() and got["classification"].tolist() == dims["classification"].tolist()
        assert got["curvature"].notna().all() and got["cluster_id"].notna().all() and got["nir"].isna().all()
    fresh = lambda rows: spark.createDataFrame(rows, "path string, content binary, file_id string, filename string")
    for bad, message in (
        ([("p", b"x", "1", "a.csv")], "not a LAS cloud"), ([("p", b"x", "1", "a.las")], "not a LAS file"),
        ([("p", las.write(np.ones((2, 3))), "1", "a.las")] * 2, "have the id"),
    ):
        with pytest.raises(ValueError, match=message):
            jobs.enrich_landed_clouds(fresh(bad), out)
    with pytest.raises(ValueError, match="no landed cloud"):
        jobs.enrich_landed_clouds(landed, out, spark.createDataFrame([("nope",)], "file_id string"))
    points = pointclouds.las_points(blobs)
    with pytest.raises(ValueError, match="unknown point stages"):
        jobs.run_point_stages(points, [("magic", {})])
    with pytest.raises(ValueError, match="there already"):
        jobs.run_point_stages(points, [("features", {"k": 5}), ("normals", {})])


def test_synthetic_points(spark):
    assert pointclouds.synthetic_points(spark).count() == 200


def test_query_paths(spark, tmp_path, raster_dir):
    listing = tmp_path / "list.txt"
    listing.write_text("b.tif\n\n  c.tif \n")
    as_json = tmp_path / "list.cfg"
    as_json.write_text('\n["d.tif", "e.tif"]')

    def got(**kw):
        return [r.query_path for r in queries.query_paths(spark, **kw).orderBy("source", "position", "query_path").collect()]

    assert got(inline=" x.tif, ,y.tif", file=str(listing)) == ["x.tif", "y.tif", "b.tif", "c.tif"]
    assert got(inline='["x,1.tif", "x,1.tif"]') == ["x,1.tif", "x,1.tif"]
    assert got(inline="[x.tif, y.tif") == ["[x.tif", "y.tif"]
    assert got(file=str(as_json)) == ["d.tif", "e.tif"]
    assert [p.split("/")[-1] for p in got(inline="q", root=raster_dir)] == ["q", "broken.tif", "ramp.tif"]
    with pytest.raises(ValueError):
        queries.query_paths(spark)
    as_json.write_text('["d.tif", ')
    with pytest.raises(Exception, match="not a JSON list"):
        got(file=str(as_json))


def test_query_coords(spark):
    texts = ['[{"x": 1, "y": 2.5}, {"x": 3}, [4, "5"], [6], 7]', "1 2, 3 4 5, , 6  7", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(r) for r in queries.query_coords(df, "t", ("i",)).orderBy("i", "position").collect()]
    assert got == [(0, 0, 1.0, 2.5), (0, 1, 4.0, 5.0), (1, 0, 1.0, 2.0), (1, 1, 6.0, 7.0)]


def test_matches_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("rank , score,match_patch_id,query_x,query_path\n1, 0.5 , p1 ,,a\nx,nope,p2,3.5,\n")
    got = tables.read_matches_csv(spark, str(path)).orderBy("match_patch_id").collect()
    assert (got[0]["rank"], got[0].score, got[0].match_patch_id, got[0].query_x) == (1, 0.5, "p1", None)
    assert (got[1]["rank"], got[1].score, got[1].query_x, got[1].query_path) == (None, None, 3.5, None)


def test_column_contract(spark):
    with pytest.raises(ValueError, match="min_x"):
        tables.require_columns(spark.createDataFrame([("t",)], "tile_id string"), tables.TILE_COLUMNS, "tile index")


def test_catalog_table(spark):
    tables.create_table(spark, "sample_data", "id BIGINT NOT NULL, note STRING")
    tables.append_table(spark.createDataFrame([("hello", 1)], "note string, id bigint"), "sample_data")
    assert [tuple(r) for r in spark.table("sample_data").collect()] == [(1, "hello")]
    spark.sql("DROP TABLE sample_data")


def test_incremental_landing_is_once_per_path(spark, raster_dir, tmp_path):
    target, state = str(tmp_path / "target"), str(tmp_path / "state")
    streams.incremental_land(spark, raster_dir, target, state, "*.tif")
    streams.incremental_land(spark, raster_dir, target, state, "*.tif")
    assert spark.read.parquet(target + "/log").groupBy("ingest_status").count().count() == 2
    (tmp_path / "new.tif").write_bytes((tmp_path / "ramp.tif").read_bytes())
    streams.incremental_land(spark, raster_dir, target, state, "*.tif")
    assert spark.read.parquet(target + "/log").count() == 3
    assert spark.read.parquet(target + "/quarantine").count() == 1


def test_resolve_by_id(spark):
    listed = ["raw/20240101_000000_a/x.tif", "raw/20240102_000000_a/x.tif", "raw/20240101_000000_b/x.las", "processed/20240101_000000_a/x_ndvi.tif"]
    found = spark.createDataFrame([(p,) for p in listed], "path string")
    ids = spark.createDataFrame([(" a ",), ("b",), (" ",), ("ab",)], "file_id string")

    def got(**kw):
        return {r.file_id: r.path for r in catalog.resolve_by_id(found, ids, base="raw", **kw).collect()}

    assert got(suffix="*.tif") == {"a": listed[0]}
    assert got(pick="latest") == {"a": listed[1], "b": listed[2]}
    with pytest.raises(FileNotFoundError):
        got(strict=True)


def test_metrics_payload(spark):
    rows = [(' {"raw": {"min": 1, "width": 4, "crs": "EPSG:1"}, "processed": {}} ',), ("{broken",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.m for r in df.select(catalog.metrics_payload(F.col("t")).alias("m")).collect()]
    assert (got[0]["min"], got[0].width, got[0].crs, got[0]["max"]) == (1.0, 4, "EPSG:1", None)
    assert all(m is None or m["min"] is None for m in got[1:])


def test_sample_rows(spark):
    from terraloom.plans import reports

    assert reports.sample_rows(spark.range(100)).count() == 30


def test_unreadable_pixels_are_quarantined_not_lost(spark, tmp_path):
    whole = geotiff.write(np.arange(64, dtype="uint8").reshape(1, 8, 8), 1.0, 0.0, -1.0, 0.0)
    at = whole.index((259).to_bytes(2, "little") + (3).to_bytes(2, "little"))
    packed = bytearray(whole)
    packed[at + 8] = 5
    bad_strip = bytearray(whole)
    strip = whole.index((279).to_bytes(2, "little") + (4).to_bytes(2, "little"))
    bad_strip[strip + 8 : strip + 12] = (10**6).to_bytes(4, "little")
    for name, data in (("whole", whole), ("packed", bytes(packed)), ("short", bytes(bad_strip))):
        (tmp_path / f"{name}.tif").write_bytes(data)
    heads = rasters.raster_headers(files.blob_scan(spark, str(tmp_path)))
    good, bad = raster.validate(heads)
    assert good.count() == 1
    reasons = sorted(r.errors[0] for r in bad.collect())
    assert "unsupported compression 5" in reasons[1] and "truncated" in reasons[0]
    assert rasters.raster_blocks(files.blob_scan(spark, str(tmp_path))).count() == 1


def test_globs_see_the_whole_key(spark, tmp_path):
    """The folder's own name may come again below it."""
    inner = tmp_path / "data" / "x" / "data"
    inner.mkdir(parents=True)
    (inner / "y.tif").write_bytes(b"1")
    for root in (str(tmp_path / "data"), f"file://{tmp_path}/data/"):
        assert files.list_files(spark, root, "x/data/*.tif").count() == 1
        assert files.list_files(spark, root, "y.tif").count() == 0


def test_short_and_broken_chunks_are_found(spark):
    import zlib

    from terraloom.sources import geotiff

    pixels = np.full((1, 8, 8), 7, "uint8")
    good = geotiff.write(pixels, 1.0, 0.0, -1.0, 8.0, deflate=True)
    packed = zlib.compress(pixels.tobytes())
    short = zlib.compress(bytes([7] * 24))
    assert good.count(packed) == 1
    files_ = [("ok", good), ("short", good.replace(packed, short.ljust(len(packed), b"\0"))), ("noise", good.replace(packed, b"\1" * len(packed)))]
    blobs = spark.createDataFrame([(n, n, bytearray(b)) for n, b in files_], "raster_id string, path string, content binary")
    errors = {r.raster_id: r.error for r in rasters.raster_headers(blobs, pixels=True).collect()}
    assert errors["ok"] is None and "24 of 64" in errors["short"] and errors["noise"]
    assert {r.raster_id for r in rasters.raster_blocks(blobs, 8).collect()} == {"ok"}


def test_clouds_are_read_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z\n1.5,2.5,3.5\n4,5,6\n")
    (tmp_path / "b.CSV").write_text("z, intensity ,y,point_id,x\n3,9,2,77,1\n")
    (tmp_path / "c.las").write_bytes(las.write(np.array([[1.0, 2.0, 3.0]])))
    (tmp_path / "d.las").write_bytes(las.write(np.ones((5, 3)))[:-7])
    rows = pointclouds.pointcloud_scan(spark, str(tmp_path)).collect()
    got = sorted((r.cloud_id.split("/")[-1], r.x, r.y, r.z) for r in rows)
    assert got == [("a.csv", 1.5, 2.5, 3.5), ("a.csv", 4.0, 5.0, 6.0), ("b.CSV", 1.0, 2.0, 3.0), ("c.las", 1.0, 2.0, 3.0)]
    assert {r.point_id for r in rows if r.cloud_id.endswith("b.CSV")} == {77} and len({r.point_id for r in rows if r.cloud_id.endswith("a.csv")}) == 2
    odd = pointclouds.las_problems(files.blob_scan(spark, str(tmp_path), "*.las")).collect()
    assert [r.path.split("/")[-1] for r in odd] == ["d.las"] and "bytes" in odd[0].error
    (tmp_path / "e.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="no header with x, y and z"):
        pointclouds.csv_points(spark, str(tmp_path))


def test_rasters_without_the_band_are_logged(spark, tmp_path):
    for name, bands in (("one", 1), ("two", 2)):
        (tmp_path / f"{name}.tif").write_bytes(geotiff.write(np.ones((bands, 8, 8), "uint8"), 1.0, 0.0, -1.0, 8.0, 3067))
    done = jobs.ingest_rasters(files.blob_scan(spark, str(tmp_path), "*.tif"), str(tmp_path / "lake"), nir_band=2)
    log = {r.source_path.split("/")[-1]: (r.ingest_status, r.error_message) for r in done["log"].collect()}
    assert log["two.tif"][0] == "ok" and log["one.tif"][0] != "ok" and "band 2 out of range" in log["one.tif"][1]
    assert done["ndvi"].count() == 1


def test_ndvi_of_two_files_stays_packed(spark):
    red = geotiff.write(np.array([[[1, 2], [3, 4]]], "uint8"), 1.0, 0.0, -1.0, 2.0, 3067)
    nir = geotiff.write(np.array([[[3, 2], [0, 4]]], "uint8"), 1.0, 0.0, -1.0, 2.0, 3067)
    blobs = spark.createDataFrame([("r", "r", bytearray(red)), ("n", "n", bytearray(nir))], "raster_id string, path string, content binary")
    pairs = spark.createDataFrame([("p", "r", "n")], "pair_id string, red_id string, nir_id string")
    blocks = rasters.raster_blocks(blobs, 2)
    out = raster.ndvi_pairs(blocks, blocks, pairs).collect()
    assert [(r.raster_id, [round(v, 5) for v in r.bands[0]]) for r in out] == [("p", [0.5, 0.0, -1.0, 0.0])]


def test_null_pixels_count_alike_in_both_ndvi_forms(spark):
    p = spark.createDataFrame([("a", 0, 0, 1, 1.0), ("a", 0, 0, 2, None), ("a", 0, 1, 1, 1.0), ("a", 0, 1, 2, 3.0)], "raster_id string, row int, col int, band int, value double")
    assert sorted(raster.ndvi_bands(p, 1, 2).collect()) == sorted(raster.ndvi(p, p, 1, 2).collect())


def test_published_batches(spark, tmp_path):
    """A batch shows whole once it is published: not before, not after a failed run, and once however often it is repeated."""
    folder = str(tmp_path / "table")
    rows = lambda *v: spark.createDataFrame([(k,) for k in v], "k int")
    tables.publish(rows(1, 2), folder, "a")
    tables.publish(rows(3), folder, "b")
    before = tables.read_published(spark, folder)
    assert sorted(r.k for r in before.collect()) == [1, 2, 3]
    with pytest.raises(Exception):
        tables.publish(rows(9).select(F.raise_error(F.lit("lost"))), folder, "b")
    rows(7).write.parquet(f"{folder}/data/staged")
    (tmp_path / "table" / "entries" / "_left").write_text("99\ta\tdata/staged\n")
    assert sorted(r.k for r in tables.read_published(spark, folder).collect()) == [1, 2, 3]
    tables.publish(rows(4).withColumn("more", F.lit("x")), folder, "a")
    assert sorted(map(tuple, tables.read_published(spark, folder).collect()), key=str) == [(3, None), (4, "x")]
    assert sorted(r.k for r in before.collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="batch name"):
        tables.publish(rows(1), folder, "a\tb")


def test_create_table_keeps_rows_if_asked(spark):
    tables.create_table(spark, "kept_rows", "k int not null, note string")
    tables.append_table(spark.createDataFrame([("n", 1)], "note string, k int"), "kept_rows")
    tables.create_table(spark, "kept_rows", "k int not null, note string", replace=False)
    assert [tuple(r) for r in spark.table("kept_rows").collect()] == [(1, "n")]
    tables.create_table(spark, "kept_rows", "k int not null, note string")
    assert spark.table("kept_rows").count() == 0
    spark.sql("DROP TABLE kept_rows")


def test_newest_samples_of_a_stream(spark, tmp_path):
    """Later files, rows out of order, rows too late for a forgotten window, and a run without news."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    kind = "event_id bigint, ts timestamp_ntz, event_type string, value double"

    def arrive(*rows):
        spark.createDataFrame(rows, "event_id bigint, ts string, event_type string, value double").withColumn(
            "ts", F.col("ts").cast("timestamp_ntz")
        ).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        return {r.event_type: r.value for r in streams.newest_samples(stream, out, state).collect()}

    first = arrive((1, "2024-01-01 10:00:00", "a", 1.0), (2, "2024-01-01 09:59:00", "a", 2.0), (3, "2024-01-01 10:00:00", "a", 3.0), (4, "2024-01-01 10:05:00", "b", 4.0), (5, None, "c", 5.0))
    assert first == {"a": 3.0, "b": 4.0}
    # The time moves on to 12:00; d is within the delay, though older than what was seen.
    assert arrive((6, "2024-01-01 12:00:00", "b", 6.0), (7, "2024-01-01 10:01:00", "a", 7.0), (8, "2024-01-01 09:58:00", "d", 8.0)) == {"a": 7.0, "b": 6.0, "d": 8.0}
    # Rows of windows that ended before 11:50 are late now; those of open windows count in any order.
    assert arrive((9, "2024-01-01 10:30:00", "e", 9.0), (10, "2024-01-01 12:10:00", "a", 10.0), (11, "2024-01-01 12:05:00", "a", 11.0)) == {"a": 10.0, "b": 6.0, "d": 8.0}
    stream = spark.readStream.schema(kind).parquet(source)
    again = {r.event_type: r.value for r in streams.newest_samples(stream, out, state).collect()}
    assert again == {"a": 10.0, "b": 6.0, "d": 8.0}


def test_blocks_are_encoded_a_few_at_a_time(monkeypatch):
    """One batch of many blocks gives many small batches of files."""
    import pyarrow as pa

    monkeypatch.setattr(rasters, "OUT_BYTES", 20_000)
    rows = [
        {"out": f"/r{i}.tif", "dtype": "float64", "row_off": 0, "col_off": 0, "height": 5, "width": 8, "bands": [[float(i)] * 40, [0.5] * 40],
         "a": 1.0, "c": float(i), "e": -1.0, "f": 5.0, "crs": "EPSG:3857", "nodata": None if i % 2 else 0.0} for i in range(300)
    ]
    parts = list(rasters._encoded(iter([pa.RecordBatch.from_pylist(rows)])))
    assert len(parts) > 5 and max(p.nbytes for p in parts) < 25_000
    files_ = [f for p in parts for f in p.to_pylist()]
    assert [f["path"] for f in files_] == [r["out"] for r in rows]
    for f, r in zip(files_, rows):
        head = geotiff.read_header(f["content"])
        assert (head["c"], head["nodata"], head["crs"]) == (r["c"], r["nodata"], r["crs"])
        assert geotiff.read_array(f["content"]).reshape(2, -1).tolist() == r["bands"]
