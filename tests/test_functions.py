import math

import pytest
from pyspark.sql import functions as F

from terraloom.functions import crs, eigen, geometry, paths, text, vectors


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def each(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("p"))).collect()]


def test_names(spark):
    given = ["s3://bucket/raw/a.b.TIF", "a.las", "/x/y/", "s3://bucket/", "s3://bucket", "", ".las", "x/.a.csv", "noext", "s3://"]
    assert each(spark, given, paths.basename) == ["a.b.TIF", "a.las", "y", None, None, None, ".las", ".a.csv", "noext", None]
    assert each(spark, given, paths.extension) == [".tif", ".las", "", None, None, None, "", ".csv", "", None]
    assert each(spark, given, paths.stem) == ["a.b", "a", "y", None, None, None, ".las", ".a", "noext", None]
    assert each(spark, given, paths.dataset_name)[:2] == ["a", "a"]
    assert each(spark, ["raw/x/c.las", "c"], paths.enriched_name) == ["c_enriched.las", "c_enriched"]


def test_derived_paths(spark):
    given = ["s3://b/raw/1/a.tif", "raw/raw/a.tif", "x/a.tif", "raw/a.jp2", "/data/raw/raw/a.tif"]
    assert each(spark, given, paths.processed_path) == [
        "s3://b/processed/1/a_ndvi.tif", "raw/processed/a_ndvi.tif", "x/a_ndvi.tif", "processed/a.jp2_ndvi", "/data/processed/raw/a_ndvi.tif",
    ]
    assert each(spark, ["raw/a.jp2"], lambda p: paths.processed_path(p, F.lit("id1"))) == ["processed/id1/ndvi.tif"]
    assert each(spark, ["", None, "out", "out/", "out/r.parquet"], lambda p: paths.results_path(p, F.lit("emb"))) == [
        "emb/similarity_results.parquet", "emb/similarity_results.parquet", "out/similarity_results.parquet",
        "out/similarity_results.parquet", "out/r.parquet",
    ]
    assert each(spark, ["out/r.parquet", "out"], paths.csv_twin) == ["out/r.csv", "out/similarity_results.csv"]
    assert one(spark, paths.join_uri(F.lit("s3://b/"), F.lit("/x/"), F.lit(None).cast("string"), F.lit("y")))[0] == "s3://b/x/y"


def test_landed_path_round_trip(spark):
    ts = F.to_timestamp(F.lit("2024-05-06 07:08:09"))
    path = paths.landed_path(F.lit("raw"), ts, F.lit("ab-c_d"), F.lit("a.tif"))
    row = one(spark, path, paths.landed_id(path), paths.landed_at(path) == ts, paths.landed_id(F.lit("raw/x/a.tif")))
    assert tuple(row) == ("raw/20240506_070809_ab-c_d/a.tif", "ab-c_d", True, None)


def test_globs(spark):
    df = spark.createDataFrame([("raw/1/a.tif",), ("raw/a.tif",), ("raw/a.TIF",), ("raw/[x].tif",)], "p string")

    def match(glob, cross):
        return sorted(r[0] for r in df.where(F.col("p").rlike(paths.glob_regex(glob, cross))).collect())

    assert match("raw/*.tif", True) == ["raw/1/a.tif", "raw/[x].tif", "raw/a.tif"]
    assert match("raw/*.tif", False) == ["raw/[x].tif", "raw/a.tif"]
    assert match("raw/[!a]*.tif", False) == ["raw/[x].tif"]
    assert match("raw/?.tif", False) == ["raw/a.tif"]


def test_vectors(spark):
    v = F.array(F.lit(3.0), F.lit(4.0))
    zero = F.array(F.lit(0.0), F.lit(0.0))
    row = one(spark, vectors.l2_norm(v), vectors.unit(v), vectors.unit(zero), vectors.cosine(v, v), vectors.dimension(v))
    assert row[0] == 5.0 and row[1] == [0.6, 0.8] and row[2] == [0.0, 0.0]
    assert row[3] == pytest.approx(1.0) and row[4] == 2


@pytest.mark.parametrize("tokens,side", [(10, 3), (9, 3), (17, 4), (197, 14), (196, 14), (1, 1), (2, 1)])
def test_grid_side(spark, tokens, side):
    assert one(spark, geometry.grid_side(F.lit(tokens)))[0] == side


def test_grid_side_refuses_other_counts(spark):
    with pytest.raises(Exception, match="not a perfect square"):
        one(spark, geometry.grid_side(F.lit(12)))


def test_patch_tokens(spark):
    ten = F.sequence(F.lit(0), F.lit(9))
    nine = F.sequence(F.lit(0), F.lit(8))
    row = one(spark, geometry.patch_tokens(ten), geometry.patch_tokens(nine))
    assert row[0] == list(range(1, 10)) and row[1] == list(range(9))


def test_mercator_known_points(spark):
    x, y = crs.to_mercator(F.lit(180.0), F.lit(0.0))
    x2, y2 = crs.to_mercator(F.lit(24.945831), F.lit(60.192059))
    row = one(spark, x, y, x2, y2)
    assert row[0] == pytest.approx(20037508.342789, abs=1e-5) and row[1] == pytest.approx(0, abs=1e-6)
    r = 6378137.0
    assert row[2] == pytest.approx(math.radians(24.945831) * r, abs=1e-6)
    assert row[3] == pytest.approx(r * math.log(math.tan(math.pi / 4 + math.radians(60.192059) / 2)), abs=1e-6)


def test_utm_round_trip_and_axis(spark):
    df = spark.sql("SELECT lon, lat FROM (SELECT explode(sequence(19, 32)) AS lon), (SELECT explode(sequence(0, 80, 5)) AS lat)")
    there = crs.reproject(df, "lon", "lat", "EPSG:4326", "EPSG:3067")
    back = crs.reproject(there, "x", "y", "EPSG:3067", "EPSG:4326", ("lon2", "lat2"))
    worst = back.select(F.max(F.abs(F.col("lon") - F.col("lon2"))), F.max(F.abs(F.col("lat") - F.col("lat2")))).first()
    assert worst[0] < 1e-8 and worst[1] < 1e-8
    axis = there.where("lon = 27 AND lat = 0").first()
    assert axis["x"] == pytest.approx(500000.0) and axis["y"] == pytest.approx(0.0, abs=1e-6)


def test_crs_names(spark):
    assert each(spark, ["3067", " EPSG:3857 ", "", None], crs.normalise_crs) == ["EPSG:3067", "EPSG:3857", "EPSG:4326", "EPSG:4326"]
    df = spark.createDataFrame([(25.0, 60.0, "EPSG:9999")], "lon double, lat double, crs string")
    with pytest.raises(ValueError):
        crs.reproject(df, "lon", "lat", "EPSG:4326", "EPSG:9999")
    with pytest.raises(Exception, match="unknown coordinate reference system"):
        crs.reproject_by_column(df, "lon", "lat", "crs").collect()


def test_text(spark):
    row = one(
        spark, text.fixed(F.lit(1234.56789), 3), text.fixed(F.lit(float("nan")), 3), text.json_or_empty(F.lit('{"k": 3}'), "k int"),
        text.json_or_empty(F.lit('{"k": '), "k int"), text.json_or_empty(F.lit(None).cast("string"), "k int"),
    )
    assert row[0] == "1234.568" and row[1] == "" and row[2].k == 3 and row[3].k is None and row[4].k is None


def test_eigen_helpers():
    import numpy as np

    rng = np.random.default_rng(5)
    group = rng.integers(0, 40, 900)
    group[group == 7] = 8
    points = rng.normal(size=(900, 3)) * [100.0, 1.0, 0.01] + 1e5
    cov = eigen.covariances(group, points, 41)
    for g in range(41):
        want = np.cov(points[group == g].T, bias=True) if (group == g).any() else np.zeros((3, 3))
        assert np.allclose(cov[g], want, rtol=1e-9, atol=1e-9)
    values, normal = eigen.symmetric_eigen(cov)
    assert (np.diff(values, axis=1) <= 0).all() and (values >= 0).all() and (normal[:, 2] >= 0).all()
    assert normal[7].tolist() == [0.0, 0.0, 1.0] and normal[40].tolist() == [0.0, 0.0, 1.0]
    full = [g for g in range(40) if g != 7]
    assert np.allclose(np.linalg.norm(normal, axis=1), 1)
    image = np.einsum("gij,gj->gi", cov[full], normal[full])
    assert np.allclose(image, values[full, 2:] * normal[full], atol=1e-9)


def test_shape_features(spark):
    df = spark.createDataFrame([(4.0, 2.0, 1.0), (1.0, 0.0, 0.0), (0.0, 0.0, 0.0)], "l1 double, l2 double, l3 double")
    a, b, c = df.select(*[v.alias(n) for n, v in eigen.shape_features().items()]).collect()
    assert (a.linearity, a.planarity, a.sphericity, a.anisotropy, a.eigen_sum, a.omnivariance) == (0.5, 0.25, 0.25, 0.75, 7.0, 2.0)
    assert a.eigenentropy == pytest.approx(-sum(v / 7 * math.log(v / 7) for v in (4, 2, 1))) and a.curvature == pytest.approx(1 / 7)
    assert b.linearity == 1 and b.eigenentropy == 0 and set(c) == {0.0}
