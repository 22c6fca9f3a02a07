import math
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import prefilter, raster, similarity, spatial
from terraloom.plans import jobs, reports
from terraloom.sources import tables
from terraloom.sources.tables import PATCH_BOUNDS

PATCH = (
    "tile_id string, tile_path string, patch_id string, patch_min_x double, patch_min_y double, patch_max_x double,"
    " patch_max_y double, embedding array<float>"
)


@pytest.fixture
def pair(spark):
    return spark.createDataFrame(
        [("tile_a", "a.tif", "tile_a_r0_c0", 0.0, 0.0, 100.0, 100.0, [1.0, 0.0]),
         ("tile_b", "b.tif", "tile_b_r0_c0", 100.0, 0.0, 200.0, 100.0, [0.0, 1.0])], PATCH,
    )


def test_hand_vectors(spark, pair):
    queries = spark.createDataFrame([("q1", [2.0, 0.0]), ("q2", [0.0, 3.0])], "query_id string, vector array<float>")
    found = jobs.find_similar_patches(pair, queries, k=1).collect()
    assert {(r.query_path, r.match_tile_id, r.score, r["rank"]) for r in found} == {("q1", "tile_a", 1.0, 1), ("q2", "tile_b", 1.0, 1)}
    more = jobs.find_similar_patches(pair, queries, k=9)
    assert more.count() == 4


@pytest.mark.parametrize("x,y,tile", [(50, 50, "tile_a"), (100, 0, "tile_b"), (0, 0, "tile_a"), (199.5, 99.5, "tile_b")])
def test_coordinates_are_half_open(spark, pair, x, y, tile):
    coords = spark.createDataFrame([(float(x), float(y))], "query_x double, query_y double")
    best = jobs.find_similar_patches(pair, coords=coords, k=1).first()
    assert best.match_tile_id == tile and best.query_path is None and best.score == pytest.approx(1.0)
    bare = pair.drop(*PATCH_BOUNDS)
    tiles = pair.selectExpr("tile_id", "patch_min_x min_x", "patch_min_y min_y", "patch_max_x max_x", "patch_max_y max_y")
    best = jobs.find_similar_patches(bare, coords=coords, tiles=tiles, k=1).first()
    assert best.match_tile_id == tile and best.match_max_y == 100.0


def test_errors(spark, pair):
    outside = spark.createDataFrame([(200.0, 0.0)], "query_x double, query_y double")
    with pytest.raises(ValueError, match="contains point"):
        jobs.find_similar_patches(pair, coords=outside)
    with pytest.raises(ValueError, match="tiles are required"):
        jobs.find_similar_patches(pair.drop(*PATCH_BOUNDS), coords=outside)
    with pytest.raises(ValueError, match="no embeddings"):
        jobs.find_similar_patches(pair.withColumn("embedding", F.lit(None).cast("array<float>")), coords=outside)
    with pytest.raises(ValueError, match="no query inputs"):
        jobs.find_similar_patches(pair)
    with pytest.raises(ValueError, match="k must"):
        similarity.top_k(pair, outside.selectExpr("'q' query_id", "array(1.0) vector"), 0)


def brute(vectors, ids, queries, qids, k, skip=False):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        n[n == 0] = 1
        return m / n

    scores = np.round(unit(queries) @ unit(vectors).T, 9)
    out = set()
    for i, q in enumerate(qids):
        order = sorted((j for j in range(len(ids)) if not (skip and ids[j] == q)), key=lambda j: (-scores[i, j], ids[j]))[:k]
        out |= {(q, ids[j], rank, round(float(scores[i, j]), 7)) for rank, j in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("query_bytes,skip", [(8192, False), (600, False), (600, True), (8192, True)])
def test_top_k_against_brute_force(spark, monkeypatch, query_bytes, skip):
    """A third of the patches are copies of one vector, so most ranks hang on ties."""
    monkeypatch.setattr(similarity, "SCORE_BYTES", 10_000)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 8)).astype("float32")
    vectors[::3] = vectors[0]
    vectors[5] = 0
    ids = [f"p{i:04d}" for i in rng.permutation(600)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "patch_id string, embedding array<float>").repartition(5)
    qids, qvec = ids[:60], vectors[:60]
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in zip(qids, qvec)], "query_id string, vector array<float>")
    got = similarity.top_k(df, queries, 7, skip, query_bytes=query_bytes).collect()
    want = brute(vectors.astype("float64"), ids, qvec.astype("float64"), qids, 7, skip)
    assert {(r.query_id, r.patch_id, r["rank"], round(r.score, 7)) for r in got} == want


def test_boxes_of_mixed_sizes(spark):
    rng = np.random.default_rng(2)
    lows = rng.uniform(-100, 100, (300, 2))
    sizes = 2.0 ** rng.integers(-6, 8, (300, 1)) * rng.uniform(0.5, 1, (300, 2))
    points = np.concatenate([rng.uniform(-120, 220, (400, 2)), lows[:50], (lows + sizes)[:50]])
    boxes = spark.createDataFrame(
        [(f"b{i}", *map(float, (*lo, *(lo + s)))) for i, (lo, s) in enumerate(zip(lows, sizes))],
        "id string, x0 double, y0 double, x1 double, y1 double",
    )
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "p int, x double, y double")
    got = {(r.p, r.id) for r in spatial.point_in_box(pts, boxes, "x", "y", ("x0", "y0", "x1", "y1")).collect()}
    highs = lows + sizes
    want = {
        (i, f"b{j}") for i, p in enumerate(points) for j in range(300)
        if (lows[j] <= p).all() and (highs[j] > p).all()
    }
    assert got == want
    plan = spatial.point_in_box(pts, boxes, "x", "y", ("x0", "y0", "x1", "y1"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prefilter_loses_no_partner(spark):
    rows = spark.range(50_000).selectExpr("id", "CAST(id % 977 AS INT) a", "IF(id % 5 = 0, NULL, CAST(id AS STRING)) b")
    keys = rows.where("id % 1000 = 3").select("a", "b")
    kept = prefilter.may_match(rows, keys, ["a", "b"])
    assert kept.columns == rows.columns
    assert {r.id for r in keys.join(rows, ["a", "b"]).collect()} <= {r.id for r in kept.collect()}
    assert kept.count() < 100 and prefilter.may_match(rows, keys.where("false"), ["a", "b"]).count() == 0


def between(plan, scan, wanted):
    """Names of the plan's nodes above the scan whose line holds ``scan``, up to the first that is one of ``wanted``."""
    lines = [line for line in plan.splitlines() if line.strip()]
    at = next(k for k, line in enumerate(lines) if scan in line)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789")), []
    for line in lines[at - 1 :: -1]:
        inner = len(line) - len(line.lstrip(" :+-"))
        if inner < depth:
            depth, name = inner, re.sub(r"^[ :+-]*(\*\(\d+\) )?", "", line).split()[0]
            out.append(name)
            if name in wanted:
                break
    return out


def test_boxes_are_filtered_before_they_are_exchanged(spark, tmp_path):
    boxes = spark.range(20_000).selectExpr("CAST(id AS STRING) id", "CAST(id % 200 AS DOUBLE) x0", "CAST(id DIV 200 AS DOUBLE) y0", "array(1.0D * id, 2.0D) vector")
    boxes.selectExpr("*", "x0 + 1 x1", "y0 + 1 y1").write.parquet(f"{tmp_path}/boxes")
    boxes = spark.read.parquet(f"{tmp_path}/boxes")
    spots = spark.createDataFrame([(3.5, 4.5), (7.0, 7.0), (-1.0, 2.0)], "query_x double, query_y double")
    found = spatial.first_match(spots, boxes, "id", ("x0", "y0", "x1", "y1"), carry=("vector",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    above = between(plan, "FileScan parquet", {"Exchange", "BroadcastHashJoin"})
    assert above[-1] == "BroadcastHashJoin"
    assert {(r.query_x, r.id, tuple(r.vector)) for r in found.collect()} == {(3.5, "803", (803.0, 2.0)), (7.0, "1407", (1407.0, 2.0))}
    seeking, filed = spatial._filed(spots, boxes, "query_x", "query_y", ("x0", "y0", "x1", "y1"))
    assert filed.count() <= 30


def test_window_scan_of_a_table_by_place_skips_files(spark, tmp_path):
    """Of 64 files along the curve a small window reads rows of a few; the same rows in order of id would need them all."""
    boxes = spark.range(65_536).selectExpr("id", "CAST(id * 7919 % 65536 AS INT) at").selectExpr("id", "CAST(at % 256 AS DOUBLE) x0", "CAST(at DIV 256 AS DOUBLE) y0")
    boxes = boxes.selectExpr("*", "x0 + 1 x1", "y0 + 1 y1").unionByName(spark.createDataFrame([(-1, None, None, None, None), (-2, float("nan"), 1.0, 2.0, 3.0)], "id long, x0 double, y0 double, x1 double, y1 double"))
    bounds = ("x0", "y0", "x1", "y1")
    table = tables.write_by_place(boxes, f"{tmp_path}/boxes", bounds, files=64)
    assert table.count() == 65_538
    found = tables.in_window(table, (100, 40, 108, 48), bounds)
    assert "PushedFilters: [IsNotNull(x0)" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.x0, r.y0) for r in found.collect()) == [(float(x), float(y)) for x in range(100, 108) for y in range(40, 48)]
    hit = table.withColumn("file", F.input_file_name()).groupBy("file").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in bounds])
    assert hit.where("min_x0 < 108 AND max_x1 > 100 AND min_y0 < 48 AND max_y1 > 40").count() <= 6


def test_repeated_coordinates_are_all_answered(spark, pair):
    coords = spark.range(20_500).selectExpr("CAST(IF(id % 3 = 0, 150, 50) AS DOUBLE) query_x", "CAST(50 AS DOUBLE) query_y")
    got = jobs.find_similar_patches(pair, coords=coords, k=1).groupBy("match_tile_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"tile_a": 13_666, "tile_b": 6_834}


def test_drawable(spark):
    rows = [("p", "t", 0.51236, 1, 0.0, 0.0, 1.0, 1.0), ("", None, float("nan"), 2, 0.0, 0.0, 1.0, 1.0), ("q", "t", 0.5, 3, None, 0.0, 1.0, 1.0)]
    names = "match_patch_id string, match_tile_id string, score double, rank int, match_min_x double, match_min_y double, match_max_x double, match_max_y double"
    got = similarity.drawable(spark.createDataFrame(rows, names)).orderBy("rank").collect()
    assert [(r.rank_class, r.label) for r in got] == [("first", "patch_id=p · tile_id=t · score=0.5124 · rank=1"), ("second", "rank=2")]


def test_ndvi_edge_values(spark):
    rows = [(1.0, 3.0, 0.5), (0.0, 0.0, 0.0), (-1.0, 1.0, float("inf")), (1.0, -1.0, float("-inf")), (float("nan"), 1.0, 0.0), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "r double, n double, want double")
    got = df.select("want", raster.ndvi_value(F.col("r"), F.col("n")).alias("got"), raster.ndvi_value(F.col("r"), F.col("n"), "null").alias("cut")).collect()
    assert all(r.want == r.got for r in got)
    assert [r.cut for r in got] == [0.5, 0.0, None, None, 0.0, None]


def test_ndvi_join_and_band_range(spark):
    p = spark.createDataFrame([("a", 0, 0, 1, 1.0), ("a", 0, 0, 2, 3.0), ("a", 0, 1, 1, 5.0)], "raster_id string, row int, col int, band int, value double")
    other = p.select("*")
    assert [tuple(r) for r in raster.ndvi_bands(p, 1, 2).collect()] == [("a", 0, 0, 0.5)]
    assert [tuple(r) for r in raster.ndvi(p, other, 1, 2).collect()] == [("a", 0, 0, 0.5)]
    heads = spark.createDataFrame([("a", 2)], "raster_id string, band_count int")
    with pytest.raises(ValueError, match="out of range"):
        raster.band(p, 3, heads)


def test_nodata_rules(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 1.0), ("b", float("nan"), float("nan")), ("c", 4.0, None)]
    df = spark.createDataFrame(rows, "raster_id string, value double, nodata double")
    got = {r.raster_id: (r.min_val, r.pixels) for r in raster.raster_stats(df, nodata="nodata").collect()}
    assert got == {"a": (2.0, 1), "b": (None, 0), "c": (4.0, 1)}


def test_image_bands_and_stretch(spark):
    blocks = spark.createDataFrame([("float32", [[0.0, 5.0, 10.0]]), ("uint8", [[1.0, 2.0, 3.0]] * 4), ("int16", [[7.0, 7.0]] * 3)], "dtype string, bands array<array<double>>")
    ready = raster.stretch_blocks(blocks.withColumn("bands", raster.rgb_bands(F.col("bands")))).collect()
    assert ready[0].bands == [[0.0, 127.0, 255.0]] * 3 and ready[1].bands == [[1.0, 2.0, 3.0]] * 3 and ready[2].bands == [[0.0, 0.0]] * 3
    one = raster.standardize_blocks(blocks.where("dtype = 'uint8'"), "query").first().bands
    assert one[2][0] == pytest.approx((1 / 255 - 0.406) / 0.225)
    with pytest.raises(Exception, match="image of 2 bands"):
        blocks.select(raster.rgb_bands(F.slice("bands", 1, 2))).where("dtype = 'uint8'").collect()


def test_no_full_tile_gives_a_typed_empty_table(spark):
    heads = spark.createDataFrame([("r", "r.tif", 10, 300, "EPSG:4326", 1.0, 0.0, -1.0, 0.0)], "raster_id string, path string, width int, height int, crs string, a double, c double, e double, f double")
    tiles = raster.tile_grid(heads, 256)
    assert tiles.count() == 0 and "min_x" in tiles.columns
    assert raster.tile_grid(heads, 256, edges=True).count() == 2


def test_user_model_as_a_vectorised_function(spark, pair):
    """Any vectorised column function can embed queries; blank paths are left out."""
    import pandas as pd

    @F.pandas_udf("array<float>")
    def by_name(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: [1.0, 0.0] if "a" in p else [0.0, 1.0])

    images = spark.createDataFrame([("a.tif",), ("z.tif",), ("",), (None,)], "query_path string")
    vectors = similarity.path_queries(images, by_name(F.col("query_path")))
    found = {(r.query_path, r.match_tile_id) for r in jobs.find_similar_patches(pair, vectors, k=1).collect()}
    assert found == {("a.tif", "tile_a"), ("z.tif", "tile_b")}


def test_search_agrees_with_the_column_functions(spark, pair):
    from terraloom.functions import vectors as v

    query = spark.createDataFrame([("q", [3.0, 4.0])], "query_id string, vector array<double>")
    got = {r.patch_id: r.score for r in similarity.top_k(pair, query, 2).collect()}
    want = pair.select("patch_id", v.cosine(F.col("embedding"), F.array(F.lit(3.0), F.lit(4.0))).alias("s")).collect()
    assert got == pytest.approx({r.patch_id: r.s for r in want}, abs=1e-9)


def test_repeated_image_query_is_answered_as_often(spark, pair):
    vector = pair.first().embedding
    queries = spark.createDataFrame([("q", vector), ("q", vector), ("r", vector)], "query_id string, vector array<float>")
    got = sorted((r.query_path, r["rank"], r.match_patch_id) for r in jobs.find_similar_patches(pair, queries, k=2).collect())
    one = [(rank, patch) for q, rank, patch in got if q == "r"]
    assert got == sorted([("q", *x) for x in one] * 2 + [("r", *x) for x in one]) and len(one) == 2
    other = spark.createDataFrame([("q", [1.0] * len(vector)), ("q", [0.5] * len(vector))], "query_id string, vector array<float>")
    with pytest.raises(Exception, match="two vectors"):
        jobs.find_similar_patches(pair, other, k=2).collect()


def test_equally_named_rasters_stay_apart(spark, pair):
    """Two folders, equal file names: all ids repeat, only the raster differs."""
    moved = {b: F.col(b) + 1000 for b in ("patch_min_x", "patch_max_x")}
    both = pair.withColumn("raster_id", F.lit("s1/scene.tif")).unionByName(
        pair.withColumns({"raster_id": F.lit("s2/scene.tif"), **moved, "embedding": F.transform("embedding", lambda v: -v)})
    )
    query = spark.createDataFrame([("q", pair.first().embedding)], "query_id string, vector array<float>")
    got = jobs.find_similar_patches(both, query, k=4).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4] and len({(r.match_patch_id, r.match_min_x) for r in got}) == 4
    coords = spark.createDataFrame([(50.0, 50.0), (1050.0, 50.0)], "query_x double, query_y double")
    best = {r.query_x: r for r in jobs.find_similar_patches(both, coords=coords, k=1).collect()}
    assert best[50.0].match_patch_id == best[1050.0].match_patch_id and best[50.0].match_min_x + 1000 == best[1050.0].match_min_x
    others = jobs.find_similar_patches(both, coords=coords, k=4, exclude_self=True).groupBy("query_x").count().collect()
    assert {r[0]: r[1] for r in others} == {50.0: 3, 1050.0: 3}


def test_exact_quantiles(spark):
    """Selection in many rounds equals sorting, whatever the spread, the repeats and the missing values."""
    rng = np.random.default_rng(5)
    n = 6000
    heavy = np.where(rng.random(n) < 0.6, 7.0, rng.normal(size=n))
    wide = np.exp(rng.normal(size=n) * 40) * rng.choice([-1, 1], n)
    rows = [
        (float(h), float(w), int(t), None if k % 3 else float(k), float("nan") if k % 5 == 0 else float(k % 11), None, 4)
        for k, (h, w, t) in enumerate(zip(heavy, wide, rng.integers(0, 2, n)))
    ]
    df = spark.createDataFrame(rows, "heavy double, wide double, two int, holes double, nans double, none double, one int").repartition(4)
    cuts = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    columns = df.columns
    for accuracy, few in ((20, 10), (10_000, 100_000)):
        got = {(r.column_name, r.quantile): r.value for r in reports.exact_quantiles(df, columns, cuts, accuracy, few).collect()}
        assert len(got) == len(columns) * len(cuts)
        for i, name in enumerate(columns):
            values = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
            for q in cuts:
                want = values[max(1, math.ceil(Fraction(str(q)) * len(values))) - 1] if values else None
                assert got[name, q] == want, (name, q)
    assert reports.exact_quantiles(df, []).count() == 0
    empty = reports.profile(df.where("false"), exact=True).collect()
    assert len(empty) == len(columns) and all(r.q50 is None and r.rows == 0 for r in empty)


def test_top_k_within_one_task_ranks_equal_ids_by_key_and_outlasts_odd_vectors(spark):
    """All in one batch: more patches of one name and vector than k, the smallest keys last, and a vector that is no number."""
    rows = [("same", f"r{99 - i:02d}", [1.0, 2.0]) for i in range(40)] + [("odd", "r00", [float("nan"), 1.0]), ("else", "r00", [1.0, -2.0])]
    df = spark.createDataFrame(rows, "patch_id string, key string, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([("q", [1.0, 2.0])], "query_id string, vector array<double>")
    got = similarity.top_k(df, asked, 3, carry=("key",), key="key").orderBy("rank").collect()
    assert [(r.patch_id, r["key"], r.score) for r in got] == [("same", f"r{i}", 1.0) for i in (60, 61, 62)]


def test_scores_of_many_queries_and_copies_take_little_memory():
    """2000 queries and 4000 copies of one patch: every pair is level with the best."""
    import inspect
    import tracemalloc

    import pyarrow as pa

    order = [["patch_id"]] if "order" in inspect.signature(similarity._Best).parameters else []
    best = similarity._Best(np.array([f"q{i}" for i in range(2000)], object), np.tile([[0.6, 0.8]], (2000, 1)), 3, *order, None)
    facts = pa.RecordBatch.from_arrays([pa.array([f"some_long_name_of_a_patch_{i:05d}" for i in range(4000, 0, -1)])], ["patch_id"])
    tracemalloc.start()
    best.add(facts, np.tile([[0.6, 0.8]], (4000, 1)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    out = pa.Table.from_batches(list(best.batches()))
    assert out.num_rows == 6000 and set(out["patch_id"].to_pylist()) == {f"some_long_name_of_a_patch_{i:05d}" for i in (1, 2, 3)}
    assert peak < 250e6
