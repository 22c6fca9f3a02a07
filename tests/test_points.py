import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terraloom.operators import components, dbscan, neighbours
from terraloom.plans import jobs

BIG = np.iinfo(np.int64).max


def frame(spark, xyz, ids, cloud="a", dims="xyz"):
    pdf = pd.DataFrame(xyz, columns=list(dims)).assign(point_id=ids, cloud_id=cloud)
    return spark.createDataFrame(pdf)


def distances(xyz):
    d2 = np.zeros((len(xyz), len(xyz)))
    for a in range(xyz.shape[1]):
        d2 += np.square(xyz[:, a, None] - xyz[None, :, a])
    return d2


def brute_knn(xyz, ids, k):
    order = np.argsort(ids)
    d2 = distances(xyz[order])
    np.fill_diagonal(d2, np.inf)
    near = np.argsort(d2, axis=1, kind="stable")[:, :k]
    return {int(i): [int(v) for v in ids[order][row]] for i, row in zip(ids[order], near)}


def got_knn(df, k, **kw):
    lists = neighbours.neighbour_lists(df, k, **kw).select("cloud_id", "point_id", F.expr("transform(nbrs, n -> n.id)").alias("ids"))
    return {(r.cloud_id, r.point_id): r.ids for r in lists.collect()}


def clouds():
    rng = np.random.default_rng(4)
    dense = np.concatenate([rng.normal(0, 0.01, (700, 3)), rng.uniform(-50, 50, (500, 3))])
    copies = np.concatenate([np.zeros((500, 3)), np.tile([[1.0, 2.0, 3.0]], (9, 1)), rng.normal(0, 1, (700, 3))])
    lattice = np.stack(np.meshgrid(range(11), range(11), range(8)), -1).reshape(-1, 3).astype("float64")
    ring = np.stack([np.cos(np.linspace(0, 6.28, 600)), np.sin(np.linspace(0, 6.28, 600)), np.zeros(600)], 1)
    outliers = np.concatenate([rng.normal(0, 0.1, (900, 3)), rng.normal(30, 1, (60, 3)), ring])
    return {"dense": dense, "copies": copies, "lattice": lattice, "outliers": outliers}


@pytest.mark.parametrize("name", ["dense", "copies", "lattice", "outliers"])
@pytest.mark.parametrize("leaf_rows", [64, 4096])
def test_knn_against_brute_force(spark, monkeypatch, name, leaf_rows):
    monkeypatch.setattr(neighbours, "PROBES_PER_GROUP", 50)
    xyz = clouds()[name]
    ids = np.random.default_rng(1).permutation(len(xyz)) * 2 + 1
    got = got_knn(frame(spark, xyz, ids), 8, leaf_rows=leaf_rows)
    want = brute_knn(xyz, ids, 8)
    assert {k[1]: v for k, v in got.items()} == want


@pytest.mark.parametrize("name", ["dense", "copies", "outliers"])
@pytest.mark.parametrize("k", [8, 90])
def test_knn_on_two_levels(spark, monkeypatch, name, k):
    """Few parts on the driver, many leaves cut in tasks; lists shorter and longer than a leaf was asked to be."""
    monkeypatch.setattr(neighbours, "PROBES_PER_GROUP", 50)
    monkeypatch.setattr(neighbours, "ROUTE_ROWS", 100)
    xyz = clouds()[name]
    ids = np.random.default_rng(1).permutation(len(xyz)) * 2 + 1
    df = frame(spark, xyz, ids).unionByName(frame(spark, xyz[:300] + 5, np.arange(300), "b")).unionByName(frame(spark, xyz[:5], np.arange(5), "c"))
    got = got_knn(df, k, leaf_rows=32, most_parts=4)
    assert {i: v for (c, i), v in got.items() if c == "a"} == brute_knn(xyz, ids, k)
    assert {i: v for (c, i), v in got.items() if c == "b"} == brute_knn(xyz[:300] + 5, np.arange(300), k)
    assert {i: v for (c, i), v in got.items() if c == "c"} == {i: v[:4] for i, v in brute_knn(xyz[:5], np.arange(5), 4).items()}


@pytest.mark.parametrize("most_parts", [2, 1000])
def test_knn_where_leaves_hold_too_few(spark, monkeypatch, most_parts):
    """A sample that misjudges the cloud leaves parts with next to nothing: their points ask in widening balls, not everywhere."""
    rng = np.random.default_rng(6)
    xyz = np.concatenate([rng.normal(0, 1, (500, 3)), rng.uniform(900, 1000, (6, 3)), [[-4000.0, 0, 0]]])
    fit = neighbours.SpaceTree.fit.__func__
    monkeypatch.setattr(neighbours.SpaceTree, "fit", classmethod(lambda cls, sample, leaves: fit(cls, np.concatenate([sample, xyz[-7:], xyz[-7:] * 0.9]), leaves * 8)))
    asked = []
    probe = neighbours._probe
    monkeypatch.setattr(neighbours, "_probe", lambda probes, placed, k: (asked.append(probes.count()), probe(probes, placed, k))[1])
    got = got_knn(frame(spark, xyz, np.arange(507)), 9, leaf_rows=40, most_parts=most_parts)
    assert {i: v for (_, i), v in got.items()} == brute_knn(xyz, np.arange(507), 9)
    assert len(asked) > 1


def test_knn_keeps_clouds_apart_and_small_clouds_whole(spark):
    rng = np.random.default_rng(2)
    one, two = rng.normal(size=(300, 3)), rng.normal(size=(4, 3))
    df = frame(spark, one, np.arange(300), "one").unionByName(frame(spark, two, np.arange(4), "two"))
    df = df.unionByName(frame(spark, two[:1], np.array([7]), "single"))
    got = got_knn(df, 6, leaf_rows=64)
    assert {k[1]: v for k, v in got.items() if k[0] == "one"} == brute_knn(one, np.arange(300), 6)
    assert sorted(got[("two", 0)]) == [1, 2, 3] and got[("single", 7)] == []
    features = neighbours.eigen_features(df.where("cloud_id <> 'one'"), 6).where("cloud_id = 'single'").first()
    assert (features.linearity, features.density, features.height_range, features.nz) == (0.0, 0.0, 0.0, 1.0)


def test_crowded_place_is_split_over_lookups(spark):
    """More copies than one task should join: the heavy-key path gives every copy its neighbours."""
    df = spark.range(25_000).selectExpr("'a' cloud_id", "id point_id", "CAST(id % 2 AS DOUBLE) * 5 x", "0.0D y", "0.0D z")
    out = neighbours.neighbour_lists(df, 3)
    assert out.count() == 25_000
    wrong = out.where("exists(nbrs, n -> n.id = point_id OR n.d2 <> 0 OR n.x <> x) OR size(nbrs) <> 3")
    assert wrong.count() == 0


def test_plane_and_line(spark):
    rng = np.random.default_rng(3)
    flat = np.concatenate([rng.uniform(0, 1, (200, 2)), np.zeros((200, 1))], 1)
    rows = neighbours.normals(frame(spark, flat, np.arange(200)), 8).collect()
    assert all(abs(r.nz - 1) < 1e-12 and r.curvature < 1e-12 for r in rows)
    line = np.outer(np.arange(50), [1.0, 2.0, 2.0])
    rows = neighbours.eigen_features(frame(spark, line, np.arange(50)), 6).collect()
    assert all(abs(r.linearity - 1) < 1e-9 and r.planarity < 1e-9 for r in rows)
    assert all(abs(r.nx + 2 * r.ny + 2 * r.nz) < 1e-6 for r in rows)


def brute_dbscan(xyz, ids, eps, min_points):
    near = distances(xyz) <= eps * eps
    core = near.sum(1) >= min_points
    label = np.where(core, ids, BIG)
    while True:
        low = np.where(near & core[None, :], label[None, :], BIG).min(1)
        new = np.where(core, np.minimum(label, low), label)
        if (new == label).all():
            break
        label = new
    return {int(i): (bool(c), int(v) if c else (int(w) if w < BIG else -1)) for i, c, v, w in zip(ids, core, label, low)}


CASES = {
    "uniform": (lambda r: r.uniform(0, 20, (900, 3)), 1.8, 6, "xyz"),
    "blobs": (lambda r: np.concatenate([r.normal(0, 0.3, (400, 3)), r.normal(3, 0.3, (400, 3)), r.uniform(-3, 6, (200, 3))]), 1.0, 10, "xyz"),
    "copies": (lambda r: np.concatenate([np.zeros((500, 3)), r.normal(0, 1, (500, 3)), np.tile([[2.0, 0, 0]], (200, 1))]), 0.7, 8, "xyz"),
    "joined only by closest points": (lambda r: np.concatenate([r.uniform(0, 0.5, (500, 2)), r.uniform(0, 0.5, (500, 2)) + [1.48, 0]]), 1.0, 10, "xy"),
    "apart by a hair": (lambda r: np.concatenate([r.uniform(0, 0.5, (400, 2)), r.uniform(0, 0.5, (400, 2)) + [1.501, 0]]), 1.0, 10, "xy"),
    "lattice at exactly eps": (lambda r: np.stack(np.meshgrid(range(9), range(9), range(5)), -1).reshape(-1, 3).astype(float), 1.0, 4, "xyz"),
}


@pytest.mark.parametrize("name", CASES)
def test_dbscan_against_brute_force(spark, monkeypatch, name):
    monkeypatch.setattr(dbscan, "GROUP_POINTS", 64)
    make, eps, min_points, dims = CASES[name]
    rng = np.random.default_rng(6)
    xyz = make(rng)
    ids = rng.permutation(len(xyz)) * 3 + 5
    got = dbscan.dbscan(frame(spark, xyz, ids, dims=dims), min_points, eps, tuple(dims)).collect()
    assert {r.point_id: (r.is_core, r.cluster_id) for r in got} == brute_dbscan(xyz, ids, eps, min_points)


def test_dbscan_renumbers_per_cloud(spark):
    spots = np.repeat(np.arange(6.0) * 100, 5)[:, None] * np.ones((1, 3))
    ids = np.arange(30)[::-1].copy()
    df = frame(spark, spots, ids, "a").unionByName(frame(spark, spots[:10], ids[:10], "b"))
    df = df.unionByName(frame(spark, [[9e3, 0, 0]], [99], "b"))
    got = dbscan.dbscan(df, 5, 1.0, renumber=True)
    sizes = {(r.cloud_id, r.cluster_id): r["count"] for r in got.groupBy("cloud_id", "cluster_id").count().collect()}
    assert sizes == {**{("a", i): 5 for i in range(6)}, ("b", 0): 5, ("b", 1): 5, ("b", -1): 1}
    named = {r.point_id: r.cluster_id for r in got.where("cloud_id = 'a'").collect()}
    assert named == {i: i // 5 for i in range(30)}


def test_normals_and_clusters_job(spark):
    rng = np.random.default_rng(8)
    df = frame(spark, rng.normal(size=(200, 3)), np.arange(200))
    out = jobs.normals_and_clusters(df, 8, 10, 2.0)
    assert out.count() == 200 and {"nx", "curvature", "cluster_id"} <= set(out.columns)


@pytest.mark.parametrize("task_edges", [3, 40])
def test_components_settled_by_rounds_and_by_one_task(spark, task_edges):
    rng = np.random.default_rng(8)
    links = [(c, int(a), int(b)) for c, n in (("p", 60), ("q", 90), (None, 40)) for a, b in rng.integers(0, 70, (n, 2)) * 3]
    df = spark.createDataFrame(links, "cloud_id string, a bigint, b bigint").where("cloud_id IS NOT NULL")
    whole = {(r.cloud_id, r.node): r.label for r in components.connected_components(df).collect()}
    rounds = {(r.cloud_id, r.node): r.label for r in components.connected_components(df, task_edges).collect()}
    assert whole == rounds
    assert all(whole[c, a] == whole[c, b] <= min(a, b) for c, a, b in links if c and a != b)


def test_components(spark):
    rng = np.random.default_rng(9)
    chain = [(i, i + 1) for i in range(0, 120)]
    star = [(500, 500 + i) for i in range(1, 200)]
    random = rng.integers(1000, 1400, (250, 2)).tolist()
    edges = [("a", int(x), int(y)) for x, y in chain + star + random] + [("b", 1, 2), ("b", 7, 7)]
    df = spark.createDataFrame(edges, "cloud_id string, a bigint, b bigint")
    got = {(r.cloud_id, r.node): r.label for r in components.connected_components(df).collect()}
    parent = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for c, x, y in edges:
        if x != y:
            rx, ry = root((c, x)), root((c, y))
            parent[max(rx, ry)] = min(rx, ry)
    assert got == {v: root(v)[1] for v in list(parent)}


@pytest.mark.parametrize("bad", ["NULL", "'NaN'", "'Infinity'"])
def test_points_need_coordinates(spark, bad):
    df = spark.sql(f"SELECT 'a' cloud_id, id point_id, 1.0D x, IF(id = 3, CAST({bad} AS DOUBLE), 2.0D) y, 0.0D z FROM range(9)")
    for job in (lambda: dbscan.dbscan(df), lambda: neighbours.knn(df, 2)):
        with pytest.raises(Exception, match="without a finite y"):
            job().collect()


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(11)
    xyz = rng.uniform(0, 12, (500, 3)) + [385_000.0, 6_672_000.0, 20.0]
    ids = np.arange(500)
    got = dbscan.dbscan(frame(spark, xyz, ids), 6, 1.5).collect()
    assert {r.point_id: (r.is_core, r.cluster_id) for r in got} == brute_dbscan(xyz, ids, 1.5, 6)
    assert {k[1]: v for k, v in got_knn(frame(spark, xyz, ids), 8, leaf_rows=64).items()} == brute_knn(xyz, ids, 8)


def test_leaves_stay_even_where_a_coordinate_repeats():
    """A wall: 60 percent of the points share the least value of the widest axis."""
    from terraloom.operators.spacetree import SpaceTree

    rng = np.random.default_rng(3)
    xyz = np.column_stack([rng.uniform(0, 1000, 20_000), rng.uniform(0, 50, 20_000), rng.uniform(0, 9, 20_000)])
    xyz[:12_000, 0] = 0.0
    tree = SpaceTree.fit(xyz[::4], 64)
    sizes = np.bincount(tree.leaf(xyz), minlength=64)
    assert sizes.max() <= 2 * sizes.mean() and sizes.min() > 0


def test_neighbours_on_a_wall(spark):
    rng = np.random.default_rng(4)
    xyz = np.column_stack([rng.uniform(0, 1000, 900), rng.uniform(0, 50, 900), rng.uniform(0, 9, 900)])
    xyz[:540, 0] = 0.0
    ids = np.arange(900)
    assert {k[1]: v for k, v in got_knn(frame(spark, xyz, ids), 6, leaf_rows=64).items()} == brute_knn(xyz, ids, 6)


def test_dense_clouds_refine_only_what_is_not_connected(spark, monkeypatch):
    """Full cells throughout, two slabs apart: one round settles each, and the far pairs of cells are never taken apart."""
    rng = np.random.default_rng(11)
    xyz = rng.uniform(0, 1, (20_000, 3)) * [6, 6, 2.4]
    xyz[10_000:, 0] += 8.5
    df, written = frame(spark, xyz, np.arange(20_000)), []

    def noted(table, label="step"):
        written.append(label)
        return kept(table, label)

    kept = dbscan.materialize
    monkeypatch.setattr(dbscan, "materialize", noted)
    got = {r.point_id: (r.is_core, r.cluster_id) for r in dbscan.dbscan(df, 8, 2.0).collect()}
    assert got == {i: (True, 0 if i < 10_000 else 10_000) for i in range(20_000)}
    assert written.count("pairs") <= 3


def test_even_clouds_keep_no_point_pairs(spark, monkeypatch):
    """Thin cells throughout, most points core: no table written has many rows a point, whatever the number of near points."""
    rng = np.random.default_rng(13)
    xyz = np.concatenate([rng.uniform(0, 9, (2200, 3)), rng.uniform(14, 30, (300, 3))])
    ids = rng.permutation(len(xyz))
    df, rows = frame(spark, xyz, ids), {}

    def counted(table, label="step"):
        out = kept(table, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    kept = dbscan.materialize
    monkeypatch.setattr(dbscan, "materialize", counted)
    got = {r.point_id: (r.is_core, r.cluster_id) for r in dbscan.dbscan(df, 10, 2.0).collect()}
    assert got == brute_dbscan(xyz, ids, 2.0, 10)
    assert {True, False} == {core for core, _ in got.values()}
    assert max(rows.values()) <= 8 * len(xyz), rows


def test_stages_join_points_by_shuffle(spark):
    """However small a table of points is, none goes through the driver."""
    rng = np.random.default_rng(12)
    out = jobs.run_point_stages(frame(spark, rng.normal(size=(300, 3)), np.arange(300)), [("features", {"k": 4}), ("clusters", {"min_points": 4, "eps": 0.3})])
    plan = out._jdf.queryExecution().executedPlan().toString()
    on_points = [line for line in plan.splitlines() if "HashJoin" in line and "point_id" in line]
    assert "SortMergeJoin" in plan and not on_points
