"""Exact k nearest neighbours in 3D, and the shape of each neighbourhood."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import eigen
from ..functions.geometry import coordinate
from ..session import lookup, materialize, shuffled
from .spacetree import SpaceTree

LEAF_ROWS = 4096
#: Parts that all clouds together are cut into on the driver; larger parts are cut again inside tasks.
MOST_PARTS = 32_768
SAMPLE_PER_LEAF = 16
#: Rows of one part that a task sends on to leaves.
ROUTE_ROWS = 500_000
PROBES_PER_GROUP = 50_000
BLOCK = 128
COLUMNS = 8192

NEIGHBOURS = "array<struct<d2:double,id:bigint,x:double,y:double,z:double>>"
_KEY = ["cloud_id", "x", "y", "z"]


def _nearest(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray | None = None):
    """k nearest ``points`` per query by (distance, id): (query row, point row, squared distance).

    Works block by block: compact runs of queries look at runs of points in order of
    box distance and stop once nothing nearer can follow.
    """
    runs = _runs(points)
    lows = np.array([points[r].min(axis=0) for r in runs])
    highs = np.array([points[r].max(axis=0) for r in runs])
    found = []
    for run in _runs(queries):
        q = queries[run]
        gap = np.maximum(np.maximum(lows - q.max(axis=0), q.min(axis=0) - highs), 0.0)
        box_d2 = (gap * gap).sum(axis=1)
        order = np.argsort(box_d2, kind="stable")
        limit = np.full(len(run), np.inf) if bound is None else bound[run].copy()
        row = np.zeros(0, np.int64)
        col, dist = row, np.zeros(0)
        at = 0
        while at < len(order) and box_d2[order[at]] * (1 - 1e-12) <= limit.max():
            # A first small step gives a bound; later steps are as wide as memory allows.
            step = max(COLUMNS // BLOCK, 1) if at else max(2 * k // BLOCK + 1, 2)
            chosen = order[at : at + step]
            chosen = chosen[box_d2[chosen] * (1 - 1e-12) <= limit.max()]
            at += step
            cand = np.concatenate([runs[c] for c in chosen])
            p = points[cand]
            d2 = np.zeros((len(q), len(p)))
            for a in range(q.shape[1]):
                d2 += np.square(q[:, a, None] - p[None, :, a])
            near = limit
            if len(cand) > k:
                near = np.minimum(limit, np.partition(d2, k - 1, axis=1)[:, k - 1])
            r, c = np.nonzero(d2 <= near[:, None])
            row, col, dist = np.concatenate([row, r]), np.concatenate([col, cand[c]]), np.concatenate([dist, d2[r, c]])
            by = np.lexsort((ids[col], dist, row))
            row, col, dist = row[by], col[by], dist[by]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, col, dist, place = (v[place < k] for v in (row, col, dist, place))
            full = place == k - 1
            limit[row[full]] = np.minimum(limit[row[full]], dist[full])
        found.append((run[row], col, dist))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, col, dist = (np.concatenate(part) for part in zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], col[order], dist[order]


def _runs(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers in compact runs of at most ``BLOCK`` points."""
    todo, done = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= BLOCK:
            if len(rows):
                done.append(rows)
            continue
        axis = np.ptp(points[rows], axis=0).argmax()
        half = len(rows) // 2
        split = np.argpartition(points[rows, axis], half)
        todo += [rows[split[:half]], rows[split[half:]]]
    return done


def _lists(n: int, row: np.ndarray, col: np.ndarray, dist: np.ndarray, points: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Hits sorted by query row as one neighbour list per query."""
    found = points[col]
    cells = pa.StructArray.from_arrays(
        [pa.array(dist), pa.array(ids[col]), *(pa.array(found[:, a]) for a in range(3))], ["d2", "id", "x", "y", "z"]
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), cells)


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    xyz = np.stack([table[a].to_numpy() for a in "xyz"], axis=1)
    return xyz, table["point_id"].to_numpy()


def _xyz(pdf: pd.DataFrame) -> np.ndarray:
    return pdf[["x", "y", "z"]].to_numpy("float64")


def _sampled(points: DataFrame, share: float) -> DataFrame:
    """A sample by content, so a rerun task samples the same points."""
    hashed = F.pmod(F.xxhash64("cloud_id", "x", "y", "z", "point_id"), F.lit(2**40))
    return points.where(hashed < math.ceil(min(1.0, share) * 2**40))


def _fit_parts(points: DataFrame, sizes: DataFrame, part_rows: int) -> dict[str, SpaceTree]:
    """Trees of the clouds larger than a part; there are ``MOST_PARTS`` of these at most, and the sample is bounded with them."""
    large = {r[0]: r[1] for r in sizes.where(F.col("count") > part_rows).select("cloud_id", "count").collect()}
    if not large:
        return {}
    big = points.join(F.broadcast(sizes.where(F.col("count") > part_rows).select("cloud_id")), "cloud_id")
    sample = _sampled(big, SAMPLE_PER_LEAF / part_rows).select("cloud_id", "x", "y", "z").toPandas()
    return {
        cloud: SpaceTree.fit(_xyz(rows), math.ceil(large[cloud] / part_rows))
        for cloud, rows in sample.groupby("cloud_id", sort=True)
    }


_POINT = "cloud_id string, point_id bigint, x double, y double, z double"


def _with_part(points: DataFrame, trees) -> DataFrame:
    """``part``, ``leaf`` (the part's only one so far), ``room`` to its nearest wall, and whether the cloud is ``cut`` at all."""

    def assign(batches):
        for pdf in batches:
            part, room, cut = np.zeros(len(pdf), "int32"), np.full(len(pdf), np.inf), np.zeros(len(pdf), bool)
            for cloud, rows in pdf.groupby("cloud_id").indices.items():
                tree = trees.value.get(cloud)
                if tree is not None:
                    xyz = _xyz(pdf.iloc[rows])
                    part[rows], cut[rows] = tree.leaf(xyz), True
                    room[rows] = tree.room(xyz, part[rows])
            yield pdf.assign(part=part, leaf=part.astype("int64") << 32, room=room, cut=cut)

    return points.mapInPandas(assign, f"{_POINT}, seeks boolean, part int, leaf bigint, room double, cut boolean")


def _fit_leaves(parts: DataFrame, leaf_rows: int) -> DataFrame:
    """``cloud_id, part, tree, groups`` of every part of more than ``leaf_rows`` points.

    Each tree is fitted in a task, on the part's share of the sample: a part of 100 million
    points has 400 000 rows there.
    """
    counts = materialize(parts.groupBy("cloud_id", "part").count().where(F.col("count") > leaf_rows), "part-sizes")
    sample = _sampled(parts, SAMPLE_PER_LEAF / leaf_rows).select("cloud_id", "part", "x", "y", "z").join(counts, ["cloud_id", "part"])

    def fit(table: pa.Table) -> pa.Table:
        xyz = np.stack([table[a].to_numpy() for a in "xyz"], axis=1)
        tree = SpaceTree.fit(xyz[np.lexsort(xyz.T)], math.ceil(table["count"][0].as_py() / leaf_rows))
        return table.slice(0, 1).select(["cloud_id", "part", "count"]).append_column("tree", pa.array([pickle.dumps(tree)], pa.binary()))

    fitted = sample.groupBy("cloud_id", "part").applyInArrow(fit, "cloud_id string, part int, count bigint, tree binary")
    return materialize(fitted.withColumn("groups", F.ceil(F.col("count") / ROUTE_ROWS).cast("int")).drop("count"), "leaf-trees")


def _routed(rows: DataFrame, leaves: DataFrame, work: Callable[[pa.Table, SpaceTree], pa.Table], schema: str) -> DataFrame:
    """``work`` over the rows of every part that has a tree of its own, ``ROUTE_ROWS`` or so at a time."""
    key = ["cloud_id", "part", "salt"]
    dealt = rows.join(leaves.select("cloud_id", "part", "groups"), ["cloud_id", "part"])
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("point_id"), F.col("groups")).cast("int")).drop("groups")
    trees = leaves.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select(*key, "tree")

    def route(asked: pa.Table, tree: pa.Table) -> pa.Table:
        return work(asked.drop_columns(["salt"]), pickle.loads(tree["tree"][0].as_py()))

    return dealt.groupBy(*key).cogroup(trees.groupBy(*key)).applyInArrow(route, schema)


def _with_leaf(parts: DataFrame, leaves: DataFrame) -> DataFrame:
    """The points with the leaf of their part's own tree: leaves are named by part and place in it."""
    columns = parts.columns

    def assign(table: pa.Table, tree: SpaceTree) -> pa.Table:
        xyz, _ = _columns(table)
        leaf = tree.leaf(xyz)
        fresh = {
            "leaf": table["leaf"].to_numpy() + leaf, "cut": np.ones(len(leaf), bool), "room": np.minimum(table["room"].to_numpy(), tree.room(xyz, leaf)),
        }
        return pa.table({c: pa.array(fresh[c]) if c in fresh else table[c] for c in columns})

    split = _routed(parts, leaves, assign, f"{_POINT}, seeks boolean, part int, leaf bigint, room double, cut boolean")
    return split.unionByName(parts.join(leaves.select("cloud_id", "part"), ["cloud_id", "part"], "left_anti"))


_ASK = f"{_POINT}, own bigint, bound double, part int"


def _asked_leaves(asks: DataFrame, leaves: DataFrame | None) -> DataFrame:
    """The leaves, but the own one, that the balls of squared radius ``bound`` enter within the asked parts."""
    whole = asks.withColumn("leaf", F.shiftleft(F.col("part").cast("bigint"), 32))
    if leaves is not None:

        def enter(table: pa.Table, tree: SpaceTree) -> pa.Table:
            who, leaf = tree.reach(_columns(table)[0], np.sqrt(table["bound"].to_numpy()) * (1 + 1e-9))
            found = table.take(pa.array(who))
            return found.append_column("leaf", pa.array((found["part"].to_numpy().astype("int64") << 32) + leaf))

        split = _routed(asks, leaves, enter, f"{_ASK}, leaf bigint")
        whole = split.select(*asks.columns, "leaf").unionByName(whole.join(leaves.select("cloud_id", "part"), ["cloud_id", "part"], "left_anti"))
    return whole.where("leaf <> own")


def _asked_parts(rows: DataFrame, trees) -> DataFrame:
    """One row per point and part that its ball of ``radius`` enters."""

    def enter(batches):
        for pdf in batches:
            for cloud, rows in pdf.groupby("cloud_id").indices.items():
                own, tree = pdf.iloc[rows], trees.value.get(cloud)
                who, part = np.arange(len(own)), np.zeros(len(own), "int64")
                if tree is not None:
                    who, part = tree.reach(_xyz(own), own["radius"].to_numpy() * (1 + 1e-9))
                out = own.iloc[who].assign(part=part.astype("int32"))
                yield out.assign(bound=out["radius"] ** 2)[["cloud_id", "point_id", "x", "y", "z", "own", "bound", "part"]]

    return rows.select("cloud_id", "point_id", "x", "y", "z", F.col("leaf").alias("own"), "radius").mapInPandas(enter, _ASK)


def _crowds(points: DataFrame, k: int) -> DataFrame:
    """Locations shared by more than k + 1 points, with their k + 1 smallest ids."""
    crowd = points.groupBy(*_KEY).agg(F.count("*").alias("copies")).where(F.col("copies") > k + 1)
    return materialize(crowd, "crowds")


def neighbour_lists(points: DataFrame, k: int = 20, leaf_rows: int = LEAF_ROWS, most_parts: int = MOST_PARTS) -> DataFrame:
    """Every point with ``nbrs``, its k nearest other points by (distance, id).

    Points are cut into leaves of even size, of ``leaf_rows`` points or twice the list's length: a
    tree on the driver, fitted on a bounded sample, makes up to ``most_parts`` parts, and parts
    larger than a leaf are cut by trees of their own inside tasks. Each leaf is searched in one
    task, and only points whose k-th distance reaches its walls ask other leaves. Points with
    fewer than k others in their leaf ask the leaves within a growing radius, round by round.
    Locations holding many copies are answered from their own k + 1 smallest ids, and lend only
    these to other points, so copies never meet pairwise. The result is exact.
    """
    points = points.select("cloud_id", F.col("point_id").cast("bigint").alias("point_id"),
                           *[coordinate(c).alias(c) for c in ("x", "y", "z")])
    crowd = _crowds(points, k)
    crowded = None
    data = points.withColumn("seeks", F.lit(True))
    if not crowd.isEmpty():
        inside = lookup(points, crowd, _KEY, "copies", "inner")
        order = Window.partitionBy(*_KEY).orderBy("point_id")
        kept = materialize(
            inside.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k + 1).drop("_place"), "kept"
        )
        listed = kept.groupBy(*_KEY).agg(
            F.max("copies").alias("copies"),
            F.array_sort(F.collect_list(F.struct(F.lit(0.0).alias("d2"), F.col("point_id").alias("id"), "x", "y", "z"))).alias("own"),
        )
        answered = lookup(points, materialize(listed, "listed"), _KEY, "copies", "inner")
        crowded = answered.withColumn(
            "nbrs", F.slice(F.filter("own", lambda v: v["id"] != F.col("point_id")), 1, k).cast(NEIGHBOURS)
        ).select("cloud_id", "point_id", "x", "y", "z", "nbrs")
        alone = lookup(points, crowd, _KEY, "copies", "left").where(F.col("copies").isNull())
        data = alone.select(*points.columns, F.lit(True).alias("seeks")).unionByName(
            kept.select(*points.columns, F.lit(False).alias("seeks"))
        )
    searched = data.drop("seeks")
    extent = F.sqrt(sum((F.pow(F.max(a) - F.min(a), F.lit(2.0)) for a in ("x", "y", "z")), F.lit(0.0)))
    sizes = materialize(searched.groupBy("cloud_id").agg(F.count("*").alias("count"), extent.alias("extent")), "sizes")
    leaf_rows = max(leaf_rows, 2 * (k + 1))
    part_rows = max(leaf_rows, math.ceil((sizes.agg(F.sum("count")).first()[0] or 0) / most_parts))
    trees = points.sparkSession.sparkContext.broadcast(_fit_parts(searched, sizes, part_rows))
    two_levels = part_rows > leaf_rows
    if not trees.value and not two_levels:
        whole = data.withColumns({"part": F.lit(0), "leaf": F.lit(0).cast("bigint"), "room": F.lit(math.inf), "cut": F.lit(False)})
        return _union(_search(whole, k, trees, False).select(*points.columns, "nbrs"), crowded)

    placed, leaves = materialize(_with_part(data, trees), "placed"), None
    if two_levels:
        leaves = _fit_leaves(placed, leaf_rows)
        placed = materialize(_with_leaf(placed, leaves), "placed")
    local = materialize(_search(placed, k, trees, two_levels), "local")
    short = F.col("cut") & (F.size("nbrs") < k)
    done = local.where(~short & (F.size("probes") == 0)).select(*points.columns, "nbrs")
    border = local.where(~short & (F.size("probes") > 0))
    asks = border.select(
        *points.columns, F.col("leaf").alias("own"), F.element_at("nbrs", -1)["d2"].alias("bound"), F.explode("probes").alias("part")
    )
    found = done.unionByName(_merged(border, _probe(_asked_leaves(asks, leaves), placed, k), k).select(*points.columns, "nbrs"))
    for more in _widening(local.where(short).join(sizes, "cloud_id"), placed, trees, leaves, k):
        found = found.unionByName(more.select(*points.columns, "nbrs"))
    return _union(found, crowded)


def _merged(asking: DataFrame, far: DataFrame, k: int) -> DataFrame:
    """The askers with the k nearest of their own and the lists found elsewhere."""
    key = ["cloud_id", "point_id"]
    lists = asking.select(*key, "nbrs").unionByName(far).groupBy(*key).agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("nbrs"))), 1, k).alias("nbrs")
    )
    return asking.drop("nbrs").join(shuffled(lists), key)


def _widening(short: DataFrame, placed: DataFrame, trees, leaves: DataFrame | None, k: int) -> Iterator[DataFrame]:
    """Answers of points whose leaf holds too few others, by balls that grow until they hold k points or the whole cloud."""
    guess = F.col("extent") * F.pow(F.lit(k) / F.col("count"), F.lit(1 / 3)) / 2
    left = materialize(short.withColumns({"radius": guess, "own": F.col("nbrs")}).drop("probes"), "short")
    while not left.isEmpty():
        asks = materialize(_asked_leaves(_asked_parts(left, trees), leaves), "asks")
        tried = materialize(_merged(left, _probe(asks, placed, k), k), "tried")
        reached = (F.size("nbrs") >= k) & (F.element_at("nbrs", -1)["d2"] <= F.col("radius") * F.col("radius"))
        settled = F.coalesce(reached, F.lit(False)) | (F.col("radius") >= F.col("extent"))
        yield tried.where(settled)
        # Wider balls enter the same leaves again, so each round adds to the own leaf's list alone.
        left = tried.where(~settled).withColumns({"radius": F.col("radius") * 4, "nbrs": F.col("own")})


def _union(found: DataFrame, crowded: DataFrame | None) -> DataFrame:
    return found if crowded is None else found.unionByName(crowded)


def _search(placed: DataFrame, k: int, trees, two_levels: bool) -> DataFrame:
    """Search inside each leaf; ``probes`` names the parts a point with k neighbours must still ask."""

    def search(table: pa.Table) -> pa.Table:
        points, ids = _columns(table)
        seek = np.flatnonzero(table["seeks"].to_numpy())
        row, col, dist = _nearest(points[seek], points, ids, k + 1)
        other = col != seek[row]
        row, col, dist = row[other], col[other], dist[other]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col, dist, place = (v[place < k] for v in (row, col, dist, place))
        reach = np.full(len(seek), -1.0)
        last = place == k - 1
        reach[row[last]] = np.sqrt(dist[last]) * (1 + 1e-9)
        out_of = np.flatnonzero(reach >= table["room"].to_numpy()[seek])
        who, part = out_of, np.zeros(len(out_of), np.int64)
        tree = trees.value.get(table["cloud_id"][0].as_py())
        if tree is not None:
            who, part = tree.reach(points[seek[out_of]], reach[out_of])
            away = np.ones(len(part), bool) if two_levels else part != table["part"][0].as_py()
            who, part = out_of[who[away]], part[away]
            order = np.argsort(who, kind="stable")
            who, part = who[order], part[order]
        probes = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(who, np.arange(len(seek) + 1)), pa.int32()), pa.array(part, pa.int32())
        )
        out = table.select(["cloud_id", "point_id", "x", "y", "z", "leaf", "cut"]).take(pa.array(seek))
        return out.append_column("nbrs", _lists(len(seek), row, col, dist, points, ids)).append_column("probes", probes)

    return placed.groupBy("cloud_id", "leaf").applyInArrow(
        search, f"{_POINT}, leaf bigint, cut boolean, nbrs {NEIGHBOURS}, probes array<int>"
    )


def _probe(probes: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """Answer points that reach into a leaf from outside.

    A leaf asked by very many points is copied to several groups, so no group grows
    with the number of its askers.
    """
    asked = materialize(
        probes.groupBy("cloud_id", "leaf").agg(F.ceil(F.count("*") / F.lit(PROBES_PER_GROUP)).cast("int").alias("groups")),
        "asked",
    )
    salted = probes.join(asked, ["cloud_id", "leaf"]).withColumn(
        "salt", F.pmod(F.xxhash64("point_id"), F.col("groups")).cast("int")
    )
    leaves = placed.join(asked, ["cloud_id", "leaf"]).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    )

    def answer(askers: pa.Table, table: pa.Table) -> pa.Table:
        points, ids = _columns(table)
        row = col = np.zeros(0, np.int64)
        dist = np.zeros(0)
        if askers.num_rows and len(points):
            bound = askers["bound"].to_numpy().astype("float64")
            bound[np.isnan(bound)] = np.inf
            row, col, dist = _nearest(_columns(askers)[0], points, ids, k, bound)
        lists = _lists(askers.num_rows, row, col, dist, points, ids)
        return askers.select(["cloud_id", "point_id"]).append_column("nbrs", lists)

    return (
        salted.drop("groups")
        .groupBy("cloud_id", "leaf", "salt")
        .cogroup(leaves.select("cloud_id", "leaf", "salt", "point_id", "x", "y", "z").groupBy("cloud_id", "leaf", "salt"))
        .applyInArrow(answer, f"cloud_id string, point_id bigint, nbrs {NEIGHBOURS}")
    )


def knn(points: DataFrame, k: int = 20, leaf_rows: int = LEAF_ROWS, most_parts: int = MOST_PARTS) -> DataFrame:
    """One row per point and neighbour: ``cloud_id, point_id, rank, neighbour_id, d2``."""
    lists = neighbour_lists(points, k, leaf_rows, most_parts)
    return lists.select("cloud_id", "point_id", F.posexplode("nbrs").alias("at", "n")).select(
        "cloud_id", "point_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("neighbour_id"), F.col("n.d2").alias("d2")
    )


_SHAPE = (
    "cloud_id string, point_id bigint, x double, y double, z double, c_xx double, c_xy double, c_xz double, c_yy double,"
    " c_yz double, c_zz double, l1 double, l2 double, l3 double, nx double, ny double, nz double, neighbours int,"
    " height_range double, radius double"
)


def neighbourhood_shapes(lists: DataFrame, include_self: bool = False) -> DataFrame:
    """Population covariance, eigenvalues, normal and extent of each point's neighbourhood.

    No shuffle: lists stream through in Arrow batches and leave as a few numbers. Batched
    eigen decomposition there is several times faster than the same algebra as columns,
    whose generated code grows beyond what the JVM compiles.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch["nbrs"], batch.num_rows
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            row, cells = np.repeat(np.arange(n), sizes), lists.flatten()
            d2, _, *hood = (cells.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            hood = np.stack(hood, axis=1)
            radius = np.zeros(n)
            np.maximum.at(radius, row, np.sqrt(d2))
            high, low = np.full(n, -np.inf), np.full(n, np.inf)
            np.maximum.at(high, row, hood[:, 2])
            np.minimum.at(low, row, hood[:, 2])
            if include_self:
                own = np.stack([batch[a].to_numpy() for a in "xyz"], axis=1)
                row, hood = np.concatenate([row, np.arange(n)]), np.concatenate([hood, own])
            cov = eigen.covariances(row, hood, n)
            values, normal = eigen.symmetric_eigen(cov)
            out = [batch[c] for c in ("cloud_id", "point_id", "x", "y", "z")]
            out += [pa.array(cov[:, i, j]) for i, j in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))]
            out += [pa.array(values[:, i]) for i in range(3)] + [pa.array(normal[:, i]) for i in range(3)]
            out += [pa.array(sizes, pa.int32()), pa.array(np.where(sizes > 0, high - low, 0.0)), pa.array(radius)]
            yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in _SHAPE.split(",")])

    return lists.select("cloud_id", "point_id", "x", "y", "z", "nbrs").mapInArrow(measure, _SHAPE)


def normals(points: DataFrame, k: int = 8, include_self: bool = False) -> DataFrame:
    """Unit normal, turned upwards, and curvature per point."""
    return neighbourhood_shapes(neighbour_lists(points, k), include_self).select(
        "cloud_id", "point_id", "x", "y", "z", "nx", "ny", "nz", eigen.shape_features()["curvature"].alias("curvature")
    )


def eigen_features(points: DataFrame, k: int = 20, include_self: bool = False) -> DataFrame:
    """Eigenvalues, normal, shape features, and height and density measures per point."""
    volume = F.pow("radius", F.lit(3.0)) * (4 * math.pi / 3)
    return neighbourhood_shapes(neighbour_lists(points, k), include_self).select(
        "cloud_id", "point_id", "x", "y", "z", "l1", "l2", "l3", "nx", "ny", "nz",
        *[v.alias(name) for name, v in eigen.shape_features().items()],
        (1 - F.abs("nz")).alias("verticality"),
        "height_range",
        F.sqrt("c_zz").alias("height_std"),
        F.when(volume > 0, F.col("neighbours") / F.nullif(volume, F.lit(0.0))).otherwise(F.lit(0.0)).alias("density"),
    )
