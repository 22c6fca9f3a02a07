"""Connected components of a large edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import lookup, materialize, shuffled

#: Edges that one task takes; a graph shrinks on the cluster until no more are left.
TASK_EDGES = 1_000_000


def connected_components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """Smallest node of each node's component: ``cloud_id, node, label``; only nodes with an edge. Nodes are whole numbers.

    Every round lets each node follow its smallest neighbour, shortens the chains by
    pointer jumping, and rewrites the edges between the groups formed; the nodes left
    at least halve, so the rounds grow with the logarithm of the input. The last
    ``task_edges`` edges, or fewer, are settled by one task. Edges never
    leave the cluster, and hubs are joined by ``lookup``, which splits them.
    """
    e = materialize(
        edges.select("cloud_id", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    maps = []
    while e.count() > task_edges:
        parents = _hook(e)
        maps.append(parents)
        e = materialize(_contract(e, parents), "edges")
    last = materialize(_settled(e), "settled")
    if not maps:
        return last.select("cloud_id", "node", F.col("parent").alias("label"))
    labels = maps[0].select("cloud_id", "node", F.col("parent").alias("label"))
    for later in [*maps[1:], last]:
        step = later.select("cloud_id", F.col("node").alias("label"), F.col("parent").alias("_next"))
        weights = labels.groupBy("cloud_id", "label").agg(F.count("*").alias("_members"))
        step = materialize(step.join(shuffled(weights), ["cloud_id", "label"]), "relabel")
        labels = lookup(labels, step, ["cloud_id", "label"], "_members").select(
            "cloud_id", "node", F.coalesce("_next", "label").alias("label")
        )
    return labels


def _settled(edges: DataFrame) -> DataFrame:
    """Each node's smallest reachable node, ``cloud_id, node, parent``, of a number of edges that one task takes."""

    def settle(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        clouds = table["cloud_id"].combine_chunks().dictionary_encode()
        cloud = np.tile(clouds.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype("int64"), 2)
        node = np.concatenate([table["a"].to_numpy(), table["b"].to_numpy()])
        order = np.lexsort((node, cloud))
        fresh = np.append(True, (np.diff(node[order]) != 0) | (np.diff(cloud[order]) != 0))
        place = np.empty(len(node), np.int64)
        place[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        parent = node[first][_smallest(len(first), place[: table.num_rows], place[table.num_rows :])]
        names = pa.array(cloud[first], mask=cloud[first] < 0)
        yield pa.RecordBatch.from_arrays([clouds.dictionary.take(names), pa.array(node[first]), pa.array(parent)], ["cloud_id", "node", "parent"])

    schema = edges.select("cloud_id", F.col("a").alias("node"), F.col("b").alias("parent")).schema
    return edges.repartition(1).mapInArrow(settle, schema)


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component under the links a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped


def _hook(edges: DataFrame) -> DataFrame:
    """Each node's group root after following smallest neighbours to the end, with its degree."""
    ends = edges.select("cloud_id", F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select("cloud_id", F.col("b").alias("node"), F.col("a").alias("other"))
    )
    parents = materialize(
        ends.groupBy("cloud_id", "node").agg(
            F.least(F.col("node"), F.min("other")).alias("parent"), F.count("*").alias("degree")
        ),
        "parents",
    )
    while True:
        weights = parents.groupBy("cloud_id", "parent").agg(F.count("*").alias("_children"))
        above = parents.select("cloud_id", F.col("node").alias("parent"), F.col("parent").alias("_above"))
        jump = materialize(
            weights.join(shuffled(above), ["cloud_id", "parent"]).where(F.col("_above") != F.col("parent")), "jump"
        )
        if jump.isEmpty():
            return parents
        parents = materialize(
            lookup(parents, jump, ["cloud_id", "parent"], "_children").select(
                "cloud_id", "node", F.coalesce("_above", "parent").alias("parent"), "degree"
            ),
            "parents",
        )


def _contract(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the roots, each once; edges inside a group vanish."""
    out = edges
    for end in ("a", "b"):
        roots = parents.select("cloud_id", F.col("node").alias(end), F.col("parent").alias("_root"), "degree")
        out = lookup(out, roots, ["cloud_id", end], "degree", "inner").drop(end, "degree").withColumnRenamed("_root", end)
    return (
        out.where("a <> b")
        .select("cloud_id", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
