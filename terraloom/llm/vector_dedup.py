"""Near-duplicate vectors: lattice hashing, then exact cosine inside the cells.

Equal vectors of one label are one class with a count. Every class stands in one cell of
each table and probes the cells behind near walls (``lattice``). Only cells in which a
class meets another are looked into; their vectors are compared block by block, and what
leaves a block is, per class, a number of links and the root of its links there - never
pairs. A pair that meets in several cells counts only in the first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from ..session import lookup, materialize
from . import blocks, lattice

SIMILARITY = 0.98
_U = np.uint64


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length over 0 the rows and their vectors as doubles; null components are NaN."""
    lengths = np.array([n or 0 for n in pc.list_value_length(column).to_pylist()], np.int64)
    found = []
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        flat = pc.list_flatten(column.take(pa.array(rows))).cast(pa.float64())
        found.append((rows, flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), int(n))))
    return found


def _labelled(hashes: np.ndarray, labels: np.ndarray, table: int, dims: int) -> np.ndarray:
    """Cell names that differ between labels, tables and vector lengths."""
    h = (hashes ^ labels) * _U(0x9E3779B97F4A7C15) + _U(table * 1_000_003 + dims)
    return h ^ (h >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _names(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each row's content."""
    h1, h2 = np.zeros(len(x), np.uint64), np.zeros(len(x), np.uint64)
    for c in np.ascontiguousarray(x).view(np.uint64).T:
        h1 = (h1 ^ c) * _U(0xD6E8FEB86659FD93)
        h1 ^= h1 >> _U(32)
        h2 = (h2 + c) * _U(0x9E3779B97F4A7C15)
        h2 ^= h2 >> _U(29)
    return h1.view(np.int64), h2.view(np.int64)


def _fine(batch: pa.RecordBatch):
    """Rows that can be compared and their vectors, per length."""
    for rows, x in _matrix(batch.column("embedding")):
        fine = np.isfinite(x).all(1) & (x != 0).any(1)
        if fine.any():
            yield rows[fine], x[fine] + 0.0  # no negative zero


def _code(vectors: DataFrame, count: int, tables: int) -> DataFrame:
    """Per row ``vec_id``; where it can be compared, also ``label_hash, h1, h2`` (name of its content), ``cells`` and ``probes``."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            label = blocks.numbers(batch.column("label_hash")).astype(np.int64)
            known = np.zeros(n, bool)
            name = np.zeros((2, n), np.int64)
            cells: list[list[int]] = [[]] * n
            probes: list[list[int]] = [[]] * n
            for rows, x in _fine(batch):
                known[rows] = True
                name[:, rows] = _names(x)
                unit = _unit(x)
                homes, others = [], [[] for _ in rows]
                for t in range(tables):
                    home, row, other = lattice.cells(unit, t, count)
                    own = label[rows].view(np.uint64)
                    homes.append(_labelled(home, own, t, x.shape[1]).view(np.int64))
                    other = _labelled(other, own[row], t, x.shape[1]).view(np.int64)
                    order = np.argsort(row, kind="stable")
                    for k, some in enumerate(np.split(other[order], np.searchsorted(row[order], np.arange(1, len(rows))))):
                        others[k] += some.tolist()
                for k, r in enumerate(rows):
                    cells[r], probes[r] = [int(h[k]) for h in homes], others[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(label), pa.array(name[0], mask=~known), pa.array(name[1], mask=~known),
                 pa.array(cells, pa.list_(pa.int64())), pa.array(probes, pa.list_(pa.int64()))],
                names=["vec_id", "label_hash", "h1", "h2", "cells", "probes"],
            )

    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    told = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.xxhash64(F.col("label").cast("string")).alias("label_hash"),
        F.when(usable, F.col("embedding")).alias("embedding"),
    )
    return told.mapInArrow(run, "vec_id long, label_hash long, h1 long, h2 long, cells array<long>, probes array<long>")


def _contents(vectors: DataFrame) -> DataFrame:
    """``vec_id, h1, h2, vec`` of the rows that can be compared; ``vec`` holds the components' bytes as they are stored."""
    kind = _stored(vectors)

    def run(batches):
        for batch in batches:
            for rows, x in _fine(batch):
                h1, h2 = _names(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(h1), pa.array(h2), pa.array([v.tobytes() for v in x.astype(kind)], pa.binary())],
                    names=["vec_id", "h1", "h2", "vec"],
                )

    known = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    return known.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, h1 long, h2 long, vec binary")


def _stored(vectors: DataFrame) -> str:
    return "<f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"


def _met_before(unit: np.ndarray, ids: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, home: bool, count: int) -> np.ndarray:
    """Whether pairs (ids ascending from i to j) met in an earlier table, or meet in another cell of this one that counts."""
    before = np.zeros(len(i), bool)
    for t in range(table + (not home)):
        cell, row, other = lattice.cells(unit, t, count)
        number = np.unique(np.concatenate([cell, other]), return_inverse=True)[1]
        cell, other = number[: len(cell)].astype(np.int64), number[len(cell) :].astype(np.int64)
        probed = np.unique(row * (number.max() + 1) + other)

        def probes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            want = a * (number.max() + 1) + cell[b]
            return probed[np.minimum(np.searchsorted(probed, want), len(probed) - 1)] == want if len(probed) else np.zeros(len(a), bool)

        if t < table:
            before |= (cell[i] == cell[j]) | probes(i, j) | probes(j, i)
        else:
            before |= probes(j, i)  # here i probes j's cell: if j also probes i's, the cell of the smaller id counts
    return before


def _compare(similarity: float, kind: str, count: int):
    """Links inside one block, as ``vec_id, links, root``."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, weight = blocks.numbers(block.column("vec_id")), blocks.numbers(block.column("n"))
        home, side = blocks.numbers(block.column("home")).astype(bool), blocks.numbers(block.column("side"))
        table, two = int(block.column("table")[0].as_py()), bool(block.column("two")[0].as_py())
        if len(ids) < 2 or not home.any():
            return None
        unit = _unit(np.frombuffer(b"".join(block.column("vec").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64))
        near = unit @ unit.T >= similarity
        near &= home[:, None] | home[None, :]
        near &= ids[:, None] < ids[None, :]
        if two:
            near &= side[:, None] != side[None, :]
        i, j = np.nonzero(near)
        if not len(i):
            return None
        keep = np.zeros(len(i), bool)
        both = home[i] & home[j]
        keep[both] = ~_met_before(unit, ids, i[both], j[both], table, True, count)
        first = ~both & home[i]  # the smaller id is at home here: this cell counts
        keep[first] = ~_met_before(unit, ids, i[first], j[first], table, True, count)
        last = ~both & home[j]
        keep[last] = ~_met_before(unit, ids, i[last], j[last], table, False, count)
        i, j = i[keep], j[keep]
        if not len(i):
            return None
        links = np.bincount(i, weights=weight[j], minlength=len(ids)) + np.bincount(j, weights=weight[i], minlength=len(ids))
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = ids[order][blocks.roots(len(ids), place[i], place[j])[place]]
        own = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[own]), pa.array(links[own].astype(np.int64)), pa.array(root[own])], names=["vec_id", "links", "root"]
        )

    return work


def vector_links(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding, label``).

    Vectors of one label and length are linked when their cosine, in double precision, is at
    least ``similarity``. Null, empty or zero vectors, vectors with null or non-finite
    components, null labels and null ids link with nothing: no links, a component of their own,
    kept. Repeated rows are vectors of their own and link with each other. Links found are
    always real; a pair close to the limit is missed where no table has it in one cell or
    probes it, a share that tests show to be below 1 in 100. Cells are as fine, and tables as many, as the
    rows of the largest label ask for (``lattice.resolution``). An empty table gives no rows.
    """
    # Strangers are those of one label, so the largest label sets how fine cells must be.
    largest = vectors.where("label IS NOT NULL").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    count, tables = lattice.resolution(largest, similarity)
    coded = materialize(_code(vectors, count, tables), "coded")
    content = ["label_hash", "h1", "h2"]
    fine = F.col("h1").isNotNull()
    classes = materialize(
        coded.where(fine).groupBy(*content).agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("cells").alias("cells"), F.first("probes").alias("probes")
        ),
        "classes",
    )
    rep = classes.select(F.col("rep").alias("vec_id"), "n", "h1", "h2", "cells", "probes")
    visits = rep.select("vec_id", "n", "h1", "h2", F.posexplode("cells").alias("at", "cell"), F.lit(1).alias("home")).unionByName(
        rep.select("vec_id", "n", "h1", "h2", F.lit(None).cast("int").alias("at"), F.explode("probes").alias("cell"), F.lit(0).alias("home"))
    )
    cells = visits.groupBy("cell").agg(F.count("*").alias("members"), F.sum("home").alias("_homes"), F.max("at").alias("table"))
    busy = materialize(cells.where("members > 1 AND _homes > 0").drop("_homes"), "cells")
    met = lookup(visits.drop("at"), busy, ["cell"], "members", "inner")
    placed = _contents(vectors).dropDuplicates(["vec_id", "h1", "h2"]).join(met, ["vec_id", "h1", "h2"])
    dealt = blocks.deal(placed, "cell", "members", "vec_id").select("block", "vec_id", "n", "home", "side", "two", "table", "vec")
    found = materialize(
        blocks.by_block(dealt, "vec_id", _compare(similarity, _stored(vectors), count), "vec_id long, links long, root long"), "links"
    )
    edges = found.where("vec_id <> root").select(F.lit("").alias("cloud_id"), F.col("vec_id").alias("a"), F.col("root").alias("b"))
    comps = connected_components(edges).select(F.col("node").alias("rep"), F.col("label").alias("_comp"))
    counts = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("_links"))
    facts = classes.drop("cells", "probes").join(counts, "rep", "left").join(comps, "rep", "left")
    linked = lookup(coded.where(fine).select("vec_id", *content), materialize(facts, "facts"), content, "n", "inner").select(
        "vec_id", (F.coalesce("_links", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"), F.coalesce("_comp", "rep").alias("component_id")
    )
    alone = coded.where(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
