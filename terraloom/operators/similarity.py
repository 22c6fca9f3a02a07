"""Exact cosine top-k over patch vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import materialize
from ..sources.tables import PATCH_BOUNDS, require_columns
from . import spatial
from .prefilter import may_match

# Query vectors held by one task, and scores it computes at once, in bytes; a few arrays of that size come with them.
QUERY_BYTES = 64 << 20
SCORE_BYTES = 16 << 20
# Matches that one task holds, with their facts, and those it gives out at once.
HELD_ROWS = 400_000
OUT_ROWS = 10_000
# Scores closer than this are the same score; it hides summation order from the ranks.
SCORE_PLACES = 9


def non_null_embedding(patches: DataFrame) -> DataFrame:
    return patches.where(F.col("embedding").isNotNull())


def _matrix(column: pa.Array) -> np.ndarray:
    """Equal-length list column as unit rows; zero rows stay zero."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    rows = values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    norm[norm == 0] = 1.0
    return rows / norm


class _Best:
    """The k best patches seen so far for each query of a fixed set, with their facts.

    Equal scores rank by ``order``, columns of the facts. A batch of patches meets a few queries at
    a time and leaves k or so candidates a query, so memory does not grow with queries times patches or with ties.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, order: list[str], key: str | None):
        self.ids, self.vectors, self.k, self.key = ids, vectors, k, key
        self.order = [(name, "ascending") for name in order]
        self.known = pa.array(ids, pa.string())
        self.scores = np.full((len(ids), k), -np.inf)
        self.rows = np.zeros((len(ids), k), np.int64)  # places in ``facts``
        self.facts: pa.Table | None = None

    def add(self, facts: pa.RecordBatch, vectors: np.ndarray) -> None:
        finite = np.flatnonzero(np.isfinite(vectors).all(axis=1))
        if not len(self.ids) or not len(finite):
            return
        # In the order of ties, so that the first of equal scores is the one to keep.
        finite = finite[self._sorted(facts.take(pa.array(finite)))]
        facts, vectors = facts.take(pa.array(finite)), vectors[finite]
        own = np.full(len(vectors), -1)
        if self.key:
            own = pc.fill_null(pc.index_in(facts.column(self.key), value_set=self.known), -1).to_numpy(zero_copy_only=False)
        step = max(SCORE_BYTES // (8 * len(vectors)), 1)
        found = [self._candidates(at, vectors, own, step) for at in range(0, len(self.ids), step)]
        row, col, score = (np.concatenate(part) for part in zip(*found))
        if len(row):
            self._merge(facts, row, col, score)

    def _sorted(self, facts) -> np.ndarray:
        return pc.sort_indices(facts, sort_keys=self.order, null_placement="at_start").to_numpy()

    def _candidates(self, at: int, vectors: np.ndarray, own: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, patch, score) of a run of queries: all that can be among the k best, no more than 2k a query on average."""
        scores = self.vectors[at : at + step] @ vectors.T
        hit = np.flatnonzero((own >= at) & (own < at + len(scores)))
        scores[own[hit] - at, hit] = -np.inf
        edge, slack = self.scores[at : at + step, -1], 10.0**-SCORE_PLACES
        near = scores >= (edge - slack)[:, None]
        if len(vectors) > self.k and np.count_nonzero(near) > 2 * self.k * len(scores):
            kth = np.partition(scores, len(vectors) - self.k, axis=1)[:, -self.k]
            edge = np.maximum(edge, np.round(kth, SCORE_PLACES) + 0.0)
            near = scores >= (edge - slack)[:, None]
        row, col = np.divmod(np.flatnonzero(near), len(vectors))
        score = np.round(scores[row, col], SCORE_PLACES) + 0.0
        above = score > edge[row]
        level = np.flatnonzero((score == edge[row]) & (score > -np.inf))
        # Of those level with the k-th score only the first k of a query can follow.
        level = level[np.arange(len(level)) - np.searchsorted(row[level], row[level]) < self.k]
        above[level] = True
        return row[above] + at, col[above], score[above]

    def _merge(self, facts: pa.RecordBatch, row: np.ndarray, col: np.ndarray, score: np.ndarray) -> None:
        front, place = np.unique(col, return_inverse=True)
        new = pa.Table.from_batches([facts.take(pa.array(front))])
        before = self.facts.num_rows if self.facts else 0
        table = pa.concat_tables([self.facts, new]) if self.facts else new
        old_row, old_col = np.nonzero(self.scores > -np.inf)
        row = np.concatenate([old_row, row])
        score = np.concatenate([self.scores[old_row, old_col], score])
        fact = np.concatenate([self.rows[old_row, old_col], before + place])
        rank = np.empty(table.num_rows, np.int64)
        rank[self._sorted(table)] = np.arange(table.num_rows)
        order = np.lexsort((rank[fact], -score, row))
        row, score, fact = row[order], score[order], fact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        row, score, fact, place = row[keep], score[keep], fact[keep], place[keep]
        live, fact = np.unique(fact, return_inverse=True)
        self.facts = table.take(pa.array(live)).combine_chunks()
        self.scores[:] = -np.inf
        self.scores[row, place], self.rows[row, place] = score, fact

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.facts is None:
            return
        row, col = np.nonzero(self.scores > -np.inf)
        for at in range(0, len(row), OUT_ROWS):
            r, c = row[at : at + OUT_ROWS], col[at : at + OUT_ROWS]
            out = self.facts.take(pa.array(self.rows[r, c]))
            out = out.append_column("query_id", pa.array(self.ids[r], pa.string())).append_column("score", pa.array(self.scores[r, c]))
            yield from out.combine_chunks().to_batches()


def top_k(patches: DataFrame, queries: DataFrame, k: int = 5, exclude_self: bool = False, query_bytes: int = QUERY_BYTES,
          carry: tuple[str, ...] = (), key: str = "patch_id") -> DataFrame:
    """The k best patches per query by cosine, as ``query_id, patch_id, score, rank`` and the columns to ``carry``.

    ``queries`` has ``query_id`` and ``vector``; a repeated query gets its matches as often
    as it is asked, and an id with two vectors fails. Equal scores rank by patch id. With
    ``exclude_self`` a query is never matched to the patch that has its id in ``key``.
    Queries are broadcast in blocks of ``query_bytes``, and of ``HELD_ROWS`` / k, and patches stay where they are: one
    scan per block. Each task keeps k rows per query, with the facts of the patches.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    order_by = list(dict.fromkeys(["patch_id", key]))
    names = list(dict.fromkeys([*order_by, *carry]))
    facts = non_null_embedding(patches).select(*names, "embedding")
    asked = queries.where(F.col("vector").isNotNull()).select(F.col("query_id").cast("string").alias("query_id"), "vector")
    one = F.when(F.min("vector") == F.max("vector"), F.min("vector")).otherwise(
        F.raise_error(F.concat(F.lit("two vectors for query "), F.coalesce("query_id", F.lit("NULL")))).cast(asked.schema["vector"].dataType)
    )
    seeds = materialize(asked.groupBy("query_id").agg(one.alias("vector"), F.count("*").alias("_times")), "queries")
    size, asking = seeds.agg(F.sum(F.size("vector") * 8), F.count("*")).first()
    blocks = max(math.ceil((size or 0) / query_bytes), math.ceil(asking * k / HELD_ROWS), 1)
    schema = facts.drop("embedding").schema.add("query_id", "string").add("score", "double")
    partial = None
    for block in range(blocks):
        mine = seeds.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).select("query_id", "vector").toArrow()
        found = facts.mapInArrow(_scanner(patches, mine, k, order_by, key if exclude_self else None), schema)
        partial = found if partial is None else partial.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), *order_by)
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    often = seeds.where("_times > 1").select(F.col("query_id").alias("_again"), "_times")
    out = ranked.join(often, F.col("query_id").eqNullSafe(F.col("_again")), "left")
    out = out.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("_times", F.lit(1).cast("bigint")))))
    return out.select("query_id", "patch_id", "score", "rank", *[c for c in names if c != "patch_id" and c in carry])


def _scanner(patches: DataFrame, queries: pa.Table, k: int, order: list[str], key: str | None):
    ids = np.array(queries["query_id"].to_pylist(), object)
    vectors = _matrix(queries["vector"].combine_chunks()) if len(ids) else np.zeros((0, 0))
    shared = patches.sparkSession.sparkContext.broadcast((ids, vectors))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*shared.value, k, order, key)
        for batch in batches:
            best.add(batch.drop_columns(["embedding"]), _matrix(batch["embedding"]))
        yield from best.batches()

    return scan


def patch_key(patches: DataFrame, name: str = "patch_id") -> Column:
    """What tells patches (or tiles) of equally named rasters apart: the id, and the raster's where the table has it."""
    if "raster_id" not in patches.columns:
        return F.col(name).cast("string")
    return F.concat_ws("\x1f", F.col(name).cast("string"), F.col("raster_id").cast("string"))


def path_queries(images: DataFrame, embed: Column, path: str = "query_path") -> DataFrame:
    """Query vectors of image rows; ``embed`` is the user's vectorised model call."""
    return images.where(F.col(path).isNotNull() & (F.col(path) != "")).select(
        F.col(path).alias("query_id"), embed.alias("vector")
    )


def coords_to_vectors(coords: DataFrame, patches: DataFrame, tiles: DataFrame | None = None,
                      strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Turn map points into query vectors; returns (vectors, points without a vector).

    Vectors come once per distinct coordinate, with the number of ``copies`` of it.
    Patch bounds decide where the table has them; otherwise the tile holding the
    point, and that tile's first patch. ``strict`` fails on points left over.
    """
    patches = non_null_embedding(patches).withColumn("patch_key", patch_key(patches)).withColumn("vector", F.col("embedding"))
    facts = ("patch_id", "vector")
    spots = coords.groupBy("query_x", "query_y").agg(F.count("*").alias("copies"))
    if set(PATCH_BOUNDS) <= set(patches.columns):
        hit = spatial.first_match(spots, patches, "patch_key", PATCH_BOUNDS, carry=facts)
    else:
        if tiles is None:
            raise ValueError("tiles are required to look up coordinates without patch bounds")
        require_columns(tiles, {"tile_id", "min_x", "min_y", "max_x", "max_y"}, "tile index")
        both = {"raster_id"} <= set(tiles.columns) & set(patches.columns)
        tile_key = patch_key(tiles, "tile_id") if both else F.col("tile_id").cast("string")
        tile = spatial.first_match(spots, tiles.withColumn("tile_key", tile_key), "tile_key", ("min_x", "min_y", "max_x", "max_y"))
        tile = materialize(tile, "tiles-hit")
        own = patch_key(patches, "tile_id") if both else F.col("tile_id").cast("string")
        # Only patches of the tiles hit are grouped.
        inside = may_match(patches.select(own.alias("tile_key"), "patch_key", *facts), tile, ["tile_key"])
        first = inside.groupBy("tile_key").agg(F.min(F.struct("patch_key", *facts)).alias("patch"))
        hit = tile.join(first, "tile_key").select("query_x", "query_y", "patch.*")
    hit = materialize(hit, "patches-hit")
    vectors = hit.join(spots, ["query_x", "query_y"]).select("query_x", "query_y", "copies", "patch_key", *facts)
    missed = spatial.unmatched(coords, hit, ["query_x", "query_y"])
    if strict:
        lost = missed.first()
        if lost:
            raise ValueError(f"no patch or tile with an embedding contains point x={lost['query_x']}, y={lost['query_y']}")
    return vectors, missed


def match_columns(patches: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """``patches`` with the facts that a match shows, and their names, to be carried through the search."""
    have = set(PATCH_BOUNDS) <= set(patches.columns)
    facts = {
        "match_tile_id": F.col("tile_id"),
        "match_tile_path": F.col("tile_path") if "tile_path" in patches.columns else F.lit(None).cast("string"),
        "match_tile_key": patch_key(patches, "tile_id"),
    }
    for bound, own in zip(("min_x", "min_y", "max_x", "max_y"), PATCH_BOUNDS):
        facts[f"match_{bound}"] = (F.col(own) if have else F.lit(None)).cast("double")
    return patches.withColumns({**facts, "patch_key": patch_key(patches)}), tuple(facts)


def match_rows(hits: DataFrame, patches: DataFrame, tiles: DataFrame | None = None) -> DataFrame:
    """Matches of hits that carry ``match_columns``; tile bounds stand in where patches have none."""
    names = [f"match_{b}" for b in ("min_x", "min_y", "max_x", "max_y")]
    out = hits
    if tiles is not None and not set(PATCH_BOUNDS) <= set(patches.columns):
        both = {"raster_id"} <= set(tiles.columns) & set(patches.columns)
        key = patch_key(tiles, "tile_id") if both else F.col("tile_id").cast("string")
        mine = "match_tile_key" if both else "match_tile_id"
        path = "tile_path" if "tile_path" in tiles.columns else "tile_id"
        boxes = tiles.groupBy(key.alias(mine)).agg(*[F.min_by(n.removeprefix("match_"), path).cast("double").alias(n) for n in names])
        out = out.drop(*names).join(boxes, mine, "left")
    return out.select("query_id", "match_tile_id", "match_tile_path", F.col("patch_id").alias("match_patch_id"), "score", "rank", *names)


def matches(patches: DataFrame, queries: DataFrame, k: int = 5, tiles: DataFrame | None = None, exclude_self: bool = False) -> DataFrame:
    """Top-k search with the facts of each match; own patches are told by ``patch_key``."""
    ready, names = match_columns(patches)
    return match_rows(top_k(ready, queries, k, exclude_self, carry=names, key="patch_key"), patches, tiles)


def union_results(path_matches: DataFrame | None, coord_matches: DataFrame | None) -> DataFrame:
    """Image matches and coordinate matches in one table; the other kind's query columns are NULL."""
    parts = []
    if path_matches is not None:
        parts.append(
            path_matches.withColumnRenamed("query_id", "query_path").withColumns(
                {"query_x": F.lit(None).cast("double"), "query_y": F.lit(None).cast("double")}
            )
        )
    if coord_matches is not None:
        parts.append(coord_matches.drop("query_id").withColumn("query_path", F.lit(None).cast("string")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select(
        "query_path", "query_x", "query_y", "match_tile_id", "match_tile_path", "match_patch_id", "score", "rank",
        "match_min_x", "match_min_y", "match_max_x", "match_max_y",
    )


def drawable(matches: DataFrame) -> DataFrame:
    """Matches with four finite bounds, with their rank class and label."""
    names = ("match_min_x", "match_min_y", "match_max_x", "match_max_y")
    keep = F.lit(True)
    for name in names:
        keep = keep & text.finite(F.col(name))

    def part(key: str, value: Column, shown: Column) -> Column:
        return F.when(shown, F.concat(F.lit(key + "="), value))

    tile, patch = F.col("match_tile_id"), F.col("match_patch_id")
    label = F.concat_ws(
        " · ",
        part("patch_id", patch, patch.isNotNull() & (patch != "")),
        part("tile_id", tile, tile.isNotNull() & (tile != "")),
        part("score", text.fixed(F.col("score"), 4), text.finite(F.col("score"))),
        part("rank", F.col("rank").cast("string"), F.col("rank").isNotNull()),
    )
    color = F.when(F.col("rank") == 1, F.lit("first")).when(F.col("rank") == 2, F.lit("second")).otherwise(F.lit("other"))
    return matches.where(keep).withColumns({"rank_class": color, "label": label})
