"""Similarity join of texts on word n-gram sets: MinHash bands find candidates, full sets decide.

Texts with the same set of n-grams are one class. A class's MinHash values are cut into
bands; classes that share a band are candidates, and each such pair is compared once on the
full sets, in a block that holds both: of the group of classes that bands connect, or, where
that takes fewer rows, of the first band they share. What leaves a block is, per class, a
number of links and the root of its links there - never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.prefilter import may_match
from ..session import lookup, materialize
from . import blocks, textops
from .shield import shielded

N = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9999
#: MinHash values a text may cost.
MOST_HASHES = 128
#: Text bytes that count as one member when groups are dealt into blocks.
MEMBER_BYTES = 16_384
#: A row's text is told by its id and two hashes of the text.
KEY = ["_id", "_t1", "_t2"]
_U = np.uint64
_V = np.uint32


def bands_for(similarity: float = SIMILARITY, recall: float = TARGET_RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows, so the fewest false candidates, whose bands still reach the recall at the similarity."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)) if similarity < 1 else 1, 1)
    for rows in range(2, most + 1):
        chance = similarity**rows
        bands = math.ceil(math.log(1 - recall) / math.log(1 - chance)) if chance < 1 else 1
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def ngram_sets(part: textops.Slice, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text of a slice, ordered by text and hash, and where each text begins.

    A text of fewer words, but not none, has one n-gram: all its words.
    """
    _, _, docs, hashes = textops.words(part)
    grams, at = textops.ngrams(hashes, docs, n)
    owners, values = [docs[at]], [grams]
    count = np.bincount(docs, minlength=part.n)
    for k in range(1, n):
        short = (count == k)[docs]
        if short.any():
            grams, at = textops.ngrams(hashes[short], docs[short], k)
            owners.append(docs[short][at])
            values.append(grams)
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if len(owner):
        first = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
        owner, value = owner[first], value[first]
    return value, np.searchsorted(owner, np.arange(part.n + 1))


def _constants(hashes: int) -> np.ndarray:
    return np.random.default_rng(41).integers(1, 1 << 32, (3, hashes), dtype=np.uint32) | _V(1)


def _signatures(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit name per text and band; all texts given have n-grams."""
    low = (values >> _U(32)).astype(_V)
    flip, by, then = _constants(bands * rows)
    out = np.empty((len(starts), bands), np.uint64)
    for b in range(bands):
        name = np.full(len(starts), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            v = (low ^ flip[k]) * by[k]
            v ^= v >> _V(16)
            v *= then[k]
            name = textops.mix(name * _U(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, starts))
        out[:, b] = name
    return out.view(np.int64)


def _key() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.lit(1), "text").alias("_t1"), F.xxhash64(F.lit(2), "text").alias("_t2")]


def _sign(documents: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per row its ``KEY``, ``size`` (bytes) and, for texts with words, ``h1, h2`` (name of the n-gram set) and ``bands``."""

    def run(batches):
        for batch in batches:
            for part in textops.slices(batch.column("text")):
                values, edges = ngram_sets(part, n)
                some = np.flatnonzero(np.diff(edges))
                names = np.zeros((2, part.n), np.int64)
                found = np.zeros((0, bands), np.int64)
                if len(some):
                    starts = edges[some]
                    names[0, some] = np.add.reduceat(textops.mix(values), starts).view(np.int64)
                    names[1, some] = np.add.reduceat(textops.mix(values * _U(0xD6E8FEB86659FD93)), starts).view(np.int64)
                    found = _signatures(values, starts, bands, rows)
                none = np.diff(edges) == 0
                offsets = np.concatenate(([0], np.cumsum(np.where(none, 0, bands)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(part.first, part.n) for c in KEY), pa.array(np.diff(part.offsets)), pa.array(names[0], mask=none),
                     pa.array(names[1], mask=none), pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))],
                    names=[*KEY, "size", "h1", "h2", "bands"],
                )

    rows_in = documents.select(*_key(), "text")
    return rows_in.mapInArrow(run, "_id long, _t1 long, _t2 long, size long, h1 long, h2 long, bands array<long>")


def _name(values: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two 64-bit names of a set of n-grams."""
    return textops.mix(values).sum(dtype=np.uint64), textops.mix(values * _U(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)


def _shared(values: list[np.ndarray]) -> np.ndarray:
    """How many n-grams every two texts share."""
    m = len(values)
    owner = np.repeat(np.arange(m), [len(v) for v in values])
    both = np.concatenate(values)
    order = np.argsort(both, kind="stable")
    owner, both = owner[order], both[order]
    edges = np.append(np.flatnonzero(np.append(True, both[1:] != both[:-1])), len(both)) if len(both) else np.zeros(1, np.int64)
    spread = np.diff(edges)
    out = np.zeros(m * m)
    rare = 8
    for d in range(2, rare + 1):
        at = edges[:-1][spread == d]
        if len(at):
            posts = owner[at[:, None] + np.arange(d)]
            for p in range(d):
                for q in range(p + 1, d):
                    out += np.bincount(posts[:, p] * m + posts[:, q], minlength=m * m)
    out = out.reshape(m, m)
    out = out + out.T
    wide = np.flatnonzero(spread > rare)
    for k in range(0, len(wide), 2048):
        some = wide[k : k + 2048]
        have = np.zeros((m, len(some)), np.float32)
        for c, t in enumerate(some):
            have[owner[edges[t] : edges[t + 1]], c] = 1.0
        out += have @ have.T
    np.fill_diagonal(out, [len(v) for v in values])
    return out


def candidates(bands: np.ndarray, side: np.ndarray | None, band: int | None) -> np.ndarray:
    """Which pairs (row before column) of a block share a band, as a matrix; with ``band``, those whose first common band it is."""
    m = len(bands)
    shared, out = np.zeros((m, m), bool), np.zeros((m, m), bool)
    for name in bands.T:
        same = name[:, None] == name[None, :]
        if band is not None:
            out |= same & ~shared & (name == band)[:, None]
        shared |= same
    out = np.triu(shared if band is None else out, 1)
    if side is not None:
        out &= side[:, None] != side[None, :]
    return out


def _near(values: list[np.ndarray], wanted: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The wanted pairs that are similar enough; few are compared one by one, many all together."""
    size = np.array([len(v) for v in values], np.float64)
    least = similarity / (1 + similarity) * (size[:, None] + size[None, :]) - 1e-9
    i, j = np.nonzero(wanted & (np.minimum(size[:, None], size[None, :]) >= least))
    if len(i) * 16 < wanted.size:
        both = np.array([np.intersect1d(values[a], values[b], assume_unique=True).size for a, b in zip(i, j)], np.float64)
    else:
        both = _shared(values)[i, j]
    near = both >= similarity * (size[i] + size[j] - both) - 1e-9
    return i[near], j[near]


def _verify(n: int, similarity: float):
    """Links inside one block, as ``node, links, root``."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, weight = blocks.numbers(block.column("node")), blocks.numbers(block.column("n"))
        side, two = blocks.numbers(block.column("side")), bool(block.column("two")[0].as_py())
        bands, band = blocks.numbers(block.column("bands").flatten()).reshape(len(ids), -1), block.column("band")[0].as_py()
        values = []
        for part in textops.slices(block.column("text")):
            some, edges = ngram_sets(part, n)
            values += [some[a:b] for a, b in zip(edges[:-1], edges[1:])]
        name = np.array([_name(v) for v in values], np.uint64).reshape(-1, 2).view(np.int64)
        asked = np.stack([blocks.numbers(block.column("h1")), blocks.numbers(block.column("h2"))], 1)
        # Only the text that was asked for, and once.
        own = np.unique(np.column_stack([ids, name]), axis=0, return_index=True)[1]
        own = own[(name[own] == asked[own]).all(1)]
        if len(own) < 2:
            return None
        ids, weight, side, values = ids[own], weight[own], side[own], [values[k] for k in own]
        i, j = _near(values, candidates(bands[own], side if two else None, band), similarity)
        if not len(i):
            return None
        links = np.bincount(i, weights=weight[j], minlength=len(ids)) + np.bincount(j, weights=weight[i], minlength=len(ids))
        root = ids[blocks.roots(len(ids), i, j)]  # ids ascend in a block
        own = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[own]), pa.array(links[own].astype(np.int64)), pa.array(root[own])], names=["node", "links", "root"]
        )

    return work


def _placed(classes: DataFrame) -> DataFrame:
    """Every class that shares a band, with the ``keys`` its text is dealt by, each with its ``members``.

    A group of classes connected by bands is one key; where its bands are so thin that they
    take fewer rows than the group in chunks does, the bands are the keys.
    """
    measure = F.greatest(F.count("*"), F.ceil(F.sum("size") / MEMBER_BYTES)).alias("members")
    rows = (F.col("_rows") * F.ceil(F.col("members") / blocks.CHUNK)).alias("dealt")
    spots = classes.select("node", "size", F.explode("bands").alias("band"))
    busy = spots.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("_rows"), measure)
    busy = materialize(busy.where("_rows > 1").select("*", rows), "bands")
    spots = materialize(lookup(spots.drop("size"), busy, ["band"], "_rows", "inner").select("node", "band", "lead", "members"), "spots")
    pairs = spots.where("node <> lead").select(F.lit("").alias("cloud_id"), F.col("node").alias("a"), F.col("lead").alias("b"))
    groups = materialize(connected_components(pairs).select("node", F.col("label").alias("group")), "groups")
    whole = groups.join(classes.select("node", "size"), "node").groupBy("group").agg(F.count("*").alias("_rows"), measure).select("*", rows)
    thin = busy.select(F.col("lead").alias("node"), F.col("dealt").alias("_dealt")).join(groups, "node").groupBy("group").agg(F.sum("_dealt").alias("_dealt"))
    modes = whole.join(thin, "group").select("group", "_rows", "members", (F.col("_dealt") < F.col("dealt")).alias("by_band"))
    grouped = lookup(groups, materialize(modes, "modes"), ["group"], "_rows", "inner")
    own = spots.groupBy("node").agg(F.collect_list(F.struct(F.col("band").alias("key"), "band", "members")).alias("own"))
    one = F.struct(F.xxhash64(F.lit("group"), "group").alias("key"), F.lit(None).cast("bigint").alias("band"), "members")
    keys = F.when(F.col("by_band"), F.col("own")).otherwise(F.array(one)).alias("keys")
    return materialize(grouped.join(own, "node").select("node", keys).join(classes.drop("size"), "node"), "placed")


def ngram_links(documents: DataFrame, n: int = N, similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> DataFrame:
    """``doc_id, class_id, n_links, copy_of, kept`` of every row of ``documents`` (``doc_id, text``).

    Two documents are linked when the Jaccard similarity of their n-gram sets (``n``
    consecutive contract words; of fewer words, all of them) is at least ``similarity``.
    ``n_links`` counts the other documents linked directly, copies included; ``class_id`` is
    the smallest id reachable by links, ``copy_of`` the smallest id with the same n-gram set,
    and ``kept`` marks the document a class keeps. Null texts, texts without words and null
    ids link with nothing and are kept. Repeated rows are copies of each other. Different
    texts under one id are documents of their own: each has the links and the class of its
    own text, so one id can stand in several classes and two classes can have the same
    ``class_id``; if a class holds several texts under its smallest id, the one with the
    smallest hash is kept. Links are never wrong; one at the very limit is found with
    probability ``recall``, closer ones almost surely.
    """
    links = _links(_signed(documents, n, similarity, recall), documents, n, similarity)
    return links.select(F.col("_id").alias("doc_id"), "class_id", "n_links", "copy_of", "kept")


def _signed(documents: DataFrame, n: int, similarity: float, recall: float) -> DataFrame:
    return materialize(_sign(documents, n, *bands_for(similarity, recall)), "signed")


def _links(signed: DataFrame, documents: DataFrame, n: int, similarity: float) -> DataFrame:
    """The links of every row with its ``KEY``; ``judged`` is false for rows that link with nothing by themselves."""
    known = F.col("h1").isNotNull() & F.col("_id").isNotNull()
    rows = signed.where(known)
    # A class is named by a number of its own: its smallest id may be that of another class, too.
    classes = rows.groupBy("h1", "h2").agg(
        F.min(F.struct(*KEY)).alias("rep"), F.count("*").alias("n"), F.max("size").alias("size"), F.first("bands").alias("bands")
    )
    classes = materialize(classes.select("h1", "h2", "rep.*", "n", "size", "bands", F.monotonically_increasing_id().alias("node")), "classes")
    placed = _placed(classes)
    # Only texts that are asked for are exchanged.
    asked = may_match(documents.select(*_key(), "text"), placed, KEY)
    texts = lookup(asked, placed, KEY, "n", "inner")
    if not rows.groupBy(*KEY).count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["node"])
    texts = texts.withColumn("_key", F.explode("keys")).select("node", "n", "h1", "h2", "bands", "text", "_key.*")
    dealt = blocks.deal(texts, "key", "members", "node").select(
        "block", "band", "node", "n", "side", "two", "h1", "h2", "bands", "text"
    )
    found = blocks.by_block(dealt, "node", _verify(n, similarity), "node long, links long, root long")
    found = materialize(found, "links")
    edges = found.where("node <> root").select(F.lit("").alias("cloud_id"), F.col("node").alias("a"), F.col("root").alias("b"))
    comps = materialize(connected_components(edges).select("node", "label").join(classes.select("node", F.struct(*KEY).alias("rep")), "node"), "comps")
    leads = materialize(comps.groupBy("label").agg(F.min("rep").alias("lead"), F.count("*").alias("_members")), "leads")
    comps = lookup(comps.drop("rep"), leads, ["label"], "_members", "inner").select("node", "lead")
    counts = found.groupBy("node").agg(F.sum("links").alias("_links"))
    facts = classes.select("h1", "h2", "node", F.struct(*KEY).alias("rep"), "n").join(counts, "node", "left").join(comps, "node", "left").select(
        "h1", "h2", "n", F.coalesce("lead", "rep").alias("lead"), F.col("rep._id").alias("copy_of"),
        (F.coalesce("_links", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"),
    )
    linked = lookup(rows.select(*KEY, "h1", "h2"), materialize(facts, "facts"), ["h1", "h2"], "n", "inner").select(
        *KEY, F.col("lead._id").alias("class_id"), "n_links", "copy_of", (F.struct(*KEY) == F.col("lead")).alias("kept"), F.lit(True).alias("judged")
    )
    alone = signed.where(~known).select(
        *KEY, F.col("_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("copy_of"),
        F.lit(True).alias("kept"), F.lit(False).alias("judged"),
    )
    return linked.unionByName(alone)


def keep_one(documents: DataFrame, n: int = N, similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> DataFrame:
    """One document of each class, the one ``ngram_links`` marks as kept, with all its columns.

    A row goes by its own text, whatever else its id holds. Of rows that repeat both id and
    text one is kept. Rows with a null id or without words stay.
    """
    links = _links(_signed(documents, n, similarity, recall), documents, n, similarity).where("judged")
    marks = links.groupBy(*KEY).agg(F.first("kept").alias("_kept"), F.count("*").alias("_copies"))
    marks = materialize(marks.where("NOT _kept OR _copies > 1"), "marks")
    safe, restore = shielded(documents, ("doc_id", "text"))
    marked = lookup(safe.select("*", *_key()), marks, KEY, "_copies")
    left = marked.where("_kept IS NULL")
    if not marks.where("_kept").isEmpty():
        left = left.unionByName(marked.where("_kept").dropDuplicates(KEY))
    return left.select(*restore())
