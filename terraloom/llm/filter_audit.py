"""Interaction audit of five quality filters: what every order of them removes, and what each one is worth.

A document's failures are five bits. Counts per part and set of failures give the value of all
32 coalitions (documents that fail any filter of the coalition). Differences of coalitions are
the counts of every step of every order; the Shapley value of a filter is the exact solution of
the least-squares problem over all coalitions with kernel weights, constrained to share out the
value of the full coalition, solved in rationals.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import lookup, materialize
from . import textops

FILTERS = "ABCDE"
MOST_CAPS_PERCENT = 2
LEAST_DISTINCT_PERCENT = 50
LEAST_WORDS = 200
_ALL = (1 << len(FILTERS)) - 1


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*|")] = True


def failures(part: textops.Slice) -> np.ndarray:
    """The failures A to D of every text of a slice as bits 1, 2, 4 and 8. Words are told apart by 64-bit hashes."""
    data, n = part.data, part.n
    starts, ends = textops.bounds(~_SPACE[data], part.offsets)
    docs = part.docs(starts)
    words = np.bincount(docs, minlength=n)
    hashes = textops.run_hashes(textops.prefix_sums(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.append(True, (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1]))[: len(docs)]
    distinct = np.bincount(docs[new], minlength=n)

    def count(member: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(member)))[part.offsets])

    chars = count((data & 0xC0) != 0x80)
    fails = [
        words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT_PERCENT * words, 100 * count((data >= 65) & (data <= 90)) > MOST_CAPS_PERCENT * chars,
        count(_MARKS[data]) > 0,
    ]
    return sum(failed.astype(np.int32) << k for k, failed in enumerate(fails))


def _masks(documents: DataFrame) -> DataFrame:
    """``doc_id, part, h1, h2, mask`` of every row; texts are read once and leave their task as a hash of 128 bits."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(F.lit(13), text).alias("h1"), F.xxhash64(F.lit(31), text).alias("h2"), "text",
    )
    kept = rows.columns[:-1]

    def run(batches):
        for batch in batches:
            masks = [failures(part) for part in textops.slices(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(np.concatenate(masks) if masks else [], pa.int32())], names=[*kept, "mask"]
            )

    return rows.mapInArrow(run, rows.select(*kept).schema.add("mask", "integer"))


def audit_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, mask, good, toxic`` of every row of ``documents`` (``doc_id, text, source``).

    ``mask`` has a bit for each filter failed, E (16) where a row with a smaller id has the
    identical text. ``part`` is the source, null as the empty string. Rows with a null id
    never fail E and make no other row fail it; rows that repeat the smallest id of a text do not fail
    it either. ``good`` and ``toxic`` tell whether any label row of the id says so; a null id has no labels.
    """
    slim = materialize(_masks(documents), "failures")
    firsts = slim.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    firsts = materialize(firsts.where("copies > 1 AND first IS NOT NULL"), "copies")
    slim = lookup(slim, firsts, ["h1", "h2"], "copies")
    later = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    slim = slim.select("doc_id", "part", (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask"))
    said = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    rows = documents.groupBy("doc_id").agg(F.count("*").alias("rows"))
    return lookup(slim, materialize(said.join(rows, "doc_id"), "labels"), ["doc_id"], "rows").select(
        "doc_id", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )


def coalitions(rows: DataFrame) -> DataFrame:
    """``part, removed, good, toxic``: arrays over the 32 sets of filters of the documents that fail any of the set."""
    counts = rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("good"), 1)).alias("g"), F.count(F.when(F.col("toxic"), 1)).alias("t")
    )

    def table(column: str) -> Column:
        def failing(s: Column) -> Column:
            own = F.filter("counts", lambda c: c["mask"].bitwiseAND(s) != 0)
            return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, c: total + c[column])

        return F.transform(F.sequence(F.lit(0), F.lit(_ALL)), failing)

    # One entry for each set of failures: at most 32.
    found = counts.groupBy("part").agg(F.sum("n").alias("documents"), F.collect_list(F.struct("mask", "n", "g", "t")).alias("counts"))
    return found.select("part", "documents", table("n").alias("removed"), table("g").alias("good"), table("t").alias("toxic"))


def _solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination in rationals, for several right-hand sides at once."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(r for r in range(k, len(rows)) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r, row in enumerate(rows):
            if r != k and row[k]:
                rows[r] = [x - row[k] * y for x, y in zip(row, rows[k])]
    return [row[len(matrix):] for row in rows]


def shapley_weights(m: int = len(FILTERS)) -> list[list[Fraction]]:
    """For each of ``m`` players the weight of every coalition's value in its Shapley value.

    The normal equations of the least-squares fit of coalition values by sums of players,
    with the kernel weight (m - 1) / (C(m, s) s (m - s)) for a coalition of s players and a
    multiplier for the constraint that the players share the full value. The solution is
    linear in the values, so one elimination serves every table of values.
    """
    inner = [s for s in range(1, (1 << m) - 1)]
    kernel = {s: Fraction(m - 1, comb(m, s.bit_count()) * s.bit_count() * (m - s.bit_count())) for s in inner}
    matrix = [[sum((kernel[s] for s in inner if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(m)] + [Fraction(1)] for i in range(m)]
    matrix.append([Fraction(1)] * m + [Fraction(0)])
    right = [[kernel.get(s, Fraction(0)) if s >> i & 1 and s in kernel else Fraction(0) for s in range(1 << m)] for i in range(m)]
    right.append([Fraction(int(s == (1 << m) - 1)) for s in range(1 << m)])
    return _solve(matrix, right)[:m]


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step``; see ``audit_rows`` for nulls, ties and repeated rows.

    ``removed`` counts documents that fail the step's filter and none before it, ``kept``
    those that fail none so far, ``redundant`` those that fail it and an earlier one, ``unique_fails`` those
    that fail it alone; ``shapley`` is the filter's ``removed`` summed over all 120 orders. A
    part without failures has zeros; an empty table has no parts and no rows.
    """
    plan = [
        {"filter_order": "".join(FILTERS[f] for f in order), "step": k + 1, "f": f, "bit": 1 << f, "before": sum(1 << x for x in order[:k])}
        for order in permutations(range(len(FILTERS))) for k, f in enumerate(order)
    ]
    whole = factorial(len(FILTERS))
    # Weights times the number of orders are whole numbers, so sums of counts stay exact.
    weights = [[int(x * whole) for x in row] for row in shapley_weights()]
    table = materialize(coalitions(audit_rows(documents, labels)), "coalitions")
    fixed = F.from_json(F.lit(json.dumps(weights)), "array<array<bigint>>")
    shapley = F.transform(fixed, lambda row: F.aggregate(
        F.zip_with(row, "removed", lambda w, v: w * v), F.lit(0).cast("bigint"), lambda total, x: total + x
    ))
    steps = table.withColumn("shapleys", shapley).select(
        "*", F.inline(F.from_json(F.lit(json.dumps(plan)), "array<struct<filter_order string, step int, f int, bit int, before int>>"))
    )

    def value(of: str, mask: Column) -> Column:
        return F.element_at(of, mask + 1)

    bit, before = F.col("bit"), F.col("before")
    removed = value("removed", before + bit) - value("removed", before)
    return steps.select(
        "part", "filter_order", "step", (F.col("documents") - value("removed", before + bit)).alias("kept"), removed.alias("removed"),
        (value("removed", bit) - removed).alias("redundant"),
        (value("removed", F.lit(_ALL)) - value("removed", _ALL - bit)).alias("unique_fails"),
        (value("good", before + bit) - value("good", before)).alias("good_lost"),
        (value("toxic", before + bit) - value("toxic", before)).alias("toxic_lost"),
        value("shapleys", F.col("f")).alias("shapley"),
    )
