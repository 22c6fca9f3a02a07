"""Mixing sources to target weights: repeat or thin each source's documents until its words meet its target.

DataFrame functions only. Words are counted per document, summed per source before the
shuffle, and targets are found on the table of sources, dealt by ranges. Each document is emitted
floor(rate) times, and once more when its seeded hash falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .shield import shielded

WEIGHTS = (5, 2, 1)
#: A target stops at this many times its source's words.
MOST_REPEATS = 3
SEED = "mix"
#: Up to this size the table of sources is broadcast.
BROADCAST_BYTES = 16 << 20


def words(text: Column | str) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def _ranged(rows: DataFrame, order: list[str], sums: dict[str, str], label: str) -> DataFrame:
    """``rows`` with ``_before_<name>``: the sum of a column over all rows that come earlier in the order, which must be strict.

    Rows are dealt by ranges of the order; each task sums its own range, and the ranges before it add one number each. So no
    task holds more than a range, and only one row per range meets in one place.
    """
    placed = materialize(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)
    parts = placed.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", *[F.coalesce(F.sum(f"_sum_{k}").over(earlier), F.lit(0)).alias(f"_start_{k}") for k in sums])
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    told = placed.withColumns({f"_own_{k}": F.coalesce(F.sum(v).over(within), F.lit(0)) for k, v in sums.items()})
    told = told.join(F.broadcast(starts), "_part")  # one row per range of the shuffle
    return told.withColumns({f"_before_{k}": F.col(f"_start_{k}") + F.col(f"_own_{k}") for k in sums}).drop(
        "_part", *[f"_{n}_{k}" for n in ("start", "own") for k in sums]
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``target`` of every row of ``sources`` (``source``, ``source_size``, one row each).

    Sources are ordered by code point, null last, and take the weights in turn. All sizes
    together are shared by weight; no target passes ``most`` times its source's size, and
    the excess goes to the others by weight. Filling sources in order of cap per weight
    gives the level at which that ends: a source is full when its cap per weight is at
    most the level of those after it. Both orders are dealt by ranges, so sources may be many.
    """
    named = sources.withColumns({"_none": F.col("source").isNull(), "_name": F.encode("source", "UTF-8"), "_one": F.lit(1).cast("bigint")})
    ranked = _ranged(named, ["_none", "_name"], {"rank": "_one"}, "ranked").drop("_none", "_name", "_one").withColumnRenamed("_before_rank", "_rank")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("_w", cycle).withColumn("_cap", (F.col("source_size") * most).cast("double"))
    caps = caps.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    filled = materialize(_ranged(caps, ["_ratio", "_rank"], {"cap": "_cap", "w": "_w"}, "capped"), "filled")
    size, weight = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0.0))).first()
    levels = filled.withColumn("_level", (F.lit(size) - F.col("_before_cap")) / (F.lit(weight) - F.col("_before_w")))
    # Levels only rise along the order, so the first source left open fixes the level of all open ones.
    first = levels.where(F.col("_ratio") > F.col("_level")).agg(F.min(F.struct("_ratio", "_rank", "_level")).alias("f")).first()["f"]
    level = F.lit(None if first is None else float(first["_level"])).cast("double")
    return filled.withColumn(
        "target", F.when(level.isNull() | (F.col("_ratio") <= level), F.col("_cap")).otherwise(F.col("_w") * level)
    ).drop("_rank", "_w", "_cap", "_ratio", "_before_cap", "_before_w")


def _draw(seed: str) -> Column:
    """A number in [0, 1) fixed by the seed, the document's id and its text."""
    digest = F.md5(F.concat_ws("\x1f", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def copies(documents: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """All columns of ``documents`` with ``size``, ``source_size``, ``target`` and ``copies`` to take.

    ``copies`` is floor(rate), rate being target / source_size, plus a Bernoulli copy with
    the fraction as its probability. The draw depends on seed, id and text only, so reruns
    agree; repeated rows get the same copies. A null text has size 0; sources without words
    have target 0 and give no copies. Input columns with the names of the new ones are replaced.
    """
    kept = documents.drop("size", "source_size", "target", "copies").withColumns({"size": words("text"), "_draw": _draw(seed)})
    sizes = kept.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source. Measured small, it goes to the documents, which then are not shuffled;
    # else it is a join like any other.
    goal = materialize(targets(sizes, weights, most).withColumnRenamed("source", "_source"), "targets")
    held = goal.agg(F.coalesce(F.sum(F.coalesce(F.length("_source"), F.lit(0)) * 4 + 64), F.lit(0))).first()[0]
    goal = F.broadcast(goal) if held <= BROADCAST_BYTES else goal
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = kept.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return out.withColumn("copies", (F.floor(rate) + (F.col("_draw") < rate - F.floor(rate)).cast("bigint")).cast("bigint")).drop("_draw")


def mix_report(documents: DataFrame) -> DataFrame:
    """Per document what the mix takes of it: ``doc_id, size, source_size, target, taken``."""
    out = copies(documents.select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves: each row as often as it is taken, with ``copy`` (which replaces a column of that name) counted from 0."""
    safe, restore = shielded(documents.drop("copy"), ("doc_id", "text", "source"))
    out = copies(safe, seed).where(F.col("copies") > 0)
    return out.select(*restore(), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
