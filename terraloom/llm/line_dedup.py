"""Line dedup: repeated runs of lines, found by prefix doubling over line names; later copies are deleted.

DataFrame functions only. Each document is a sequence of line names. Suffixes are named by
their first 1, 2, 4, ... lines: the name of twice as many lines is made of the names of both
halves, and suffixes whose name is alone drop out, as nothing longer can repeat there. The
suffixes of one name are an interval of the suffix array of all documents whose common
prefix has that many lines; names stand in for ranks, so no global order is needed.

A run counts from ``MIN_WORDS`` words. Every line of a maximal repeated run of that size lies
in a shortest such stretch that begins or ends inside the run, so it is enough to look at
the shortest stretch from each line on and up to each line. Two overlapping names of a power
of two lines name any stretch; a stretch whose name occurs earlier is a later copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import lookup, materialize
from .shield import shielded

#: Words from which a repeated run of lines is deleted.
MIN_WORDS = 50
KEY = ("none", "id", "body")


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def _words(line: Column | str) -> Column:
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).cast("int")


def _key(documents: DataFrame) -> list[Column]:
    """Whether the id is null, the id, and a hash of the text: never null, and ordered so."""
    kind = documents.schema["doc_id"].dataType
    return [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast(kind)).alias("id"), F.xxhash64("text").alias("body")]


def _line_table(documents: DataFrame) -> DataFrame:
    """One row per line: the document's key, position, words, and the name ``a, b`` of the line without outer blanks."""
    docs = documents.select(*_key(documents), F.posexplode(_lines("text")).alias("p", "line"))
    line = F.trim(F.regexp_replace("line", "\r$", ""))
    return docs.select(*KEY, "p", _words("line").alias("w"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _repeated(rows: DataFrame, name: list[str]) -> DataFrame:
    """The rows whose name stands at two places or more."""
    counts = materialize(rows.groupBy(*name).agg(F.count("*").alias("_n")).where("_n > 1"), "names")
    return lookup(rows, counts, name, "_n", "inner").drop("_n")


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Shortest stretches of ``min_words`` words inside each segment of adjoining rows: key, ``p`` and ``lines``."""
    by_doc = Window.partitionBy(*KEY).orderBy("p")
    marked = lines.withColumn("seg", F.col("p") - F.row_number().over(by_doc))
    segment = Window.partitionBy(*KEY, "seg")
    ran = marked.withColumn("start", F.sum("w").over(segment.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)))
    ran = ran.withColumn("start", F.coalesce("start", F.lit(0).cast("bigint"))).withColumn("total", F.sum("w").over(segment))
    ran = ran.where(F.col("total") >= min_words)
    last = ran.groupBy(*KEY, "seg").agg((F.max("p") + 1).alias("p"), F.max("total").alias("start"))
    points = ran.select(*KEY, "seg", "p", "start").unionByName(last)  # every place where a stretch may begin or end
    by_words = segment.orderBy("start")
    found = points.withColumn("end", F.min("p").over(by_words.rangeBetween(min_words, Window.unboundedFollowing)))
    found = found.withColumn("begin", F.max("p").over(by_words.rangeBetween(Window.unboundedPreceding, -min_words)))
    onward = found.where("end IS NOT NULL").select(*KEY, "p", (F.col("end") - F.col("p")).alias("lines"))
    upto = found.where("begin IS NOT NULL").select(*KEY, F.col("begin").alias("p"), (F.col("p") - F.col("begin")).alias("lines"))
    return onward.unionByName(upto).distinct()


def _doubled(rows: DataFrame, half: int) -> DataFrame:
    """Names of ``2 * half`` lines from the names of ``half`` lines; positions without a second half drop out."""
    ahead = Window.partitionBy(*KEY).orderBy("p").rangeBetween(half, half)
    both = rows.withColumn("_next", F.first(F.struct("a", "b")).over(ahead)).where("_next IS NOT NULL")
    return both.select(
        *KEY, "p", F.xxhash64("a", "b", "_next.a", "_next.b").alias("a"), F.xxhash64(F.lit(1), "b", "a", "_next.b", "_next.a").alias("b")
    )


def removed_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Key and ``gone`` (sorted line positions from 0) of every document that holds later copies.

    ``id, body`` are ``doc_id`` and a hash of the text. The copy with the smallest id (null
    last), then text hash, then position is the first one and stays.
    """
    lines = materialize(_line_table(documents.where(F.col("text").isNotNull())), "lines")
    twice = materialize(_repeated(lines, ["a", "b"]).select(*KEY, "p", "w", "a", "b").dropDuplicates([*KEY, "p"]), "twice")
    stretches = materialize(_stretches(twice, min_words), "stretches")
    longest = stretches.agg(F.max("lines")).first()[0] or 0
    level, half, levels = twice.join(stretches.select(*KEY).distinct(), list(KEY), "left_semi").select(*KEY, "p", "a", "b"), 1, []
    while half <= longest:
        level = materialize(level, "level")
        levels.append(level.withColumn("half", F.lit(half)))
        if 2 * half <= longest:
            level = _repeated(_doubled(level, half), ["a", "b"])
        half *= 2
    if not levels:
        return stretches.select(*KEY, F.array(F.col("p")).alias("gone")).limit(0)
    names = levels[0]
    for other in levels[1:]:
        names = names.unionByName(other)
    # Of every stretch, the first and the last 2**k lines that fit.
    asked = stretches.withColumn("half", F.pow(F.lit(2.0), F.floor(F.log2(F.col("lines").cast("double") + 0.5))).cast("int"))
    asked = asked.withColumn("tail", F.col("p") + F.col("lines") - F.col("half"))
    tail = names.select(*KEY, "half", F.col("p").alias("tail"), F.col("a").alias("c"), F.col("b").alias("d"))
    named = asked.join(names, [*KEY, "half", "p"]).join(tail, [*KEY, "half", "tail"]).drop("half", "tail")
    named = materialize(named, "named")
    place = F.struct(*KEY, "p")
    first = named.groupBy("a", "b", "c", "d", "lines").agg(F.count("*").alias("_n"), F.min(place).alias("_first")).where("_n > 1")
    later = lookup(named, materialize(first, "first"), ["a", "b", "c", "d", "lines"], "_n", "inner").where(place > F.col("_first"))
    gone = later.select(*KEY, F.explode(F.sequence(F.col("p"), F.col("p") + F.col("lines") - 1)).alias("p"))
    return gone.groupBy(*KEY).agg(F.array_sort(F.collect_set("p")).alias("gone"))


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of ``documents`` with later copies of repeated line runs taken out of ``text``.

    New columns ``n_lines`` (0 for null) and ``gone`` (removed positions, empty where none).
    Null and empty texts stay as they are, as do runs of fewer than ``min_words`` words. Rows
    that repeat both id and text count as one document and are treated alike. Input columns
    with the names of the new ones are replaced.
    """
    gone = removed_lines(documents.select("doc_id", "text"), min_words)
    gone = materialize(gone, "gone").select(*[F.col(c).alias("_" + c) for c in (*KEY, "gone")])
    docs, restore = shielded(documents.drop("n_lines", "gone"), ("doc_id", "text"))
    # The list of removals grows with the documents: the same merge join at every size.
    joined = docs.join(gone.hint("merge"), [own == F.col("_" + c) for own, c in zip(_key(documents), KEY)], "left")
    left = F.filter(_lines("text"), lambda _, k: ~F.array_contains("_gone", k))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *restore(text=text),
        F.coalesce(F.size(_lines("text")), F.lit(0)).alias("n_lines"), F.coalesce("_gone", F.array().cast("array<int>")).alias("gone"),
    )


def line_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_removed, text`` after dedup."""
    out = dedup_lines(documents.select("doc_id", "text"))
    return out.select("doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.size("gone").cast("bigint").alias("n_removed"), "text")
