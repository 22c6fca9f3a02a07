"""Query tables for similarity search, from text, list files and folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import list_files


def _trimmed_items(text: Column, separator: str) -> Column:
    return F.filter(F.transform(F.split(text, separator), lambda v: F.trim(v)), lambda v: v != "")


def path_items(text: Column) -> Column:
    """Paths in a JSON list or a comma list; broken JSON is read as a comma list."""
    raw = F.trim(F.coalesce(text, F.lit("")))
    return F.when(raw.startswith("["), F.coalesce(F.from_json(raw, "array<string>"), _trimmed_items(raw, ","))).otherwise(
        _trimmed_items(raw, ",")
    )


def inline_paths(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode a text column of path lists, one query per row."""
    return df.select(*keep, F.posexplode(path_items(F.col(text))).alias("position", "query_path"))


def query_paths(spark: SparkSession, inline: str | None = None, file: str | None = None,
                root: str | None = None) -> DataFrame:
    """Paths from inline text, a list file and a folder, with their ``source`` (0, 1, 2) and ``position``, repeats kept.

    Order by both to list them as given; a list file that begins like JSON and is not fails.
    """
    parts = []
    if inline and inline.strip():
        text = spark.range(1).select(F.lit(inline).alias("text"))
        parts.append(inline_paths(text, "text").select(F.lit(0).alias("source"), F.col("position").cast("bigint").alias("position"), "query_path"))
    if file:
        lines = spark.read.text(file).where(F.trim("value") != "")
        opening = lines.first()
        if opening and opening[0].lstrip().startswith("["):
            whole = spark.read.option("wholetext", "true").text(file).where(F.trim("value", F.lit(" \t\r\n")) != "")
            items = F.from_json("value", "array<string>")
            broken = F.raise_error(F.concat(F.lit("not a JSON list of paths: "), F.substring("value", 1, 80))).cast("array<string>")
            items = F.when(items.isNotNull(), items).otherwise(broken)
            listed = whole.select(F.posexplode(items).alias("position", "query_path"))
        else:
            listed = lines.select(F.monotonically_increasing_id().alias("position"), F.trim("value").alias("query_path"))
        parts.append(listed.select(F.lit(1).alias("source"), F.col("position").cast("bigint").alias("position"), "query_path"))
    if root:
        found = list_files(spark, root, "*.tif*")
        parts.append(found.select(F.lit(2).alias("source"), F.lit(0).cast("bigint").alias("position"), F.col("path").alias("query_path")))
    if not parts:
        raise ValueError("no query inputs: give inline text, a list file or a folder")
    return reduce(DataFrame.unionByName, parts)


_PAIR = "struct<x:double,y:double>"


def coord_items(text: Column) -> Column:
    """Coordinates in a JSON list of ``{x,y}`` or ``[x,y]``, or in ``"x y, x y"`` text.

    Malformed items are left out.
    """
    raw = F.trim(F.coalesce(text, F.lit("")))
    listed = F.transform(
        F.from_json(raw, "array<string>"),
        lambda item: F.when(
            F.trim(item).startswith("{"),
            F.named_struct(
                F.lit("x"), F.get_json_object(item, "$.x").try_cast("double"),
                F.lit("y"), F.get_json_object(item, "$.y").try_cast("double"),
            ),
        ).when(
            F.array_size(F.from_json(item, "array<string>")) == 2,
            F.named_struct(
                F.lit("x"), F.get(F.from_json(item, "array<string>"), F.lit(0)).try_cast("double"),
                F.lit("y"), F.get(F.from_json(item, "array<string>"), F.lit(1)).try_cast("double"),
            ),
        ),
    )
    plain = F.transform(
        F.filter(F.transform(_trimmed_items(raw, ","), lambda v: F.split(v, r"\s+")), lambda v: F.array_size(v) == 2),
        lambda v: F.named_struct(
            F.lit("x"), F.get(v, F.lit(0)).try_cast("double"), F.lit("y"), F.get(v, F.lit(1)).try_cast("double")
        ),
    )
    items = F.when(raw.startswith("["), listed).otherwise(plain)
    return F.filter(items, lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull())


def query_coords(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per coordinate found in a text column."""
    return df.select(*keep, F.posexplode(coord_items(F.col(text))).alias("position", "p")).select(
        *keep, "position", F.col("p.x").alias("query_x"), F.col("p.y").alias("query_y")
    )
