"""Catalog rows, ingest log, path resolution and quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths, text, vectors

_METRICS = "struct<min:double,max:double,mean:double,std:double,width:int,height:int,crs:string,count:int>"


def resolve_by_id(files: DataFrame, ids: DataFrame, pick: str = "first", base: str | None = None,
                  suffix: str | None = None, strict: bool = False) -> DataFrame:
    """Smallest (``first``) or largest (``latest``) landed path per requested id.

    The id is cut out of the path once and joined by equality; paths are reduced to
    one per id before the join. Blank ids are dropped, or fail with ``strict``, as
    do ids without a file.
    """
    if pick not in ("first", "latest"):
        raise ValueError("pick must be 'first' or 'latest'")
    wanted = ids.select(F.trim("file_id").alias("file_id")).distinct()
    found = files
    if base:
        found = found.where(F.concat(F.lit("/"), "path").contains(f"/{base.strip('/')}/"))
    if suffix:
        found = found.where(F.col("path").rlike(paths.glob_regex(suffix)))
    reduce = F.min if pick == "first" else F.max
    chosen = (
        found.withColumn("file_id", paths.landed_id("path"))
        .where(F.col("file_id").isNotNull())
        .groupBy("file_id")
        .agg(reduce("path").alias("path"))
    )
    hits = wanted.where("file_id <> ''").join(chosen, "file_id", "left")
    if strict:
        missing = wanted.join(chosen, "file_id", "left_anti").first()
        if missing:
            raise FileNotFoundError(f"no file found for id {missing[0]!r}")
    return hits.where(F.col("path").isNotNull())


def latest_record(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Newest row per key; each task keeps one row per key before the shuffle."""
    order = Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def metrics_side_by_side(raw: DataFrame, processed: DataFrame, key: str = "raster_id") -> DataFrame:
    """Raw and processed statistics of the same raster on one row."""
    names = [c for c in raw.columns if c != key]
    left = raw.select(key, *[F.col(c).alias(f"raw_{c}") for c in names])
    right = processed.select(key, *[F.col(c).alias(f"processed_{c}") for c in names if c in processed.columns])
    return left.join(right, key)


def catalog_rows(stats: DataFrame, landed: DataFrame, key: str = "file_id") -> DataFrame:
    """Raster catalog rows from statistics and landed files, under their real names and paths."""
    return stats.join(landed.select(key, "path", "ingested_at"), key).select(
        F.col(key).alias("file_id"),
        paths.basename("path").alias("filename"),
        "ingested_at",
        F.col("width").cast("int").alias("width"),
        F.col("height").cast("int").alias("height"),
        F.coalesce(F.col("crs"), F.lit("None")).alias("crs"),
        "min_val", "max_val", "mean_val", "std_val",
        F.col("path").alias("s3_path"),
    )


def metrics_payload(payload: Column, kind: str = "raw") -> Column:
    """The ``kind`` part of a metrics JSON; broken text gives NULL fields."""
    return text.json_or_empty(F.trim(payload), f"raw {_METRICS}, processed {_METRICS}")[kind]


def ingest_log(good: DataFrame, bad: DataFrame, file_id: str = "raster_id", path: str = "path") -> DataFrame:
    """One log row per file: ``ok``, or ``failed`` with its errors."""
    done = good.select(
        F.col(file_id).alias("file_id"), F.col(path).alias("source_path"),
        F.lit("ok").alias("ingest_status"), F.lit(None).cast("string").alias("error_message"),
    )
    failed = bad.select(
        F.col(file_id).alias("file_id"), F.col(path).alias("source_path"),
        F.lit("failed").alias("ingest_status"), F.concat_ws("; ", "errors").alias("error_message"),
    )
    return done.unionByName(failed)


def qa_metrics(tiles: DataFrame, patches: DataFrame, tiles_dir: str = "", embeddings_dir: str = "") -> DataFrame:
    """Tile and patch counts, missing vectors, and the length of the first patch's vector."""
    length = vectors.dimension(F.col("embedding"))
    counts = patches.agg(
        F.count("*").alias("embedding_count"),
        F.count_if(F.col("embedding").isNull()).alias("missing_embeddings"),
        F.min_by(length, F.col("patch_id")).alias("embedding_dim"),
    )
    tile_count = tiles.agg(F.count("*").alias("tile_count"))
    # Two one-row tables, joined on a constant key.
    one = F.lit(1).alias("_one")
    return (
        tile_count.select(one, "*")
        .join(counts.select(one, "*"), "_one")
        .select(
            "tile_count", "embedding_count", "missing_embeddings", "embedding_dim",
            F.lit(tiles_dir).alias("tiles_dir"), F.lit(embeddings_dir).alias("embeddings_dir"),
        )
    )
