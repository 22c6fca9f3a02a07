"""Point cloud scans."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths
from ..schemas import LAS_DIMENSIONS, POINT
from . import las

CHUNK = 65_536


def las_problems(blobs: DataFrame) -> DataFrame:
    """``path, error`` of the LAS files that cannot be read whole; their points are left out by ``las_points``."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(path, _problem(data)) for path, data in zip(batch["path"], batch["content"])]
            yield pd.DataFrame([f for f in found if f[1]], columns=["path", "error"])

    return blobs.select("path", "content").mapInPandas(scan, "path string, error string")


def _problem(data: bytes) -> str | None:
    try:
        head = las.read_header(data)
        if head["record_size"] < las.RECORD_SIZES.get(head["format"], 1 << 16):
            return f"ValueError: point format {head['format']} with records of {head['record_size']} bytes"
        need = head["points_at"] + head["count"] * head["record_size"]
        return None if len(data) >= need else f"ValueError: {len(data)} of {need} bytes"
    except Exception as problem:
        return f"{type(problem).__name__}: {problem}"


def las_points(blobs: DataFrame) -> DataFrame:
    """Points of LAS files; ``cloud_id`` is the path, ``point_id`` the record number.

    One malformed file does not stop the others: it has no points, and ``las_problems`` names it.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                if _problem(data):
                    continue
                head = las.read_header(data)
                for first in range(0, head["count"], CHUNK):
                    xyz = las.read_points(data, first, min(CHUNK, head["count"] - first), head)
                    yield pd.DataFrame(
                        {
                            "cloud_id": path,
                            "point_id": np.arange(first, first + len(xyz), dtype="int64"),
                            "x": xyz[:, 0],
                            "y": xyz[:, 1],
                            "z": xyz[:, 2],
                        }
                    )

    return blobs.select("path", "content").mapInPandas(scan, POINT)


_ARROW = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}


def las_records(blobs: DataFrame, cloud: str = "path") -> DataFrame:
    """Points of LAS files with every dimension of their point formats; ``cloud_id`` is the column ``cloud``.

    A dimension that a file lacks is null. Malformed files have no points, as in ``las_points``.
    """
    dims = [d.split() for d in LAS_DIMENSIONS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                data = data.as_py()
                if data is None or _problem(data):
                    continue
                head = las.read_header(data)
                for first in range(0, head["count"], CHUNK):
                    n = min(CHUNK, head["count"] - first)
                    xyz, more = las.read_points(data, first, n, head), las.read_dimensions(data, first, n, head)
                    columns = [pa.repeat(name, n), pa.array(np.arange(first, first + n)), *[pa.array(xyz[:, k]) for k in range(3)]]
                    for dim, kind in dims:
                        found = more.get(dim)
                        if found is not None and kind == "binary":
                            columns.append(pa.array([v.tobytes() for v in found], pa.binary()))
                        else:
                            columns.append(pa.nulls(n, _ARROW[kind]) if found is None else pa.array(found.astype(_ARROW[kind].to_pandas_dtype())))
                    yield pa.RecordBatch.from_arrays(columns, names=["cloud_id", "point_id", "x", "y", "z", *[d for d, _ in dims]])

    return blobs.select(F.col(cloud).cast("string"), "content").mapInArrow(scan, f"{POINT}, {LAS_DIMENSIONS}")


def csv_points(spark: SparkSession, root: str) -> DataFrame:
    """Points of CSV files whose header names ``x, y, z`` in any order; ``cloud_id`` is the path.

    A file without a ``point_id`` column gets ids made up in reading order. A file whose
    header lacks an axis fails the scan. Files are read once per header layout.
    """
    from .files import list_files

    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[cC][sS][vV]")
    found = list_files(spark, root).where(paths.extension("path") == ".csv")
    if found.isEmpty():
        return spark.createDataFrame([], POINT)
    names = F.transform(F.split("value", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '[\ufeff"\r]', ""))))
    heads = lines.text(root).select(F.col("_metadata.file_path").alias("path"), names.alias("names"))
    # Only a header has words for cells, so it is known without relying on the order of lines.
    heads = heads.where(F.arrays_overlap("names", F.array(*map(F.lit, "xyz")))).distinct()
    clean = F.regexp_replace("path", "^file:/+", "file:/")
    known = heads.select(clean.alias("path"), "names")
    files = found.select(clean.alias("path")).join(known, "path", "left")
    layouts = files.groupBy("names").agg(F.collect_list("path").alias("paths")).collect()
    parts = []
    for names_, files_ in layouts:
        if names_ is None or not {"x", "y", "z"} <= set(names_):
            raise ValueError(f"no header with x, y and z in {files_[0]}")
        schema = T.StructType([T.StructField(f"_{k}_{n}", T.StringType()) for k, n in enumerate(names_)])
        table = spark.read.schema(schema).option("header", "true").csv(files_)
        at = {n: F.trim(f"_{k}_{n}") for k, n in reversed(list(enumerate(names_)))}
        point = at["point_id"].cast("bigint") if "point_id" in at else F.monotonically_increasing_id()
        parts.append(table.select(
            F.col("_metadata.file_path").alias("cloud_id"), point.alias("point_id"), *[at[a].cast("double").alias(a) for a in "xyz"]
        ))
    return reduce(DataFrame.unionByName, parts)


def pointcloud_scan(spark: SparkSession, root: str) -> DataFrame:
    """All ``.las`` and ``.csv`` clouds below a folder, whatever the case of the extension.

    A file with another extension fails the scan.
    """
    from .files import blob_scan, list_files

    odd = list_files(spark, root).where(~F.coalesce(paths.extension("path"), F.lit("")).isin(".las", ".csv"))
    found = odd.select("path").first()
    if found:
        raise ValueError(f"unsupported point cloud file: {found[0]}")
    return las_points(blob_scan(spark, root, "*.[lL][aA][sS]")).unionByName(csv_points(spark, root))


def synthetic_points(spark: SparkSession, n: int = 200, seed: int = 0) -> DataFrame:
    """``n`` standard-normal points."""
    return spark.range(n).select(
        F.lit("synthetic").alias("cloud_id"),
        F.col("id").alias("point_id"),
        F.randn(seed).alias("x"),
        F.randn(seed + 1).alias("y"),
        F.randn(seed + 2).alias("z"),
    )
