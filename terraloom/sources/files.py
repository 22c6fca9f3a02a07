"""File listings, blobs and landed files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..schemas import BLOB


def blob_scan(spark: SparkSession, root: str, name_glob: str | None = None, recursive: bool = True) -> DataFrame:
    """One row per file with its bytes; ``content`` is only read where it is used."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(root)


def list_files(spark: SparkSession, root: str, key_glob: str | None = None, cross_slash: bool = True) -> DataFrame:
    """Paths, sizes and times below ``root``; bytes are never read. A folder that is not there has no files.

    ``key_glob`` is matched on the path below ``root``; ``*`` crosses ``/`` as in an
    object store unless ``cross_slash`` is off.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    filesystem = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not filesystem.exists(folder):
        return spark.createDataFrame([], BLOB).select("path", "length", "modificationTime")
    files = blob_scan(spark, root).select("path", "length", "modificationTime")
    if key_glob:
        base = filesystem.makeQualified(folder).toString().rstrip("/") + "/"
        key = F.when(F.col("path").startswith(base), F.substring("path", len(base) + 1, 1 << 30)).otherwise(paths.basename("path"))
        files = files.where(key.rlike(paths.glob_regex(key_glob, cross_slash)))
    return files


def allow_extensions(files: DataFrame, allowed: tuple[str, ...] = (".las", ".csv"), path: str = "path") -> DataFrame:
    """Keep files with one of the extensions, in any case."""
    return files.where(paths.extension(path).isin(*allowed))


def land_files(blobs: DataFrame, dest: str, allowed: tuple[str, ...] | None = None) -> DataFrame:
    """Give every source file an id and a landed path ``{dest}/{stamp}_{id}/{name}``.

    The id and the stamp are not repeatable: write the result with
    ``write_landed`` (or ``materialize``) before using it more than once.
    """
    if allowed:
        blobs = allow_extensions(blobs, allowed)
    return (
        blobs.withColumnRenamed("path", "source_path")
        .withColumns(
            {
                "file_id": F.uuid(),
                "filename": paths.require(paths.basename("source_path"), "cannot derive a file name"),
                "ingested_at": F.current_timestamp(),
            }
        )
        .withColumn(
            "path", paths.landed_path(F.lit(dest.rstrip("/")), F.col("ingested_at"), F.col("file_id"), F.col("filename"))
        )
    )


def write_landed(landed: DataFrame, table_dir: str, batch: str | None = None) -> DataFrame:
    """Add landed files, bytes included, to a table split by batch and day; returns the batch as stored.

    Writing the same batch again replaces it.
    """
    path = f"{table_dir}/batch={batch or uuid.uuid4().hex}"
    landed.withColumn("landed_on", F.to_date("ingested_at")).write.mode("overwrite").partitionBy("landed_on").parquet(path)
    return landed.sparkSession.read.parquet(path)


def _open_fs(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def write_blobs(blobs: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Write each row's bytes to its path from the executors; one result row per written file.

    A retried task rewrites the same bytes to the same path, so the sink is idempotent.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            targets, sizes = batch["path"].to_pylist(), []
            # Bytes go out of the batch as they lie, one file at a time.
            for target, data in zip(targets, batch["content"]):
                filesystem, local = _open_fs(target)
                filesystem.create_dir(local.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(local) as out:
                    out.write(data.as_buffer())
                sizes.append(data.as_buffer().size)
            yield pa.RecordBatch.from_arrays([pa.array(targets, pa.string()), pa.array(sizes, pa.int64())], ["path", "length"])

    return blobs.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInArrow(
        put, "path string, length bigint"
    )


def read_blob_stream(spark: SparkSession, root: str, name_glob: str | None = None) -> DataFrame:
    """``blob_scan`` as a stream of newly arrived files."""
    reader = spark.readStream.format("binaryFile").schema(BLOB).option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(root)
