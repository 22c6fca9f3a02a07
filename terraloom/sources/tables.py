"""Table scans and sinks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MATCH

TILE_COLUMNS = {"tile_id", "min_x", "min_y", "max_x", "max_y"}
PATCH_BOUNDS = ("patch_min_x", "patch_min_y", "patch_max_x", "patch_max_y")


def require_columns(df: DataFrame, needed: set[str], what: str) -> DataFrame:
    """Check the columns of a table without running a job."""
    missing = sorted(needed - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(spark.read.parquet(path), TILE_COLUMNS, "tile index")


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(spark.read.parquet(path), {"embedding"}, "patch table")


def read_matches_csv(spark: SparkSession, path: str) -> DataFrame:
    """Result CSV with trimmed fields; numbers that do not parse become NULL, empty stays NULL.

    Columns are found by their header names, so their order does not matter.
    """
    raw = (
        spark.read.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .csv(path)
    )
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    fields = [f.strip().split() for f in MATCH.split(",")]
    return raw.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in fields if name in raw.columns])


def write_table(df: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Parquet table, split into folders by ``by`` where given; returns the table as read back."""
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Steps per axis of the curve that ``write_by_place`` follows: 2 to this power.
CURVE_BITS = 16


def _spread(value: Column) -> Column:
    """The lowest 16 bits of a whole number, each followed by a free bit."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return value


def curve_key(x: Column, y: Column, low: tuple[float, float], high: tuple[float, float]) -> Column:
    """Place of a point on a Z-shaped curve through the plane between two corners; neighbours on it are mostly neighbours in space.

    Points outside count as on the edge; null and NaN coordinates give null.
    """
    steps = []
    for value, a, b in zip((x, y), low, high):
        part = (value - F.lit(float(a))) / F.lit(float(b - a)) if b > a else value * 0
        inside = F.greatest(F.least(part, F.lit(1.0)), F.lit(0.0))
        steps.append(F.when(~F.isnan(value), F.floor(inside * ((1 << CURVE_BITS) - 1)).cast("bigint")))
    return _spread(steps[0]).bitwiseOR(F.shiftleft(_spread(steps[1]), 1))


def write_by_place(df: DataFrame, path: str, bounds: tuple[str, str, str, str], files: int | None = None, group_bytes: int = 16 << 20,
                   mode: str = "overwrite") -> DataFrame:
    """Parquet table whose rows follow a space-filling curve through the centres of their boxes; returns it as read back.

    Each file and row group then covers a small area, so that ``in_window`` skips most of
    them by their statistics. One shuffle by range, into ``files`` files where given. Rows without bounds come first.
    """
    x, y = (F.col(bounds[k]) / 2 + F.col(bounds[k + 2]) / 2 for k in (0, 1))
    ends = df.agg(*[f(c) for f in (F.min, F.max) for c in (F.nanvl(x, F.lit(None)), F.nanvl(y, F.lit(None)))]).first()
    low, high = (tuple(0.0 if v is None else v for v in ends[k : k + 2]) for k in (0, 2))
    placed = df.withColumn("_place", curve_key(x, y, low, high))
    parts = placed.repartitionByRange(files, "_place") if files else placed.repartitionByRange("_place")
    parts.sortWithinPartitions("_place").drop("_place").write.mode(mode).option("parquet.block.size", group_bytes).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_window(boxes: DataFrame, window: tuple[float, float, float, float], bounds: tuple[str, str, str, str]) -> DataFrame:
    """Boxes that share area with the window (lower x, lower y, upper x, upper y), as comparisons that reach the scan."""
    min_x, min_y, max_x, max_y = (F.col(b) for b in bounds)
    x0, y0, x1, y1 = (float(v) for v in window)
    return boxes.where((min_x < x1) & (max_x > x0) & (min_y < y1) & (max_y > y0))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_results(matches: DataFrame, path: str) -> DataFrame:
    """Match table with its CSV twin beside it; the search runs once."""
    table = write_table(matches, path)
    twin = path[: -len(".parquet")] + ".csv" if path.endswith(".parquet") else path + ".csv"
    write_csv(table, twin)
    return table


def write_json_summary(one_row: DataFrame, path: str) -> None:
    """One-row summary as JSON."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def publish(df: DataFrame, table_dir: str, batch: str) -> None:
    """Put ``df`` into a table of batches, to be seen whole or not at all.

    Rows go to a folder of their own first; then one small entry that names it is put into place by a rename. A run that
    fails before leaves nothing that readers see, and a batch published again takes the place of its earlier rows and of no others.
    Readers at work keep the folders they started with; nothing is deleted.
    """
    if not batch or any(c in batch for c in "\n\r\t"):
        raise ValueError(f"not a batch name: {batch!r}")
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{table_dir}/{folder}")
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    entries = path(f"{table_dir}/entries")
    system = entries.getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(entries)
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    staged = path(entries, f"_{name}")
    with_entry = system.create(staged, False)
    with_entry.write(bytearray(f"{name}\t{batch}\t{folder}\n".encode()))
    with_entry.close()
    if not system.rename(staged, path(entries, name)):
        raise OSError(f"cannot publish {batch} in {table_dir}")


def published(spark: SparkSession, table_dir: str) -> dict[str, str]:
    """Folder of each batch of a published table, by the last entry that names it."""
    cells = F.split("value", "\t")
    entries = spark.read.text(f"{table_dir}/entries").select(cells[0].alias("name"), cells[1].alias("batch"), cells[2].alias("folder"))
    return {r.batch: f"{table_dir}/{r.folder}" for r in entries.groupBy("batch").agg(F.max_by("folder", "name").alias("folder")).collect()}


def read_published(spark: SparkSession, table_dir: str) -> DataFrame:
    """All rows of the batches that were published, with columns by name."""
    folders = sorted(published(spark, table_dir).values())
    return spark.read.option("mergeSchema", "true").parquet(*folders)


def create_table(spark: SparkSession, name: str, ddl: str, replace: bool = True) -> None:
    """Create an empty catalog table with required and optional fields; a table of that name is replaced, or kept with its rows."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name; a table format with its own writer takes the same call."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)
