"""Incremental landing and event rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import catalog, raster
from ..sources import files, rasters


def incremental_land(spark: SparkSession, root: str, table_dir: str, checkpoint: str, name_glob: str = "*.tif*") -> None:
    """Catalog the files that arrived since the last call: headers, quarantine and log, once per path.

    Each batch goes to its own folder, so a replayed batch replaces what it wrote before.
    """
    arrived = files.read_blob_stream(spark, root, name_glob)
    headers = rasters.raster_headers(arrived)

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good, bad = raster.validate(batch)
        for name, part in (
            ("headers", good),
            ("quarantine", bad.withColumn("errors", F.concat_ws("; ", "errors"))),
            ("log", catalog.ingest_log(good, bad)),
        ):
            part.write.mode("overwrite").parquet(f"{table_dir}/{name}/batch={number}")
        batch.unpersist()

    query = (
        headers.withColumn("filename", paths.basename("path"))
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()


def event_rate(events: DataFrame, label: str = "event_type", ts: str = "ts", window: str = "5 minutes",
               delay: str | None = "10 minutes") -> DataFrame:
    """Events per second of each label and window; streams hold state until ``delay`` has passed.

    Works on tables and on streams. Counting is partial per task, so a hot label
    shuffles one row per task and window.
    """
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming and delay:
        timed = timed.withWatermark("_ts", delay)
    counted = timed.groupBy(F.window("_ts", window).alias("w"), label).agg(F.count("*").alias("events"))
    seconds = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    return counted.select(
        label,
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "events",
        (F.col("events") / seconds).alias("per_second"),
    )


def newest_sample(events: DataFrame, label: str = "event_type", ts: str = "ts", value: str = "value",
                  tie: str = "event_id") -> DataFrame:
    """Latest value per label."""
    newest = F.max_by(F.struct(ts, value), F.struct(ts, tie)).alias("n")
    return events.groupBy(label).agg(newest).select(label, F.col(f"n.{ts}").alias(ts), F.col(f"n.{value}").alias(value))


def newest_samples(stream: DataFrame, out_dir: str, checkpoint: str, label: str = "event_type", ts: str = "ts", value: str = "value",
                   tie: str = "event_id", window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Latest value per label of all that a stream has brought so far, over any number of runs with the same folders.

    The stream keeps one row per label and window and forgets a window once it ended ``delay`` before the newest time
    seen, so state is bounded by the labels of the last windows. Rows that come later than that for a forgotten window
    are left out, and rows without a time always; others count whatever their order. A task reduces its rows first, so a hot label
    sends one row per task and window. Each micro-batch is a folder of its own, written anew when it is repeated.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    newest = timed.groupBy(F.window("_ts", window), label).agg(F.max_by(F.struct(ts, value, tie), F.struct(ts, tie)).alias("n")).select(label, "n.*")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    newest.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(store).start().awaitTermination()
    return newest_sample(stream.sparkSession.read.schema(newest.schema).parquet(out_dir), label, ts, value, tie)


def run_to_table(stream: DataFrame, out_dir: str, checkpoint: str) -> DataFrame:
    """Drain what a stream has available into a table and return the table."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out_dir)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out_dir)
