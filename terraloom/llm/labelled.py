"""What the trained classifiers share: held-out rows, the bounded training sample, running a scorer."""

from __future__ import annotations

import logging
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

log = logging.getLogger(__name__)


def held_out(doc_id: Column | str) -> Column:
    """Rows never learned from: crc32 of the id's text leaves remainder 0 by 5. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_texts(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``y, order, text`` of at most ``rows`` labelled documents that are not held out.

    The labels with the smallest seeded hash are taken, so the choice is the same in
    every run and does not depend on order or partitions. Labels other than 0 and 1 and
    null ids are left out; an id labelled both ways counts once for each. Of several rows
    under a chosen id one is taken, the one whose text has the smallest hash.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("_id")).distinct()
    order = F.xxhash64(F.lit(label), F.col("_id").cast("string"), F.col("y"))
    chosen = known.withColumn("order", order).orderBy("order", "_id", "y").limit(rows)
    texts = documents.select(F.col("doc_id").alias("_id"), "text")
    texts = texts.join(F.broadcast(chosen), "_id").select("_id", "y", "order", F.coalesce("text", F.lit("")).alias("text"))
    one = texts.groupBy("_id", "y", "order").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return one.select("y", "order", F.col("one.text").alias("text"))


def gather_sample(texts: DataFrame, encode: Callable[[pa.Array], list[np.ndarray]], values: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and encoded texts of the sample on the driver, in hash order, of at most ``values`` numbers in all.

    Texts are encoded whole, on the executors; both the rows and the numbers gathered are
    bounded. A text that does not fit any more is left out and shorter ones after it are
    still taken; if none fits, the shortest is taken. The rows used are logged.
    """

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                coded = [np.ascontiguousarray(x) for x in encode(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), part.column("order"), pa.array([x.tobytes() for x in coded], pa.large_binary()).cast(pa.binary()),
                     pa.array([x.size for x in coded], pa.int64())],
                    names=["y", "order", "code", "n"],
                )

    coded = materialize(texts.mapInArrow(run, "y int, order long, code binary, n long"), "sample")
    sizes = coded.select("order", "n", "y").orderBy("order", "y", "n").collect()
    if not sizes:
        return np.zeros(0, np.int32), []
    total, left_out = 0, []
    for row in sizes:
        if total + row.n > values:
            left_out.append(row.order)
        else:
            total += row.n
    if len(left_out) == len(sizes):
        left_out.remove(min(sizes, key=lambda row: row.n).order)
    used = coded.where(~F.col("order").isin(left_out)) if left_out else coded
    rows = used.orderBy("order", "y", "n").collect()
    log.log(
        logging.WARNING if left_out else logging.INFO, "fitted on %d of %d labelled rows; %d did not fit into %d values",
        len(rows), len(sizes), len(left_out), values,
    )
    return np.array([r.y for r in rows], np.int32), [np.frombuffer(r.code, np.uint32) for r in rows]


def score_texts(documents: DataFrame, scorer: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Every row of ``documents`` as it is, with ``score`` computed from its whole text alone.

    ``score`` replaces an input column of that name.
    """
    kept = [c for c in documents.columns if c != "score"]
    schema = documents.select(*kept).schema.add("score", "double")

    def run(batches):
        for batch in batches:
            scores = scorer(batch.column("text")) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(scores, pa.float64())], names=[*kept, "score"]
            )

    return documents.select(*kept).mapInArrow(run, schema)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins of rows the model has not seen."""
    target = np.where(y == 1, (np.sum(y == 1) + 1.0) / (np.sum(y == 1) + 2.0), 1.0 / (np.sum(y == 0) + 2.0))
    x = np.stack([margin, np.ones_like(margin)], 1)
    ab = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(x @ ab)
        hess = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - target) + 1e-6 * ab)
        ab -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(ab[0], 1e-3)), float(ab[1])
