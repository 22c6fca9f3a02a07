"""Work on the members of many keys, hot ones included, in tasks of bounded size.

Members of a key are dealt into chunks; every pair of chunks is a block of its own, so a
hot key becomes many blocks that spread over the cluster, and no task holds more than two
chunks of one key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a chunk.
CHUNK = 768


def deal(members: DataFrame, key: str, count: str, item: str, chunk: int = CHUNK) -> DataFrame:
    """``members`` once per block they belong to, with ``block``, ``two`` and ``side``.

    ``count`` holds the members of the row's key. A key of up to ``chunk`` members is one
    block. Else the rows of chunk i go to the blocks of i with every j; ``two`` tells
    whether a block holds two chunks, and ``side`` which of them a row belongs to.
    """
    n = F.ceil(F.col(count) / chunk)
    own = F.pmod(F.xxhash64(item, F.lit(5)), n)
    others = F.when(n > 1, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array(F.lit(0).cast("bigint")))
    dealt = members.withColumn("_own", F.when(n > 1, own).otherwise(F.lit(0))).withColumn("_other", F.explode(others))
    dealt = dealt.withColumn("two", F.col("_own") != F.col("_other"))
    return dealt.withColumn("side", (F.col("_own") > F.col("_other")).cast("int")).withColumn(
        "block", F.xxhash64(F.col(key), F.least("_own", "_other"), F.greatest("_own", "_other"))
    ).drop("_own", "_other")


def by_block(rows: DataFrame, order: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``work`` to all rows of each ``block`` together, ordered by ``order`` inside.

    Blocks are shuffled and sorted by name and cut out of the Arrow batches as they come; at
    most one block waits for its end in the next batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish():
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            out = work(table.to_batches()[0])
            return [out] if out is not None and out.num_rows else []

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            if held and held[-1].column("block")[-1].as_py() != names[0]:
                yield from finish()
            for a, b in zip(edges[:-1], edges[1:]):
                held.append(batch.slice(a, b - a))
                if b < len(names):
                    yield from finish()
        if held:
            yield from finish()

    return rows.repartition("block").sortWithinPartitions("block", order).mapInArrow(run, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component under the links a-b, by label spreading and pointer jumping."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = np.minimum(new, new[label])
        if np.array_equal(new, label):
            return label
        label = new


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)
