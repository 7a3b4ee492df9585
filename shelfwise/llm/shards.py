"""Blocks of points that stay in one task while the rows asking for them stream by.

Points are dealt into shards of bounded size, asking rows are copied to every shard, and one shuffle sorted by
(size, shard, kind) brings them together: a task holds one shard and one batch of asking rows, whatever their numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("size", "shard")


def shard_counts(points: DataFrame, rows: int) -> DataFrame:
    """``size``, ``shards``: how many shards of about ``rows`` points the vectors of each length need."""
    return points.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("shards"))


def dealt(points: DataFrame, counts: DataFrame, by: Sequence[Column]) -> DataFrame:
    """Every point in one shard of its size, by a hash of ``by``."""
    return points.join(counts, "size").withColumn("shard", F.pmod(F.xxhash64(F.lit(23), *by), F.col("shards")).cast("int")).drop("shards")


def copied(asking: DataFrame, counts: DataFrame) -> DataFrame:
    """Every asking row once for each shard of its size."""
    spread = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    return asking.join(counts, "size").select(*asking.columns, spread)


def together(counts: DataFrame, *kinds: DataFrame) -> DataFrame:
    """The frames as kinds 0, 1 ... of one, each shard in one task and its kinds in order. Columns that a frame lacks are null.

    The number of tasks follows the number of shards: their bytes are few for the work in them.
    """
    shards = counts.agg(F.sum("shards")).first()[0] or 1
    out = None
    for i, df in enumerate(kinds):
        df = df.withColumn("kind", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.repartition(min(3 * shards, 20_000), *KEYS).sortWithinPartitions(*KEYS, "kind")


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """(size, shard), kind and rows, cut wherever one of them changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*KEYS, "kind")])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield (int(marks[0, a]), int(marks[1, a])), int(marks[2, a]), batch.slice(a, b - a)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of length ``size`` as rows in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)
