"""Connected components by alternating star operations, each a pair of aggregations and equi-joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize


#: Nodes whose links a task joins before it passes them on.
HELD = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links that a task holds by one link from each node to the smallest it reaches through them, for about
    ``HELD`` nodes at a time."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def stars() -> Iterator[pa.RecordBatch]:
        links = [(x, root(x)) for x in list(parent)]
        links = [(x, r) for x, r in links if x != r]
        parent.clear()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > HELD:
            yield from stars()
    yield from stars()


def _stars(links: DataFrame, *, large: bool) -> DataFrame:
    """Link the larger (or, in the small step, the smaller) neighbours of every node to its smallest neighbour."""
    ways = links.select(F.col("a").alias("u"), F.col("b").alias("v"))  # always a > b
    if large:
        ways = ways.union(ways.select(F.col("v"), F.col("u")))
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    near = ways.where("v > u") if large else ways.union(least.select("u", F.col("u").alias("v")))
    linked = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node it is linked with) for every node of ``links`` (longs a, b).

    Nodes without a link have no row; links of a node with itself and repeated links change nothing.
    """
    spark = links.sparkSession
    now = materialize(links.where("a != b").select("a", "b").mapInArrow(_forest, "a long, b long"))
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = materialize(_stars(_stars(now, large=True), large=False))
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return spark.createDataFrame([], found.schema).union(found).union(roots)
