"""Hard negatives: scores in blocks, then a shuffle sorted by (anchor, score descending, id) whose rows open and fill windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.shards import copied, dealt, matrix, pieces, shard_counts, together
from shelfwise.session import materialize

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 50, 95
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Rows of a block, and anchors compared with it at a time.
SHARD, STEP = 16_384, 128
#: Scores beyond a long are held at its ends.
MOST = 2**63 - 1


def is_finite(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x > low) & (x < high))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def products(anchors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where every sum of it is exact, else by whole numbers, held at the ends of a long."""
    most = np.abs(anchors).max(initial=0.0) * np.abs(points).max(initial=0.0) * max(1, anchors.shape[1])
    if most < 2**53:
        return (anchors @ points.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in points]
    out = [[max(-MOST, min(MOST, sum(map(int.__mul__, a, p)))) for p in whole] for a in ([int(x) for x in row] for row in anchors)]
    return np.array(out, np.int64)


def leading(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For every line the places of its ``k`` highest allowed scores, ties to the smaller place, highest first."""
    for line, ok in zip(scores, allowed):
        places = np.flatnonzero(ok)
        if len(places) > k:
            own = line[places]
            places = places[own >= np.partition(own, len(own) - k)[len(own) - k]]
        yield places[np.argsort(-line[places].astype(np.float64) if len(places) and abs(line[places]).max() < 2**53 else [-int(x) for x in line[places]], kind="stable")][:k]


class Block:
    """The points of a shard, in the order of their identifiers."""

    def __init__(self, rows: list[pa.RecordBatch], size: int):
        table = pa.Table.from_batches(rows).combine_chunks()
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], table.column("label").to_numpy()[order]
        self.points = np.floor(SCALE * matrix(table.column("embedding").chunk(0), size))[order]


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Every block with the anchors that reach it, a few at a time, and their scores."""
    now, rows, block = None, [], None
    for key, kind, part in pieces(batches):
        if key != now:
            now, rows, block = key, [], None
        if kind == 0:
            rows.append(part)
            continue
        if block is None:
            if not rows:  # a shard that no point was dealt to
                continue
            block, rows = Block(rows, key[0]), []
        for a in range(0, part.num_rows, STEP):
            some = part.slice(a, STEP)
            yield block, some, products(np.floor(SCALE * matrix(some.column("embedding"), key[0])), block.points)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], ["anchor", "score", "vec_id"])


def mine(
    rows: DataFrame,
    anchors: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard: int = SHARD,
) -> DataFrame:
    """Hard negatives for the rows of ``rows`` (vec_id, embedding, label) that the condition ``anchors`` on vec_id picks.

    A score is the inner product of floor(256 x) of both vectors, exact; one beyond a long is held at its end. Higher
    scores come first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows of the same
    label; for each of them the first ``negatives`` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score. Rows with a null vec_id, label or vector or with null or non-finite
    components take no part, only vectors of equal length meet, and rows that are equal in identifier, label and vector
    count once; a row is never its anchor's partner if it has its vec_id. Other columns are not read. No rows give no rows.

    Anchors stream past blocks of points. A block gives each anchor only rows that could be returned: its own first
    positives, then, once the positives are known, its own first rows of every window. What is left is shuffled by anchor and
    sorted by (anchor, score descending, identifier); one pass opens a window at a positive and emits what follows in it.
    """
    sound = rows.select("vec_id", "embedding", "label").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite(F.col("embedding")))
    sound = sound.withColumn("label", F.col("label").cast("long")).dropDuplicates(["vec_id", "label", "embedding"])
    points = materialize(sound.withColumns({"size": F.size("embedding"), "asks": anchors}).withColumn("row", F.monotonically_increasing_id()))
    counts = materialize(shard_counts(points, shard))
    asking = points.where("asks").select("size", F.col("row").alias("anchor"), "vec_id", "label", "embedding")
    blocks = dealt(points.select("size", "vec_id", "label", "embedding", "row"), counts, [F.col("row")]).drop("row")

    def first_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, some, scores in _blocks(batches):
            ids, labels = (some.column(c).to_numpy()[:, None] for c in ("vec_id", "label"))
            best = leading(scores, (block.labels[None] == labels) & (block.ids[None] != ids), positives)
            yield _found([(a, int(line[i]), int(block.ids[i])) for a, line, places in zip(some.column("anchor").to_pylist(), scores, best) for i in places])

    def first_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, some, scores in _blocks(batches):
            ids, labels = (some.column(c).to_numpy()[:, None] for c in ("vec_id", "label"))
            other = (block.labels[None] != labels) & (block.ids[None] != ids)
            wanted = [sorted(set(w), reverse=True) for w in some.column("windows").to_pylist()]
            kept: list[set] = [set() for _ in wanted]
            for j in range(max(map(len, wanted), default=0)):
                # Whole numbers: 100 s >= low p and 100 s <= high p.
                floor = np.array([-(-low * w[j] // 100) if j < len(w) else MOST for w in wanted])[:, None]
                roof = np.array([high * w[j] // 100 if j < len(w) else -MOST for w in wanted])[:, None]
                for own, places in zip(kept, leading(scores, other & (scores >= floor) & (scores <= roof), negatives)):
                    own.update(places.tolist())
            yield _found([(a, int(line[i]), int(block.ids[i])) for a, line, own in zip(some.column("anchor").to_pylist(), scores, kept) for i in sorted(own)])

    shape = "anchor long, score long, vec_id long"
    near = together(counts, blocks, copied(asking, counts)).mapInArrow(first_positives, shape)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id"))
    near = materialize(near.withColumn("place", place).where(F.col("place") <= positives).drop("place"))
    windows = near.groupBy("anchor").agg(F.collect_list("score").alias("windows"))
    asked = copied(asking.join(windows, "anchor").select(*asking.columns, "windows"), counts)
    far = together(counts, blocks, asked).mapInArrow(first_negatives, shape)

    names = asking.select("anchor", F.col("vec_id").alias("anchor_id"))
    # A window is open from its own score on, so positives precede negatives of equal score.
    pairs = near.withColumn("kind", F.lit(0)).union(far.withColumn("kind", F.lit(1)))
    keyed = pairs.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "vec_id")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_windows = None, []
        for batch in batches:
            out = []
            for anchor, score, vec_id, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != now:
                    now, open_windows = anchor, []
                if kind == 0:
                    open_windows.append([vec_id, score, 0])
                    continue
                for window in open_windows:
                    if window[2] < negatives and low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], vec_id, window[1], score))
            if out:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    found = keyed.mapInArrow(emit, "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return found.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
