"""Nearest neighbours by a permutation index: vectors as orders of their nearest pivots, inverted files of the pivots,
candidates by footrule distance, exact distances for the candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.shards import copied, dealt, matrix, pieces, shard_counts, together
from shelfwise.llm.vectors import is_sound
from shelfwise.session import materialize

#: Pivots drawn from the vectors of a length (the index is fitted on this sample alone), and how many of them, the
#: nearest ones, stand for a vector.
PIVOTS, PREFIX = 256, 64
#: Vectors of a shard.
SHARD = 8192
#: Queries of each vector length whose true neighbours are worked out to choose the depth.
AUDITED = 128
#: Share of the audited true neighbours that must come within the depth, and the room added to it.
TARGET, ROOM = 0.99, 1.25
#: Queries answered together inside a task.
STEP = 256


def distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; differences too large or small to square are scaled first."""
    gaps = points - query
    with np.errstate(over="ignore", under="ignore"):
        squares = (gaps * gaps).sum(axis=1)
    out = np.sqrt(squares)
    for row in np.flatnonzero((squares < 1e-280) | (squares > 1e280)):
        most = np.abs(gaps[row]).max(initial=0.0)
        out[row] = most and np.sqrt(((gaps[row] / most) ** 2).sum()) * most
    return out


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For every vector its ``prefix`` nearest pivots, nearest first."""
    with np.errstate(all="ignore"):
        apart = (pivots * pivots).sum(axis=1)[None] - 2 * (vectors @ pivots.T)
    return np.argsort(apart, axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Per pivot the vectors of a shard that have it in their order, with their places.

    With orders cut at m places, and absent pivots taken to stand at place m, the footrule distance of two orders is
    m(m+1) - 2 * (sum over shared pivots of min(m - place in one, m - place in the other)); the sum is the ``gain``.
    """

    def __init__(self, points: np.ndarray, pivots: np.ndarray, prefix: int):
        self.points, self.pivots = points, pivots
        self.prefix = min(prefix, len(pivots))
        orders = nearest_pivots(points, pivots, self.prefix)
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.members = by_pivot // self.prefix
        self.worth = (self.prefix - by_pivot % self.prefix).astype(np.int32)
        self.begin = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))

    def gains(self, order: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.points), np.int32)
        for place, pivot in enumerate(order.tolist()):
            a, b = self.begin[pivot], self.begin[pivot + 1]
            out[self.members[a:b]] += np.minimum(self.worth[a:b], self.prefix - place)
        return out

    def candidates(self, order: np.ndarray, depth: int) -> np.ndarray:
        """The ``depth`` points of least footrule distance, and all that tie with the last of them."""
        gains = self.gains(order)
        if depth >= len(gains):
            return np.arange(len(gains))
        return np.flatnonzero(gains >= np.partition(gains, len(gains) - depth)[len(gains) - depth])


def _shards(batches: Iterator[pa.RecordBatch], prefix: int):
    """The index of each shard with the row identifiers of its points, and the asking rows that reach it."""
    now, pivots, points, index, ids = None, [], [], None, None
    for key, kind, rows in pieces(batches):
        if key != now:
            now, pivots, points, index = key, [], [], None
        if kind == 0:
            pivots.append(matrix(rows.column("embedding"), key[0]))
        elif kind == 1:
            points.append(rows)
        else:
            if index is None:
                if not points:  # a shard that no point was dealt to
                    continue
                vectors = np.concatenate([matrix(p.column("embedding"), key[0]) for p in points])
                index = InvertedFiles(vectors, np.concatenate(pivots), prefix)
                ids = [x for p in points for x in p.column("ids").to_pylist()]
                points = []
            for a in range(0, rows.num_rows, STEP):
                part = rows.slice(a, STEP)
                asked = matrix(part.column("embedding"), key[0])
                yield index, ids, part, asked, nearest_pivots(asked, index.pivots, index.prefix)


def _first(found: np.ndarray, apart: np.ndarray, ids: list[list[int]], most: int) -> list[tuple[float, int, int]]:
    """(distance, row identifier, point) of the first ``most`` rows: by distance, then by identifier."""
    if len(apart) > most:
        near = apart <= np.partition(apart, most - 1)[most - 1]
        found, apart = found[near], apart[near]
    rows = [(d, i, p) for d, p in zip(apart.tolist(), found.tolist()) for i in ids[p]]
    return sorted(rows)[:most]


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))


def nodes_of(rows: DataFrame, wanted: Column, most: int) -> DataFrame:
    """Distinct vectors: ``nid``, ``size``, ``embedding``, ``ids`` (the ``most`` smallest vec_ids, ascending) and ``asks``
    (whether one of its rows is wanted). More identifiers of one vector can never be among the nearest."""
    keys = ["size", "h1", "h2"]
    hashed = rows.select("vec_id", "embedding", F.size("embedding").alias("size"), *[F.xxhash64(F.lit(i), "embedding").alias(f"h{i}") for i in (1, 2)])
    apart = hashed.groupBy(*keys, "vec_id").agg(F.first("embedding").alias("embedding"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
    kept = apart.withColumn("place", place).where(F.col("place") <= most)
    asks = hashed.where(wanted).select(*keys).distinct().withColumn("asks", F.lit(True))
    nodes = kept.groupBy(*keys).agg(F.first("embedding").alias("embedding"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = nodes.join(asks, keys, "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    return materialize(nodes.withColumn("nid", F.monotonically_increasing_id()))


def nearest(
    rows: DataFrame,
    wanted: Column,
    k: int = 10,
    *,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    shard: int = SHARD,
    audited: int = AUDITED,
    target: float = TARGET,
) -> DataFrame:
    """The ``k`` nearest rows of every row of ``rows`` (vec_id, embedding) that ``wanted`` picks.

    ``wanted`` is a condition on vec_id. Result: query_id, rank (from 1), vec_id, score (Euclidean distance in double
    precision), ties to the smaller vec_id, all candidates if there are fewer than ``k``. Candidates are all rows with
    another vec_id and a vector of the same length. Rows with a null vec_id, and vectors that are null, zero or hold
    null or non-finite components, take no part; rows equal in identifier and vector count once. Other columns are not
    read. No rows give no rows.

    Every vector is indexed. How deep the footrule order of a shard is searched is a share of the shard, chosen so that
    ``target`` of the true neighbours of ``audited`` queries, found by comparing those with every vector, lie within it.
    """
    sound = rows.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & is_sound(F.col("embedding")))
    nodes = nodes_of(sound, wanted, k + 1)
    counts = materialize(shard_counts(nodes, shard))
    drawn = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64(F.lit(31), "nid"), "nid"))
    chosen = materialize(nodes.select("size", "nid", "embedding").withColumn("place", drawn).where(F.col("place") <= pivots).drop("place"))
    points = dealt(nodes.select("size", "nid", "embedding", "ids"), counts, [F.col("nid")])
    asking = nodes.where("asks").select("size", "nid", "embedding")

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, ids, part, asked, orders in _shards(batches, prefix):
            out = []
            for nid, size, vector, order in zip(part.column("nid").to_pylist(), part.column("size").to_pylist(), asked, orders):
                gained = index.gains(order)
                gains = np.sort(gained)
                for d, i, p in _first(np.arange(len(ids)), distances(index.points, vector), ids, k + 1):
                    ahead = len(gains) - np.searchsorted(gains, gained[p], "right")
                    out.append((size, nid, d, i, (ahead + 1) / len(gains)))
            yield _batch(out, size=pa.int32(), nid=pa.int64(), score=pa.float64(), vec_id=pa.int64(), share=pa.float64())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, ids, part, asked, orders in _shards(batches, prefix):
            out = []
            for nid, share, vector, order in zip(part.column("nid").to_pylist(), part.column("share").to_pylist(), asked, orders):
                found = index.candidates(order, max(k + 1, int(np.ceil(share * len(index.points)))))
                out += [(nid, d, i) for d, i, _ in _first(found, distances(index.points[found], vector), ids, k + 1)]
            yield _batch(out, nid=pa.int64(), score=pa.float64(), vec_id=pa.int64())

    by_distance = Window.partitionBy("nid").orderBy("score", "vec_id")
    tried = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64(F.lit(37), "nid"), "nid"))
    sample = asking.withColumn("place", tried).where(F.col("place") <= audited).drop("place")
    checked = together(counts, copied(chosen, counts), points, copied(sample, counts)).mapInArrow(audit, "size int, nid long, score double, vec_id long, share double")
    true = checked.withColumn("place", F.row_number().over(by_distance)).where(F.col("place") <= k + 1)
    depth = true.groupBy("size").agg(F.least(F.lit(1.0), F.lit(ROOM) * F.percentile("share", F.lit(target))).alias("share"))
    depth = materialize(depth)

    asked = copied(asking.join(depth, "size"), counts)
    found = together(counts, copied(chosen, counts), points, asked).mapInArrow(search, "nid long, score double, vec_id long")
    best = found.withColumn("place", F.row_number().over(by_distance)).where(F.col("place") <= k + 1).drop("place")
    best = materialize(best)
    queries = sound.where(wanted).select(F.col("vec_id").alias("query_id"), F.size("embedding").alias("size"), *[F.xxhash64(F.lit(i), "embedding").alias(f"h{i}") for i in (1, 2)]).distinct()
    named = queries.join(nodes.select("size", "h1", "h2", "nid"), ["size", "h1", "h2"]).select("query_id", "nid")
    mine = named.join(best, "nid").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "nid").orderBy("score", "vec_id"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
