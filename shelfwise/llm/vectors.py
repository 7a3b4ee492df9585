"""Near duplicates among embeddings: a graph index per shard, audited searches of every shard, exact cosines, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.hnsw import Graph
from shelfwise.session import materialize

COSINE = 0.98
#: Distinct vectors of one index shard, and of one block of queries.
SHARD, QUERIES = 16_384, 16_384
#: Width of a search, the share of queries that is audited (one in so many), and of their links that must be found.
BEAM, AUDIT, RECALL = 64, 20, 0.99
#: A beam wider than this costs more than a comparison with the whole shard.
WIDEST = 512
#: Room left for rounding when candidates are told from single-precision products.
MARGIN = 1e-4


#: In place of a partner: the row tells what its node found, or by which its node was found.
FOUND, FOUND_BY = -1, -2


def is_sound(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x > low) & (x < high))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as rows, in double precision."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosines(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Products of unit vectors, each summed by itself: a matrix product rounds a row by its place among the others, so a
    link at the threshold could be seen from one end only."""
    return (rows * vector).sum(axis=1)


def searched(graph: Graph, queries: np.ndarray, floor: float, beam: int) -> list[np.ndarray]:
    """For every query the nodes of similarity ``floor`` or more that the graph leads to, ascending. A beam that is full of
    them is doubled, as more may lie beyond it, and a query with more than ``WIDEST`` is compared with every node."""
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    todo = np.arange(len(queries))
    while len(todo):
        ids, sims = graph.search(queries[todo], min(beam, len(graph.points)))
        near = (sims >= floor) & (ids >= 0)
        for i, own, hit in zip(todo.tolist(), ids, near):
            found[i] = np.sort(own[hit])
        todo = todo[near.all(axis=1)] if beam < len(graph.points) else todo[:0]
        beam *= 2
        if beam > WIDEST:
            for i, own in zip(todo.tolist(), compared(graph, queries[todo], floor)):
                found[i] = own
            break
    return found


def compared(graph: Graph, queries: np.ndarray, floor: float) -> list[np.ndarray]:
    """The same by comparison with every node."""
    parts = [queries[a : a + 256] @ graph.points.T >= floor for a in range(0, len(queries), 256)]
    return [np.flatnonzero(hit) for part in parts for hit in part]


def audited_search(graph: Graph, queries: np.ndarray, least: float, beam: int = BEAM) -> list[np.ndarray]:
    """For every query the nodes that may reach ``least``, ascending, as the graph finds them.

    Every ``AUDIT``-th query is compared with all nodes and keeps what that finds. Where the graph found a smaller share of
    their links than ``RECALL``, the beams of all queries start twice as wide, up to ``WIDEST``; if that fails the audit
    too, the graph does not hold together and all queries are compared.
    """
    floor = least - MARGIN
    audited = np.arange(0, len(queries), AUDIT)
    true = compared(graph, queries[audited], floor)
    links = sum(map(len, true))
    while True:
        found = searched(graph, queries, floor, beam)
        hits = sum(len(np.intersect1d(found[i], own, assume_unique=True)) for i, own in zip(audited, true))
        if hits >= RECALL * links:
            for i, own in zip(audited, true):
                found[i] = own
            return found
        beam *= 2
        if beam > min(WIDEST, 2 * len(graph.points)):
            return compared(graph, queries, floor)


def pair_marks(a: int, others: np.ndarray) -> np.ndarray:
    """A hash of each pair of a node and another, the same from both ends."""
    with np.errstate(over="ignore"):
        low, high = np.minimum(others, a).astype(np.uint64), np.maximum(others, a).astype(np.uint64)
        x = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))).view(np.int64)


def near_vectors(rows: DataFrame, least: float = COSINE, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two vectors link if their labels and lengths are equal, the label is not null and their cosine in double precision is
    at least ``least``. Vectors that are null, zero or hold null or non-finite components, and those with a null label,
    link with nothing. Every row is a vector of its own, so equal rows link with each other. ``component_id`` is the
    smallest vec_id reached by links (null if all are null), ``kept`` whether the row's own is it. Equal vectors of a
    label are one node with a weight; no pair of them is written, and of the links of a block only a spanning forest.
    Other columns are not read. No rows give no rows.

    Links are found by the graphs. A link is looked for from both ends; each end keeps an exclusive-or of the hashes of its
    pairs, those it found and those it was found in, and nodes where the two differ are compared with every node, so that a
    link that one end missed counts for both.
    """
    sound = rows.select("vec_id", "embedding", "label", is_sound(F.col("embedding")).alias("sound"))
    sound = sound.withColumn("sound", F.col("sound") & F.col("label").isNotNull())
    keys = [F.xxhash64(F.lit(i), "embedding").alias(f"h{i}") for i in (1, 2)]
    size = F.size("embedding").alias("size")
    grouped = sound.where("sound").groupBy("label", size, *keys)
    nodes = grouped.agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least_id"))
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()))
    totals = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("total"))
    dealt = nodes.join(totals, ["label", "size"])
    for name, each, seed in (("shard", shard, 11), ("block", queries, 12)):
        parts = F.ceil(F.col("total") / each).cast("int")
        dealt = dealt.withColumn(f"{name}s", parts).withColumn(name, F.pmod(F.xxhash64(F.lit(seed), "h1", "h2"), F.col(f"{name}s")).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("h1").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        graph = Graph(unit(_matrix(group.column("embedding"))).astype(np.float32))
        ids = group.column("nid").to_numpy().astype("<i8").tobytes()
        weights = group.column("weight").to_numpy().astype("<i8").tobytes()
        exact = _matrix(group.column("embedding"))
        single = exact.astype(np.float32)  # half as long, where nothing is lost by it
        exact = (single if (single == exact).all() else exact).tobytes()
        first = [group.column(c)[:1] for c in ("label", "size", "shard")]
        blobs = [pa.array([x], pa.binary()) for x in (graph.dump(), ids, weights, exact)]
        return pa.Table.from_arrays([*first, *blobs], ["label", "size", "shard", "graph", "ids", "weights", "exact"])

    label = f"label {dict(nodes.dtypes)['label']}"
    shape = f"{label}, size int, shard int, graph binary, ids binary, weights binary, exact binary"
    members = dealt.select("label", "size", "shard", "nid", "h1", "weight", "embedding")
    index = materialize(members.groupBy("label", "size", "shard").applyInArrow(build, shape))

    def answer(group: pa.Table, own: pa.Table, find) -> pa.Table:
        if not group.num_rows or not own.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=["a", "b", "n", "mark"])
        graph = Graph.load(own.column("graph")[0].as_py())
        ids, weights = (np.frombuffer(own.column(c)[0].as_py(), "<i8") for c in ("ids", "weights"))
        asked, raw = unit(_matrix(group.column("embedding"))), own.column("exact")[0].as_py()
        exact = unit(np.frombuffer(raw, np.float64 if len(raw) == 8 * asked.shape[1] * len(ids) else np.float32).reshape(len(ids), -1).astype(np.float64))
        names = group.column("nid").to_numpy()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        found_by = np.zeros(len(ids), np.int64)
        counts, links = [], []
        for name, vector, near in zip(names.tolist(), asked, find(graph, asked.astype(np.float32), least), strict=True):
            near = near[(cosines(exact[near], vector) >= least) & (ids[near] != name)]
            marks = pair_marks(name, ids[near])
            found_by[near] ^= marks
            counts.append((name, FOUND, int(weights[near].sum()), int(np.bitwise_xor.reduce(marks, initial=0))))
            for other in ids[near].tolist():
                a, b = root(name), root(other)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((name, other, 0, 0))
        counts += [(int(ids[i]), FOUND_BY, 0, int(found_by[i])) for i in np.flatnonzero(found_by)]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*(counts + links))], names=["a", "b", "n", "mark"])

    upto = F.sequence(F.lit(0), F.col("parts") - 1)
    blocks = dealt.groupBy("label", "size").agg(F.max("blocks").alias("parts"))
    asked = index.join(blocks, ["label", "size"]).withColumn("block", F.explode(upto)).drop("parts")
    by = ["label", "size", "shard", "block"]

    def ask(queries: DataFrame, find) -> DataFrame:
        asking = queries.select("label", "size", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "nid", "embedding")
        found = asking.groupBy(*by).cogroup(asked.groupBy(*by))
        return materialize(found.applyInArrow(lambda group, own: answer(group, own, find), "a long, b long, n long, mark long"))

    found = ask(dealt, audited_search)
    ends = found.where("b < 0").groupBy("a").agg(
        F.sum("n").alias("linked"), *[F.coalesce(F.bit_xor(F.when(F.col("b") == end, F.col("mark"))), F.lit(0)).alias(name) for end, name in ((FOUND, "out"), (FOUND_BY, "into"))]
    )
    ends = materialize(ends)
    linked, pairs = ends.select("a", "linked"), found.where("b >= 0").select("a", "b")
    missed = ends.where("out != into").select("a")
    if not missed.isEmpty():
        again = ask(dealt.join(missed, F.col("nid") == F.col("a"), "left_semi"), lambda graph, queries, least: compared(graph, queries, least - MARGIN))
        linked = linked.join(missed, "a", "left_anti").union(again.where(F.col("b") == FOUND).groupBy("a").agg(F.sum("n")))
        pairs = pairs.union(again.where("b >= 0").select("a", "b"))
    reached = components(pairs)

    node = nodes.select("nid", "label", "size", "h1", "h2", "weight", "least_id")
    node = node.join(linked, F.col("nid") == F.col("a"), "left").join(reached, F.col("nid") == F.col("node"), "left")
    node = node.withColumn("component", F.coalesce("component", "nid"))
    least_id = node.groupBy("component").agg(F.min("least_id").alias("component_id"))
    links = (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    node = node.join(least_id, "component").select("label", "size", "h1", "h2", links, "component_id")
    linked_rows = sound.where("sound").select("vec_id", "label", size, *keys).join(node, ["label", "size", "h1", "h2"])
    alone = sound.where("not sound or sound is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked_rows.select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
