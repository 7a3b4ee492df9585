"""Near duplicates by weighted Jaccard similarity of shingle multisets: BagMinHash signatures, bands, exact checks.

A shingle that occurs w times has the weight interval [0, w). Points of a Poisson process rain on it at unit rate per
register, drawn from hashes so that every document sees the same points. The interval is cut at powers of two; each cut
has a process of its own, whose rate is the length of the cut, and a point counts if its place in the cut lies below w.
A register keeps the time of its first point. Two registers agree with the probability that the first point among both
documents lies in both: the weighted Jaccard similarity. Points come in order of time, and a process is dropped once its
time has passed the slowest register.

Texts that are equal are one node. Candidates are nodes that agree in all registers of a band. Only links between
different components matter, so they are checked in two rounds: each node with the best of the smallest nodes of its
bands; then, inside each band that still holds several components, all pairs in different ones. Large bands are dealt out in blocks, and only links that join components are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import fresh, give_back, giving_back, slices
from shelfwise.llm.components import components
from shelfwise.session import materialize

WORDS = 5
SIMILARITY = 0.8
REGISTERS, ROWS = 96, 4
#: Pairs whose signatures agree in a smaller share of registers are left to the second round.
LEAST_AGREEMENT = 0.6
#: Nodes of one band, and bytes of their texts, that a task compares at once with as many others.
BLOCK, BLOCK_BYTES = 2000, 8 << 20
#: Words remembered while a batch is worked on.
REMEMBERED = 50_000

_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> hash, kept as long as there is room; nothing outlives the batch that it was made for."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


def shingles(text: str, memory: WordHashes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct five-word shingles of a text, ascending, and how often each occurs.

    Words are separated by space, tab and line ends. A text of one to four words is a single shingle.
    """
    memory = WordHashes() if memory is None else memory
    words = np.array([memory[w] for w in text.encode("utf-8", "surrogatepass").split()], dtype=np.uint64)
    if not len(words):
        return words, np.zeros(0, np.int64)
    n = max(len(words) - WORDS + 1, 1)
    with np.errstate(over="ignore"):
        mixed = np.full(n, np.uint64(min(len(words), WORDS)))
        for i in range(min(len(words), WORDS)):
            mixed = mixed + words[i : n + i] * _MUL[i]
    return np.unique(_mix(mixed), return_counts=True)


def signatures(documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """First arrival times, one row of registers per document (infinite where it has no shingle)."""
    sizes = [len(s) for s, _ in documents]
    doc = np.repeat(np.arange(len(documents)), sizes)
    element = np.concatenate([s for s, _ in documents] or [np.zeros(0, np.uint64)])
    weight = np.concatenate([w for _, w in documents] or [np.zeros(0, np.int64)])
    # Cuts [0, 1), [1, 2), [2, 4), [4, 8) ... up to the one that holds the weight.
    cuts = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    cut = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    doc, element, weight = (np.repeat(x, cuts) for x in (doc, element, weight))
    low = np.where(cut > 0, 1 << np.maximum(cut - 1, 0), 0)
    length = np.maximum(low, 1)
    state = _mix(element ^ (cut.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    time = np.zeros(len(doc))
    first = np.full(len(documents) * REGISTERS, np.inf)
    while len(doc):
        with np.errstate(over="ignore"):
            state = state + np.uint64(0x9E3779B97F4A7C15)
        draw, other = _mix(state), _mix(state ^ np.uint64(0xD1B54A32D192ED03))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
        register = (other >> np.uint64(40)).astype(np.int64) % REGISTERS
        place = low + ((other & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length).astype(np.int64)
        hit = place < weight
        np.minimum.at(first, doc[hit] * REGISTERS + register[hit], time[hit])
        slowest = first.reshape(-1, REGISTERS).max(axis=1)
        on = np.flatnonzero(time < slowest[doc])
        if len(on) < len(doc):
            doc, weight, low, length, state, time = (x[on] for x in (doc, weight, low, length, state, time))
    return first.reshape(-1, REGISTERS)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def _sign(docs: DataFrame) -> DataFrame:
    """doc_id, node (digest of the text), 16-bit marks of its registers and hashes of its bands, the last two empty
    where the text has no word, and null where the same task has just given them for the node."""
    key = docs.schema["doc_id"]
    own = [T.StructField("node", T.BinaryType()), T.StructField("marks", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([key, *own])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory = WordHashes()
            for part in slices(batch):
                nodes = part.column("node").to_pylist()
                at = {n: i for i, n in reversed(list(enumerate(nodes)))}  # the first row of each node
                rows = sorted(at.values())
                texts = part.column("text").take(pa.array(rows)).to_pylist()
                found = [shingles(x or "", memory) for x in texts]
                bits = signatures(found).view(np.uint64)
                marks = (_mix(bits) >> np.uint64(48)).astype("<u2")
                grouped = bits.reshape(len(rows), -1, ROWS)
                with np.errstate(over="ignore"):
                    bands = _mix((_mix(grouped) * _MUL[:ROWS]).sum(axis=2) + np.arange(REGISTERS // ROWS, dtype=np.uint64))
                all_marks, all_bands = [None] * len(nodes), [None] * len(nodes)
                for row, shingled, mark, band in zip(rows, found, marks, bands.view(np.int64), strict=True):
                    some = len(shingled[0]) > 0
                    all_marks[row], all_bands[row] = (mark.tobytes(), band) if some else (b"", [])
                columns = [pa.array(nodes, pa.binary()), pa.array(all_marks, pa.binary()), pa.array(all_bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], schema.fieldNames())

    node = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("node")
    return docs.select("doc_id", node, "text").mapInArrow(run, schema)


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least that similar."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory = WordHashes()
            for part in slices(batch):
                kept, held = [], {}  # smaller nodes come up again and again
                for i, (b, one, two) in enumerate(zip(*(part.column(c).to_pylist() for c in ("b", "one", "two")), strict=True)):
                    if b not in held:
                        held[b] = shingles(two, memory)
                    if similarity(shingles(one, memory), held[b]) >= least:
                        kept.append(i)
                yield part.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    one = texts.select(F.col("nid").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("nid").alias("b"), F.col("text").alias("two"))
    return pairs.join(two, "b").join(one, "a").mapInArrow(run, "a long, b long")


def _agreement(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def _first_pairs(buckets: DataFrame, marks: DataFrame) -> DataFrame:
    """Each node with that smallest node of its bands whose signature is most like its own."""
    heads = buckets.groupBy("bucket").agg(F.min("nid").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = buckets.join(heads, "bucket").where("nid != b").select(F.col("nid").alias("a"), "b").distinct()

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [_agreement(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike, pa.float64())], ["a", "b", "alike"])

    x, y = (marks.select(F.col("nid").alias(n), F.col("marks").alias(m)) for n, m in (("a", "x"), ("b", "y")))
    judged = pairs.join(y, "b").join(x, "a").mapInArrow(agree, "a long, b long, alike double").where(F.col("alike") >= LEAST_AGREEMENT)
    return judged.groupBy("a").agg(F.max_by("b", F.struct("alike", -F.col("b"))).alias("b"))


def _overlap(own: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]], room: np.ndarray) -> np.ndarray:
    """Overlap of a multiset with others; elements are numbers below ``len(room)``, and ``room`` is zeros, before and after."""
    room[own[0]] = own[1]
    ends = np.cumsum([len(o[0]) for o in others])
    shared = np.minimum(room[np.concatenate([o[0] for o in others])], np.concatenate([o[1] for o in others]))
    room[own[0]] = 0
    return np.add.reduceat(shared, np.concatenate([[0], ends[:-1]]))


def _links_within(group: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links that join different components among the nodes of a band, or between two blocks of them.

    Pairs are looked at once only: in the first band whose hash they share, and while they are not joined yet. All that may
    reach ``least`` by their sizes are decided by their exact overlap.
    """
    nid, component, block = (group.column(c).to_numpy() for c in ("nid", "component", "block"))
    band, low = group.column("band")[0].as_py(), group.column("low")[0].as_py()
    earlier = np.array(group.column("bands").to_pylist(), dtype=np.int64)[:, :band]
    memory, hashed, times = WordHashes(), [], []
    for text in group.column("text"):  # one text at a time is a Python string
        some, w = shingles(text.as_py(), memory)
        hashed.append(some)
        times.append(w.astype(np.int32))
    sizes = np.array([int(w.sum()) for w in times])
    cuts = np.cumsum([0, *(len(s) for s in hashed)])
    elements, place = np.unique(np.concatenate(hashed), return_inverse=True)
    room = np.zeros(len(elements), dtype=np.int32)
    del hashed, elements, memory
    place = place.astype(np.int32)
    bags = [(place[a:b], w) for a, b, w in zip(cuts, cuts[1:], times)]
    whole = low == group.column("high")[0].as_py()
    left = np.arange(len(nid)) if whole else np.flatnonzero(block == low)
    right = left if whole else np.flatnonzero(block != low)
    if not len(left) or not len(right):
        return []
    _, joined = np.unique(component, return_inverse=True)
    links = []
    for a in range(0, len(left), 32):
        rows = left[a : a + 32]
        fits = ~(earlier[rows][:, None, :] == earlier[right][None, :, :]).any(axis=2)
        one, two = sizes[rows][:, None], sizes[right][None, :]
        fits &= np.minimum(one, two) >= least * np.maximum(one, two)
        if whole:
            fits &= rows[:, None] < right[None, :]
        for i, fit in zip(rows, fits, strict=True):
            near = right[fit]
            near = near[joined[near] != joined[i]]
            if not len(near):
                continue
            both = _overlap(bags[i], [bags[j] for j in near], room)
            for j in near[both / (sizes[i] + sizes[near] - both) >= least]:
                if joined[j] != joined[i]:
                    joined[joined == joined[j]] = joined[i]
                    links.append((int(nid[i]), int(nid[j])))
    return links


def _further_links(buckets: DataFrame, paired: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Links between different components that share a band, found inside the bands."""
    own = buckets.join(classes, "nid", "left").withColumn("component", F.coalesce("component", "nid"))
    size = paired.select("nid", F.octet_length("text").alias("bytes"))
    mixed = own.join(size, "nid").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    mixed = mixed.where("low != high").select("bucket", blocks.alias("blocks"))
    rows = own.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high")
    rows = rows.select("bucket", "band", low, high, "block", "nid", "component").join(paired.select("nid", "bands", "text"), "nid")

    def compare(group: pa.Table) -> pa.Table:
        links = _links_within(group, least)
        if group.nbytes > BLOCK_BYTES // 4:
            give_back()
        return pa.table([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.groupBy("bucket", "low", "high").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, node, class_id, representative.

    Rows are of one class if a chain of links joins them; two different texts link at a weighted Jaccard similarity of at
    least ``least`` of their five-word shingles, equal texts (null counts as empty) always do. Texts without a word link
    with equal ones only. ``class_id`` is the smallest doc_id of the class, null where all are null; ``representative``
    marks the rows with that doc_id and the text that goes with it (more than one where such a row is repeated). ``node``
    tells equal texts. No rows give no rows; other columns are not read. Links are exact, and every pair that
    shares a band is decided; a pair shares none with a probability of about 3 in a million at the least similarity, and
    less above.
    """
    signed = materialize(_sign(docs.select("doc_id", "text")))
    grouped = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("marks").alias("marks"), F.max("bands").alias("bands"))
    # The numbers are written with the rows, so they stay.
    nodes = materialize(grouped.withColumn("nid", F.monotonically_increasing_id()))
    exploded = nodes.select("nid", F.posexplode("bands").alias("band", "bucket"))
    several = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    buckets = materialize(exploded.join(several, "bucket"))
    # One row of each node that may have a partner, with its text.
    keys = buckets.select("nid").distinct().join(nodes.select("nid", "node", "doc_id", "marks", "bands"), "nid")
    keys = keys.select("nid", "marks", "bands", F.col("node").alias("own_node"), F.col("doc_id").alias("own_id"))
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    mine = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("own_node") == digest)
    paired = materialize(whole.join(keys, mine).select("nid", "marks", "bands", "text").dropDuplicates(["nid"]))

    links = materialize(_verified(_first_pairs(buckets, paired.select("nid", "marks")), paired.select("nid", "text"), least))
    classes = materialize(components(links).withColumnRenamed("node", "nid"))
    more = materialize(_further_links(buckets, paired, classes, least))
    if not more.isEmpty():
        joined = classes.select(F.col("nid").alias("a"), F.col("component").alias("b"))
        classes = materialize(components(joined.union(more)).withColumnRenamed("node", "nid"))

    member = nodes.select("nid", "node", "doc_id").join(classes, "nid", "left")
    member = member.withColumn("component", F.coalesce("component", "nid"))
    # Nulls last: a class has no name only if none of its rows has one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "nid"))
    lead = member.groupBy("component").agg(first.alias("least"))
    lead = lead.select("component", F.col("least.doc_id").alias("class_id"), F.col("least.nid").alias("lead"))
    by_node = member.join(lead, "component").select("node", "class_id", (F.col("nid") == F.col("lead")).alias("leads"))
    told = signed.select("doc_id", "node").join(by_node, "node")
    return told.select("doc_id", "node", "class_id", (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("representative"))


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class of ``docs`` (doc_id, text and any other columns): that with the smallest doc_id.

    Where its doc_id and text are repeated, one of the repeats stays.
    """
    found = materialize(near_duplicates(docs, least))
    stay = found.where("representative").groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
    repeated = not stay.where("n > 1").isEmpty()
    stay = stay.select(F.col("doc_id").alias(fresh(docs, "stay_id")), F.col("node").alias(fresh(docs, "stay_node")))
    digest = F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    kept = docs.join(stay, docs["doc_id"].eqNullSafe(stay[stay.columns[0]]) & (digest == stay[stay.columns[1]]))
    return (kept.dropDuplicates([*stay.columns]) if repeated else kept).drop(*stay.columns)
