"""Token ids as raw shard files, with a minimal perfect hash index from document keys to places in them.

Shard file: 8 bytes magic, 4 bytes width of an id, 4 bytes zero, then the ids of its documents one after another in
ascending key order, little-endian and unsigned (two bytes wide where the vocabulary allows, else four).

Index: keys are dealt to segments by hash. A segment's function is a row of bit arrays; a key goes to the first array
in which it had its bit alone, and its slot is the number of bits set before that one. Slots hold a fingerprint of the
key, the shard, the offset and the length, so a lookup reads a few words whatever the number of keys, and keys that are
not in the store are told by the fingerprint (one in four thousand million passes).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import RangeReader, dealt_by_bytes, scratch, store_of
from shelfwise.llm.tokens import blocks, encoder, tokenizer_path
from shelfwise.session import materialize

MAGIC = b"IDSHARD1"
HEADER = 16
END_ID = 2
#: Keys of one index segment; a segment is built by one task and read by another.
SEGMENT_KEYS = 131_072
#: Bits of the first array per key.
SPREAD = 1.6
LEVELS = 64
RANK_BLOCK = 64  # bytes between two stored ranks

SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])


@dataclass
class TokenStore:
    """``folder`` holds the shard files; ``manifest`` one row per document; ``index`` one row per segment."""

    folder: str
    manifest: DataFrame
    shards: DataFrame
    index: DataFrame
    segments: int


# --- shards ---------------------------------------------------------------------------------------------------------


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode ``docs`` in ascending key order into shard files, and say where each document went.

    Every attempt of a task writes a file of its own name; only files named by the rows of finished tasks are read.
    """
    key = docs.schema["doc_id"]
    schema = T.StructType(
        [
            key,
            T.StructField("part", T.IntegerType()),
            T.StructField("shard", T.StringType()),
            T.StructField("offset", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("copy", T.LongType()),
        ]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(encode.ids, end_id + 1) <= 1 << 16 else 4
        kind = np.dtype(f"<u{width}")
        end = np.array([end_id], dtype=kind).tobytes()
        store, root = store_of(folder)
        name, file, at, last, copy = f"{part:06d}-{uuid.uuid4().hex}.ids", None, 0, object(), 0
        for batch in batches:
            for block in blocks(batch):
                if file is None:
                    store.create_dir(root, recursive=True)
                    file = store.open_output_stream(f"{root}/{name}")
                    file.write(MAGIC + width.to_bytes(4, "little") + bytes(4))
                offsets, lengths, copies = [], [], []
                for doc, ids in zip(block.column("doc_id").to_pylist(), encode.encode(block.column("text")), strict=True):
                    raw = np.frombuffer(ids, dtype="<u4").astype(kind).tobytes() + end
                    file.write(raw)
                    copy = copy + 1 if doc == last else 0
                    last = doc
                    offsets.append(at)
                    lengths.append(len(raw) // width)
                    copies.append(copy)
                    at += lengths[-1]
                n = block.num_rows
                told = [pa.array([part] * n, pa.int32()), pa.array([name] * n), *map(pa.array, (offsets, lengths, copies))]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *told], schema.fieldNames())
        if file is not None:
            file.close()

    tie = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = tie.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(write, schema)


# --- minimal perfect hashing ----------------------------------------------------------------------------------------


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where keys fall in the bit array of a level."""
    with np.errstate(over="ignore"):
        x = h1 ^ (h2 + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Sizes of the levels in bytes, their bits, and the slot of every key (0 to n - 1, each once)."""
    left, sizes, bits = np.arange(len(h1)), [], []
    level_of, place_of = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("keys that equal each other in all 128 hash bits")
        size = -(-max(int(SPREAD * len(left)), 64) // 8)
        at = _place(h1[left], h2[left], len(sizes), 8 * size)
        alone = np.bincount(at, minlength=8 * size)[at] == 1
        taken = np.zeros(8 * size, dtype=bool)
        taken[at[alone]] = True
        level_of[left[alone]], place_of[left[alone]] = len(sizes), at[alone]
        sizes.append(size)
        bits.append(np.packbits(taken, bitorder="little"))
        left = left[~alone]
    raw = np.concatenate(bits) if bits else np.zeros(0, np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    slots = _rank(raw, ranks_of(raw), 8 * begin[level_of] + place_of) if len(h1) else place_of
    return np.array(sizes, dtype="<i8"), raw.tobytes(), slots


_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


def ranks_of(raw: np.ndarray) -> np.ndarray:
    """Bits set before every block of ``RANK_BLOCK`` bytes."""
    padded = np.concatenate([raw, np.zeros(-len(raw) % RANK_BLOCK, np.uint8)])
    per_block = _ONES[padded].reshape(-1, RANK_BLOCK).sum(axis=1)
    return np.concatenate([[0], np.cumsum(per_block)]).astype("<i8")


def _rank(raw: np.ndarray, ranks: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Bits set before each given bit: a stored rank and at most one block counted."""
    padded = np.concatenate([raw, np.zeros(RANK_BLOCK, np.uint8)])
    byte, out = bit >> 3, np.empty(len(bit), np.int64)
    for a in range(0, len(bit), 65_536):
        at = slice(a, a + 65_536)
        first = byte[at] // RANK_BLOCK * RANK_BLOCK
        near = padded[first[:, None] + np.arange(RANK_BLOCK)]
        whole = np.arange(RANK_BLOCK) < (byte[at] - first)[:, None]
        partial = padded[byte[at]] & ((1 << (bit[at] & 7)) - 1).astype(np.uint8)
        out[at] = ranks[first // RANK_BLOCK] + (_ONES[near] * whole).sum(axis=1) + _ONES[partial]
    return out


def find_slots(h1: np.ndarray, h2: np.ndarray, sizes: np.ndarray, raw: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The slot of every key, or -1 where no level has its bit."""
    slot, left, begin = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, size in enumerate(sizes.tolist()):
        bit = 8 * begin + _place(h1[left], h2[left], level, 8 * size)
        hit = (raw[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        slot[left[hit]] = _rank(raw, ranks, bit[hit])
        left, begin = left[~hit], begin + size
    return slot


# --- index ----------------------------------------------------------------------------------------------------------


def key_hashes(segments: int) -> list[Column]:
    """Two hashes of a key (a document identifier and which of its rows), and the segment they fall into."""
    h1, h2 = F.xxhash64("doc_id", "copy"), F.xxhash64(F.lit("second"), "copy", "doc_id")
    return [h1.alias("h1"), h2.alias("h2"), F.pmod(h1, F.lit(segments)).cast("int").alias("segment")]


def build_index(entries: DataFrame, segments: int) -> DataFrame:
    """One row per segment: its bit arrays, their ranks and its slots."""
    schema = "segment int, n long, sizes binary, bits binary, ranks binary, slots binary"

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64)
        sizes, bits, at = build_hash(h1, h2)
        slots = np.zeros(len(rows), dtype=SLOT)
        slots["fingerprint"][at] = (h2 >> np.uint64(32)).astype("<u4")
        slots["shard"][at], slots["offset"][at], slots["length"][at] = rows["part"], rows["offset"], rows["length"]
        ranks = ranks_of(np.frombuffer(bits, np.uint8)).tobytes()
        return pd.DataFrame([(rows["segment"].iloc[0], len(rows), sizes.tobytes(), bits, ranks, slots.tobytes())])

    columns = [*key_hashes(segments), "part", "offset", "length"]
    return entries.select(*columns).groupBy("segment").applyInPandas(build, schema)


def write_store(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, folder: str | None = None) -> TokenStore:
    """Encode ``docs`` (doc_id, text), each followed by ``end_id``, into shards and index them.

    Shards follow each other in ascending doc_id, null first; a null or empty text is a lone end id. Rows that share a
    doc_id (or have none) lie next to each other in an order given by their texts and are told apart in the index by
    their number there, from 0. Other columns are not read. Nothing is collected but the number of documents.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "ids")
    manifest = materialize(write_shards(docs, folder, tokenizer or tokenizer_path(), end_id))
    # A key's rows may go on in the next shard: number them through.
    spans = manifest.groupBy("doc_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.sum("n").over(earlier)).where("before > 0")
    spans = spans.select(F.col("doc_id").alias("spans_id"), F.col("part").alias("spans_part"), "before")
    same = F.col("doc_id").eqNullSafe(F.col("spans_id")) & (F.col("part") == F.col("spans_part"))
    entries = manifest.join(spans, same, "left").withColumn("copy", F.col("copy") + F.coalesce("before", F.lit(0)))
    segments = max(1, -(-manifest.count() // SEGMENT_KEYS))
    index = materialize(build_index(entries, segments))
    totals = manifest.groupBy("part", "shard").agg(F.sum("length").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = totals.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return TokenStore(folder, manifest, shards, index, segments)


def keys_of(docs: DataFrame) -> DataFrame:
    """The keys of all rows: doc_id and, from 0, which of its rows."""
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))


def locate(store: TokenStore, keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, copy) with part, offset and length, through the index; null where the store has no such key."""
    fields = [keys.schema["doc_id"], T.StructField("copy", T.LongType())]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in ("part", "offset", "length"))])

    def look(rows: pa.Table, segment: pa.Table) -> pa.Table:
        found = [pa.nulls(rows.num_rows, pa.int64())] * 3
        if segment.num_rows and rows.num_rows:
            own = {c: segment.column(c)[0].as_py() for c in ("sizes", "bits", "ranks", "slots")}
            h1, h2 = (rows.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            slots = np.frombuffer(own["slots"], SLOT)
            sizes, ranks = np.frombuffer(own["sizes"], "<i8"), np.frombuffer(own["ranks"], "<i8")
            at = find_slots(h1, h2, sizes, np.frombuffer(own["bits"], np.uint8), ranks)
            hit = slots[np.maximum(at, 0)]
            known = (at >= 0) & (hit["fingerprint"] == (h2 >> np.uint64(32)).astype("<u4"))
            found = [pa.array(hit[c].astype(np.int64), mask=~known) for c in ("shard", "offset", "length")]
        return pa.Table.from_arrays([rows.column("doc_id"), rows.column("copy"), *found], schema.fieldNames())

    hashed = keys.select("doc_id", "copy", *key_hashes(store.segments))
    return hashed.groupBy("segment").cogroup(store.index.groupBy("segment")).applyInArrow(look, schema)


def read_back(store: TokenStore, located: DataFrame, *, keep_ids: bool = False) -> DataFrame:
    """Read located documents from the shards, in few large reads of each file.

    Gives doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), all from the bytes read, and with ``keep_ids`` those ids.
    """
    fields = [located.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))]
    schema = T.StructType([*fields, *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])
    folder = store.folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, widths = RangeReader(folder), {}
        for batch in batches:
            names, offsets, lengths = (batch.column(c).to_pylist() for c in ("shard", "offset", "length"))
            for name in set(names) - widths.keys():
                with reader.store.open_input_file(f"{reader.root}/{name}") as file:
                    head = file.read_at(HEADER, 0)
                if head[:8] != MAGIC:
                    raise ValueError(f"{name} is no shard of ids")
                widths[name] = int.from_bytes(head[8:12], "little")
            ranges = [(n, HEADER + o * widths[n], c * widths[n]) for n, o, c in zip(names, offsets, lengths, strict=True)]
            counts, sums, kept = [], [], []
            for name, raw in zip(names, reader.read(ranges), strict=True):
                ids = np.frombuffer(raw, dtype=f"<u{widths[name]}").astype("<u4")
                counts.append(len(ids))
                sums.append(zlib.crc32(ids))
                if keep_ids:
                    kept.append(ids.tobytes())
            start = pc.add(batch.column("first"), batch.column("offset"))
            columns = [batch.column("doc_id"), start, pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(kept, pa.binary())] if keep_ids else [])], schema.fieldNames())

    placed = materialize(located.where("part is not null").join(store.shards, "part"))
    ordered = dealt_by_bytes(placed, "shard", unit=4)
    return ordered.select("doc_id", "shard", "first", "offset", "length").mapInArrow(read, schema)
