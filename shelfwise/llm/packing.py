"""Best-fit packing of token sequences, planned by the driver over counts of their lengths.

Pieces of one length are interchangeable, so a step deals with all of them at once. A
piece's place is its length and its rank within it, worked out from counts per length and input partition; no range
sort and no distributed sweep over pieces and gaps is run, as the counts, at most one per length up to the capacity, are
all that a sweep would need. The steps below are a loop in the driver (``plan``). Sequences
are kept the same way, as runs of consecutive sequences with equal gap. A step takes the next smaller length, finds its
successor among the gaps (the smallest that fits), matches pieces to sequences by rank so that no two meet, updates
the gaps and repeats until the length is used up. What a step reads and writes is at most one run per gap, whatever the
number of pieces; the pieces themselves are placed afterwards, all at once, by looking up their rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.tokens import blocks, encoder, tokenizer_path
from shelfwise.session import materialize

CAPACITY = 2048
END_ID = 0

PIECE = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
]


def pieces_of(docs: DataFrame, capacity: int, tokenizer: str, end_id: int, keep_ids: bool) -> DataFrame:
    """Encoded documents cut into pieces, each with its task (``part``) and its number among that task's equal lengths.

    Only a document of more than ``capacity`` tokens is cut; its first piece takes what does not fill a sequence.
    """
    fields = [docs.schema["doc_id"], *PIECE, T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    names = [f.name for f in fields]
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for block in blocks(batch):
                rows: list[tuple] = []
                at: list[int] = []
                for i, head in enumerate(encode.encode(block.column("text"))):
                    ids = bytes(head) + end
                    n, begin, piece = len(ids) // 4, 0, 0
                    while begin < n:
                        length = capacity if piece or n <= capacity else n % capacity or capacity
                        length = min(length, n - begin)
                        own = ids[4 * begin : 4 * (begin + length)]
                        rows.append((piece, begin, length, zlib.crc32(own), part, seen[length], *([own] * keep_ids)))
                        at.append(i)
                        seen[length] += 1
                        begin, piece = begin + length, piece + 1
                columns = [pa.array(c) for c in zip(*rows)]
                columns[0], columns[4] = columns[0].cast(pa.int32()), columns[4].cast(pa.int32())
                yield pa.RecordBatch.from_arrays([block.column("doc_id").take(pa.array(at)), *columns], names)

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Runs ``(length, first rank, first sequence, offset)`` that place every piece; each run ends where the next of
    its length begins. ``counts`` is the number of pieces by length.
    """
    runs: list[tuple[int, int, int, int]] = []
    by_gap: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences (first, number)
    gaps: list[int] = []
    sequences = 0

    def give_back(gap: int, first: int, number: int) -> None:
        if gap and number:
            if not by_gap[gap]:
                insort(gaps, gap)
            by_gap[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, number = by_gap[gap].pop()
                if not by_gap[gap]:
                    del gaps[at]
            else:
                gap, first, number = capacity, sequences, -(-left // (capacity // length))
                sequences += number
            each = gap // length  # a sequence just filled has the smallest gap, so it is filled on
            full = min(number, left // each)
            rest = min(left - full * each, each) if full < number else 0
            for layer in range(each):
                taken = full + (layer < rest)
                if taken:
                    runs.append((length, rank, first, capacity - gap + layer * length))
                    rank, left = rank + taken, left - taken
            give_back(gap - each * length, first, full)
            if rest:
                give_back(gap - rest * length, first + full, 1)
            give_back(gap, first + full + (rest > 0), number - full - (rest > 0))
    return runs


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    *,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens, each document ended by ``end_id``.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with ``keep_ids`` the piece's
    ids as little-endian unsigned 32-bit integers. Null and empty texts are a lone end id. Rows with a null or repeated
    doc_id are packed like any other, each by itself; equal lengths rank by input partition, then by place in it. No
    rows give no rows. Other columns are not read. At most ``capacity`` counts and a few runs for each reach the
    driver, whatever the input.
    """
    placed = materialize(pieces_of(docs, capacity, tokenizer or tokenizer_path(), end_id, keep_ids))
    per_part = placed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity)
    table: dict[int, tuple[np.ndarray, ...]] = {}
    for length in counts:
        table[length] = tuple(np.array(c, dtype=np.int64) for c in list(zip(*[r for r in runs if r[0] == length]))[1:])
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, number = length.to_numpy(), rank.to_numpy()
        out = np.empty((2, len(size)), dtype=np.int64)
        for each in np.unique(size):
            at = np.flatnonzero(size == each)
            first, sequence, offset = shared.value[int(each)]
            run = np.searchsorted(first, number[at], side="right") - 1
            out[0, at] = sequence[run] + number[at] - first[run]
            out[1, at] = offset[run]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = placed.join(base, ["length", "part"]).withColumn("at", place("length", F.col("base") + F.col("seq")))
    shown = ["doc_id", *(f.name for f in PIECE), "at.sequence_id", "at.offset"]
    return ranked.select(*shown, *(["ids"] if keep_ids else []))
