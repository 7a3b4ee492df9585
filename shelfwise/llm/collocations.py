"""Phrases whose words keep together: frequent word sequences by mergeable Misra-Gries summaries, then exact counts and scores."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import giving_back, texts_of
from shelfwise.session import materialize

LEAST, LONGEST, FIRST = 10, 3, 2000
#: Share of a phrase's occurrences, in hundredths, that lie inside one longer phrase and so make it a part of that.
INSIDE = 50
#: Text that a task counts at a time, and text for each hash partition of phrases.
CHUNK_BYTES, PART_BYTES = 8 << 20, 12 << 20
#: Chunks of text that a task holds back at most, so that each language fills its own.
HELD_CHUNKS = 2
#: Hash partitions dealt in one shuffle; more than these are dealt in two.
FAN = 2048
#: Tasks for the parts of all languages, where the parts are fewer.
SPREAD = 512
#: Rows of counts that are read from packed blocks together, about.
READ_ROWS = 65_536

# Characters that end a piece become the separator, tabs become spaces, A-Z become a-z.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_ENDS + b"\t" + bytes(range(65, 91)), b"\n" * len(_ENDS) + b" " + bytes(range(97, 123)))
COUNTS = pa.schema([("phrase", pa.string()), ("n", pa.int64())])


def words_of(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words of all texts, -1 between pieces, and the distinct words by number."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_TABLE).replace(b"\n", b" \n ")
    coded = pc.split_pattern(pa.array([raw], pa.large_binary()), b" ").flatten().dictionary_encode()
    words = coded.dictionary
    numbers = np.arange(len(words))
    for mark, number in ((b"", -2), (b"\n", -1)):
        at = pc.index(words, pa.scalar(mark, words.type)).as_py()
        if at >= 0:
            numbers[at] = number
    ids = numbers[coded.indices.to_numpy()]
    return ids[ids != -2], words


def marks_of(words: pa.Array) -> np.ndarray:
    """A hash of each word that is the same in every task."""
    return np.fromiter((zlib.crc32(w) for w in words.to_pylist()), np.uint64, len(words))


def mixed(marks: list[np.ndarray]) -> np.ndarray:
    """One hash for each sequence of words, from the hashes of its words."""
    out = np.zeros(len(marks[0]), np.uint64)
    for mark in marks:
        out = (out ^ mark) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def marks_of_phrases(phrases: pa.Array) -> np.ndarray:
    """What :func:`mixed` gives for phrases joined by spaces."""
    words = pc.split_pattern(phrases.cast(pa.large_binary()), b" ")
    coded = words.flatten().dictionary_encode()
    marks = marks_of(coded.dictionary)[coded.indices.to_numpy()]
    begin = words.offsets.to_numpy()
    sizes, out = np.diff(begin), np.zeros(len(phrases), np.uint64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[rows] = mixed([marks[begin[rows] + i] for i in range(size)])
    return out


def counted(texts: list[str], longest: int) -> tuple[int, list[tuple[pa.Array, np.ndarray, np.ndarray]]]:
    """How many words there are, and for each length up to ``longest`` the distinct phrases, their hashes and counts."""
    ids, words = words_of(texts)
    marks, out, base = marks_of(words), [], len(words) + 1
    inside = ids >= 0
    if base ** longest >= 2**63:
        raise ValueError("too many different words in a chunk to number its phrases")
    codes, whole = ids.copy(), inside.copy()
    for size in range(1, longest + 1):
        if size > 1:
            codes, whole = codes[:-1] * base + ids[size - 1 :], whole[:-1] & inside[size - 1 :]
        found, n = np.unique(codes[whole], return_counts=True)
        if not len(found):
            break
        places = []
        for _ in range(size):
            places.append(found % base)
            found = found // base
        places.reverse()
        parts = [words.take(pa.array(p)) for p in places]
        phrases = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", words.type))
        out.append((phrases.cast(pa.large_string()), mixed([marks[p] for p in places]), n))
    return int(inside.sum()), out


_HEAD, _CODEC = struct.Struct("<qqq"), pa.Codec("zstd")  # rows, bytes of their phrases, sum of their counts


def _block(n: np.ndarray, ends: np.ndarray, values: memoryview) -> bytes:
    """Counts and phrases as bytes: with hundreds of parts a block has few rows, and an Arrow stream would cost more than they."""
    lengths = np.diff(ends).astype(np.int32)
    raw = b"".join((n.tobytes(), lengths.tobytes(), values[ends[0] : ends[-1]]))
    return _HEAD.pack(len(n), int(ends[-1] - ends[0]), int(n.sum())) + _CODEC.compress(raw, asbytes=True)


def _buffers(table: pa.Table) -> tuple[np.ndarray, np.ndarray, memoryview]:
    """Counts, ends of the phrases and the bytes of a table without nulls."""
    phrases = table.column("phrase").cast(pa.large_string()).combine_chunks()
    phrases = phrases.combine_chunks() if isinstance(phrases, pa.ChunkedArray) else phrases
    _, ends, values = phrases.buffers()
    ends = np.frombuffer(ends, np.int64, len(phrases) + 1, phrases.offset * 8) if len(phrases) else np.zeros(1, np.int64)
    return table.column("n").to_numpy(), ends, memoryview(values or b"")


def packed(table: pa.Table) -> bytes:
    return _block(*_buffers(table))


def mass_of(block: bytes) -> int:
    return _HEAD.unpack_from(block)[2]


def unpacked(*blocks: bytes) -> pa.Table:
    """The rows of all blocks as one table."""
    n, lengths, values = [], [], []
    for block in blocks:
        rows, size, _ = _HEAD.unpack_from(block)
        raw = _CODEC.decompress(memoryview(block)[_HEAD.size :], 12 * rows + size, asbytes=True)
        n.append(np.frombuffer(raw, np.int64, rows))
        lengths.append(np.frombuffer(raw, np.int32, rows, 8 * rows))
        values.append(memoryview(raw)[12 * rows :])
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]), dtype=np.int64)
    phrases = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(values))])
    counts = pa.array(np.concatenate([np.zeros(0, np.int64), *n]))
    return pa.table([phrases.cast(pa.string()), counts], schema=COUNTS)


def tables_of(blocks: Sequence[bytes], rows: int) -> Iterator[pa.Table]:
    """The rows of all blocks, those of neighbours together until they are about ``rows``."""
    some, held = [], 0
    for block in blocks:
        some.append(block)
        held += _HEAD.unpack_from(block)[0]
        if held >= rows:
            yield unpacked(*some)
            some, held = [], 0
    if some:
        yield unpacked(*some)


def _dealt(phrases: pa.ChunkedArray, n: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A packed block of counts for every part that has some."""
    order = np.argsort(part, kind="stable")
    n, ends, values = _buffers(pa.table([phrases.take(pa.array(order)), pa.array(n[order])], names=["phrase", "n"]))
    parts, begin = np.unique(part[order], return_index=True)
    for p, a, b in zip(parts.tolist(), begin.tolist(), [*begin[1:].tolist(), len(order)]):
        yield p, _block(n[a:b], ends[a : b + 1], values)


def summed(table: pa.Table) -> pa.Table:
    return table.group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])


class Summary:
    """A Misra-Gries summary of weighted phrases with room for ``capacity`` counters.

    Merging adds the counters of both and, where more than ``capacity`` are left, takes the largest counter that has no
    room off all. Every counter is short of the true count by less than mass / capacity in the end.
    """

    def __init__(self, capacity: int):
        self.capacity, self.kept, self.waiting, self.rows = capacity, COUNTS.empty_table(), [], 0

    def merge(self, other: pa.Table) -> None:
        self.waiting.append(other)
        self.rows += other.num_rows
        if self.rows > self.capacity:
            self.settle()

    def settle(self) -> pa.Table:
        merged = summed(pa.concat_tables([self.kept, *self.waiting]))
        if merged.num_rows > self.capacity:
            n = merged.column("n").to_numpy()
            off = np.partition(n, len(n) - self.capacity - 1)[len(n) - self.capacity - 1]
            keep = n > off
            merged = pa.table([merged.column("phrase").filter(pa.array(keep)), pa.array(n[keep] - off)], schema=COUNTS)
        self.kept, self.waiting, self.rows = merged, [], 0
        return merged


def frequent_of(blocks: Sequence[bytes], least: int) -> pa.Table:
    """The phrases of a hash partition that come ``least`` times or more, with exact counts.

    Blocks are small where parts are many. They are read many at a time, so that survivors are looked up as often as
    their number asks for and not once a block.
    """
    summary = Summary(sum(map(mass_of, blocks)) // least + 1)
    for table in tables_of(blocks, READ_ROWS):
        summary.merge(table)
    survivors = summary.settle().column("phrase").combine_chunks()
    parts = [COUNTS.empty_table()]
    for table in tables_of(blocks, max(READ_ROWS, len(survivors))):
        parts.append(summed(table.filter(pc.is_in(table.column("phrase"), value_set=survivors))))
    exact = summed(pa.concat_tables(parts))
    return exact.filter(pc.greater_equal(exact.column("n"), least))


def frequent_phrases(docs: DataFrame, lang: Column, least: int = LEAST, longest: int = LONGEST, *, part_bytes: int = PART_BYTES, fan: int = FAN, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``lang``, ``phrase``, ``f`` of all phrases of 1 to ``longest`` words that come ``least`` times or more; and per
    language a row without a phrase, whose ``f`` is the number of all words. ``docs`` needs a column text.

    Tasks count the phrases of a chunk of texts and deal the counts by hash; of each hash partition one task merges them
    into a Misra-Gries summary with more counters than its mass divided by ``least``, so that no such phrase can be lost,
    and then counts the survivors exactly.
    """
    source = docs.select(lang.alias("lang"), "text")
    text = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    total = -(-text // part_bytes) + 1
    first = min(total, fan)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        held = 0

        def flush(names: list[str]) -> Iterator[pa.RecordBatch]:
            for name in names:
                words, found = counted(waiting.pop(name), longest)
                if not words:
                    continue
                phrases = pa.chunked_array([p for p, _, _ in found])
                part = (np.concatenate([m for _, m, _ in found]) % np.uint64(total) % np.uint64(first)).astype(np.int64)
                rows = [(name, p, raw, 0) for p, raw in _dealt(phrases, np.concatenate([n for _, _, n in found]), part)]
                yield batch_of([*rows[:-1], (*rows[-1][:3], words)])

        for batch in batches:
            for name, content in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                if content:
                    waiting.setdefault(name, []).append(content)
                    sizes[name] = sizes.get(name, 0) + len(content)
                    held += len(content)
                    if sizes[name] >= chunk_bytes:
                        held -= sizes.pop(name)
                        yield from flush([name])
                    elif held >= HELD_CHUNKS * chunk_bytes:
                        sizes, held = {}, 0
                        yield from flush([*waiting])
        yield from flush([*waiting])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["lang", "part", "counts", "words"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw, words in zip(*(batch.column(c).to_pylist() for c in ("lang", "counts", "words"))):
                table = unpacked(raw)
                phrases = table.column("phrase").combine_chunks()
                part = (marks_of_phrases(phrases) % np.uint64(total)).astype(np.int64)
                rows = [(name, p, block, 0) for p, block in _dealt(table.column("phrase"), table.column("n").to_numpy(), part)]
                yield batch_of([*rows[:-1], (*rows[-1][:3], words)])

    def gather(group: pa.Table) -> pa.Table:
        found = frequent_of(group.column("counts").to_pylist(), least)
        words = pc.sum(group.column("words")).as_py()
        phrase = pa.concat_arrays([found.column("phrase").combine_chunks(), pa.array([None], pa.string())])
        n = pa.concat_arrays([found.column("n").combine_chunks(), pa.array([words], pa.int64())])
        return pa.table([pa.array([group.column("lang")[0].as_py()] * len(n), pa.string()), phrase, n], names=["lang", "phrase", "f"])

    shape = "lang string, part long, counts binary, words long"
    blocks = source.mapInArrow(giving_back(encode), shape)
    if total > first:
        # A coarse part holds every first-th part; its blocks are merged by languages in many tasks before being split.
        blocks = blocks.repartition("lang", "part").mapInArrow(_joined(batch_of), shape).mapInArrow(split, shape)
    # As many tasks as parts, not as the session's setting says: a task's share must not grow with the input. Few parts get
    # more tasks than there are, as those of different languages then seldom meet.
    spread = blocks.repartition(min(max(total, min(4 * total, SPREAD)), 20_000), "lang", "part")
    found = materialize(spread.groupBy("lang", "part").applyInArrow(gather, "lang string, phrase string, f long"))
    words = found.where("phrase IS NULL").groupBy("lang").agg(F.lit(None).cast("string").alias("phrase"), F.sum("f").alias("f"))
    return found.where("phrase IS NOT NULL").union(words)


def _joined(batch_of):
    """Blocks of one coarse part that a task holds, added up to blocks of about ``CHUNK_BYTES`` before they are split."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tables, size, words = None, [], 0, 0
        for batch in batches:
            for name, part, raw, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "counts", "words"))):
                if tables and ((name, part) != now or size >= CHUNK_BYTES):
                    yield batch_of([(*now, packed(summed(pa.concat_tables(tables))), words)])
                    tables, size, words = [], 0, 0
                now = (name, part)
                tables.append(unpacked(raw))
                size, words = size + tables[-1].nbytes, words + n
        if tables:
            yield batch_of([(*now, packed(summed(pa.concat_tables(tables))), words)])

    return join


def collocations(docs: DataFrame, *, lang: str = "lang", least: int = LEAST, longest: int = LONGEST, inside: int = INSIDE, first: int = FIRST, **sizes) -> DataFrame:
    """The ``first`` phrases of each language by how firmly their words keep together.

    ``docs`` has text and a column named by ``lang``; null text is empty, null language ``und``, other columns are not
    read, repeated rows count each. Texts have A-Z lower-cased and are split at ``.,;:!?`` and line breaks into pieces,
    those at spaces and tabs into words. Result: lang, rank (from 1), phrase (joined by spaces), a (its occurrences), l
    and r (those of its two parts at the cut that scores lowest, the first of such cuts), n (all words of the language),
    score (floor of 1000000 a a / (l r)). Candidates have 2 to ``longest`` words and ``least`` occurrences; one that
    lies in a longer candidate with ``inside`` hundredths of its occurrences or more is dropped. Order: score and a
    descending, phrase ascending in bytes. No rows, or none with a candidate, give no rows.
    """
    counts = frequent_phrases(docs, F.coalesce(F.col(f"`{lang}`"), F.lit("und")), least, longest, **sizes)
    totals = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    known = counts.where("phrase IS NOT NULL").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    whole = known.where(F.size("w") > 1)
    cut = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cut = cut.withColumns({"left": joined(F.lit(1), F.col("k")), "right": joined(F.col("k") + 1, F.size("w") - F.col("k"))})
    parts = known.select("lang", "phrase", F.col("a").alias("f"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    # Whole products are divided, in decimals: they can pass 64 bits.
    a, l, r = (F.col(c).cast("decimal(18,0)") for c in "alr")
    cut = cut.withColumns({"times": F.lit(1_000_000).cast("decimal(7,0)") * a * a, "over": l * r}).withColumn("score", F.expr("times div over"))
    low = F.struct("score", "k", "l", "r")
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(low).alias("low")).select("lang", "phrase", "a", "low.score", "low.l", "low.r")
    # Every shorter phrase of two words or more in a longer one, with the longer one's count.
    starts = lambda m: F.sequence(F.lit(1), F.size("w") - m + 1)
    sizes_of = F.sequence(F.lit(2), F.size("w") - 1)
    spans = F.flatten(F.transform(sizes_of, lambda m: F.transform(starts(m), lambda i: F.array_join(F.slice("w", i, m), " "))))
    longer = known.where(F.size("w") > 2).select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    held = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
