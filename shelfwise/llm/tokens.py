"""Byte-level BPE encoding of whole texts, each distinct chunk of a block of texts once.

The tokenizer cuts a text before every space that follows a character other than white space, and encodes what lies
between two cuts by itself. A block of texts is therefore split at spaces, its distinct chunks go through the
``tokenizers`` library joined by spaces, and every text is put together from the ids of its chunks. Texts in which a
space stands between two white-space characters, or that hold a special token's string, go through the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.common import giving_back

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of text encoded together (one longer text makes a block of its own); a task holds about ten times as much.
BLOCK_BYTES = 24 << 20
#: Chunks joined into one text for the library.
JOINED = 4096

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


def blocks(batch: pa.RecordBatch, name: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most`` bytes of text each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0)).cumsum(dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    # The characters that the tokenizer's pattern takes for white space.
    _white = r"\x09-\x0d\x20\x{85}\pZ"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In the byte-level alphabet a space is written as U+0120.
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True

    @property
    def ids(self) -> int:
        """One more than the largest id."""
        return len(self.opens)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts straight from the library."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _after_space(self, words: pa.Array) -> pa.Array:
        """Ids of each word preceded by a space."""
        w = self._white
        joinable = np.asarray(pc.match_substring_regex(words, rf"(?s)\A[^{w}](.*[^{w}])?\z"))
        parts, order = [], [np.flatnonzero(joinable), np.flatnonzero(~joinable)]
        plain = words.filter(pa.array(joinable)).to_pylist()
        for at in range(0, len(plain), JOINED):
            block = plain[at : at + JOINED]
            ids = np.frombuffer(self.whole([" " + " ".join(block)])[0], dtype="<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(block) and starts[0] == 0:
                cuts = pa.array(np.append(starts, len(ids)) * 4, pa.int64())
                parts.append(pa.Array.from_buffers(pa.large_binary(), len(block), [None, cuts.buffers()[1], pa.py_buffer(ids)]))
            else:
                parts.append(pa.array(self.whole([" " + x for x in block]), pa.large_binary()))
        rest = words.filter(pa.array(~joinable)).to_pylist()
        parts.append(pa.array(self.whole([" " + x for x in rest]), pa.large_binary()))
        return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order))))

    def encode(self, texts: pa.Array) -> list[memoryview | bytes]:
        """Ids of every text of an Arrow string array; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        aside = np.asarray(pc.match_substring_regex(texts, f"[{self._white}] [{self._white}]"))
        for special in self.special:
            aside = aside | np.asarray(pc.match_substring(texts, special))
        split = pc.split_pattern(pc.if_else(pa.array(aside), "", texts), " ")
        begins = np.asarray(split.offsets)[:-1] - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        at = np.asarray(coded.indices).copy()
        heads, position = np.unique(at[begins], return_inverse=True)
        at[begins] = position + len(coded.dictionary)
        first = self.whole(coded.dictionary.take(pa.array(heads)).to_pylist())
        values = pa.concat_arrays([self._after_space(coded.dictionary), pa.array(first, pa.large_binary())])
        joined = values.take(pa.array(at))
        raw = memoryview(joined.buffers()[2] or b"")
        offsets = np.frombuffer(joined.buffers()[1], dtype="<i8", count=len(joined) + 1)
        cuts = offsets[np.append(begins, len(joined))].tolist()
        out: list[memoryview | bytes] = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        direct = np.flatnonzero(aside)
        for i, ids in zip(direct, self.whole([texts[int(i)].as_py() for i in direct]), strict=True):
            out[i] = ids
        return out


def with_token_counts(docs: DataFrame, name: str, tokenizer: str | None = None) -> DataFrame:
    """``docs`` with the number of ids of each text, and one for its end, in the column ``name`` (not among its own)."""
    path, names = tokenizer or tokenizer_path(), [*docs.columns, name]

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for block in blocks(batch):
                sizes = [len(ids) // 4 + 1 for ids in encode.encode(block.column("text"))]
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(sizes, pa.int64())], names)

    return docs.mapInArrow(count, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))
