"""Helpers shared by the training-data operators: inputs, names, and files in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import shelfwise
from shelfwise.session import shared_folder

#: Documents handled together inside a task; bounds what a task holds besides the Arrow batch it was given.
CHUNK = 512
#: Bytes of files that a task reads back, about; a stretch of a file goes to one task as a whole.
READ_BYTES = 32 << 20
STRETCH = 8 << 20
#: More tasks than this are not made: beyond, a task reads more, still batch by batch.
MOST_READERS = 20_000


def importable(spark: SparkSession) -> None:
    """Let Python workers on machines that have this folder import the package (elsewhere it must be installed)."""
    root, environment = os.path.dirname(os.path.dirname(os.path.abspath(shelfwise.__file__))), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Rows kept back from learning: crc32 of the identifier as text divides by five. A null identifier is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def scratch(spark: SparkSession, kind: str) -> str:
    """A folder of its own below the shared folder, for files that tasks write themselves."""
    return f"{shared_folder(spark)}/shelfwise/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and plain path of a folder given as a path or as a URI (file, hdfs, s3, gs ...)."""
    return pafs.FileSystem.from_uri(folder)


def give_back() -> None:
    """Hand freed memory back to the machine: a Python worker lives on, and what it keeps adds up over the stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of batches, which gives memory back when its task ends."""

    @wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def slices(batch: pa.RecordBatch, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Strings of a column, null as the empty string."""
    return [x or "" for x in batch.column(name).to_pylist()]


def dealt_by_bytes(places: DataFrame, file: str, unit: int = 1) -> DataFrame:
    """Stored rows (``file``, offset, length; in units of ``unit`` bytes) in as many tasks as the bytes they name need.

    The rows themselves are small, so a number of tasks chosen by their own size would leave all reading to a few. Each
    task has its places in ascending order.
    """
    named = places.agg(F.sum("length")).first()[0] or 0
    tasks = min(max(1, -(-named * unit // READ_BYTES)), MOST_READERS)
    stretch = F.expr(f"offset div {max(1, STRETCH // unit)}")
    return places.repartition(tasks, file, stretch).sortWithinPartitions(file, "offset")


class RangeReader:
    """Reads byte ranges of files in ``folder``, given in ascending order, through few large reads.

    Ranges that lie within ``gap`` bytes of each other are fetched together, up to ``most`` bytes at a time (a single
    longer range is fetched alone).
    """

    def __init__(self, folder: str, gap: int = 65_536, most: int = 8 << 20):
        self.store, self.root = store_of(folder)
        self.gap, self.most = gap, most

    def read(self, ranges: list[tuple[str, int, int]]) -> Iterator[bytes]:
        name, file, at = None, None, 0
        while at < len(ranges):
            path, begin, length = ranges[at]
            if path != name:
                if file:
                    file.close()
                name, file = path, self.store.open_input_file(f"{self.root}/{path}")
            end, upto = begin + length, at + 1
            while upto < len(ranges) and ranges[upto][0] == path and begin <= ranges[upto][1] <= end + self.gap:
                further = max(end, ranges[upto][1] + ranges[upto][2])
                if further - begin > self.most:
                    break
                end, upto = further, upto + 1
            block = file.read_at(end - begin, begin)
            for _, offset, size in ranges[at:upto]:
                yield block[offset - begin : offset - begin + size]
            at = upto
        if file:
            file.close()
