"""WARC archives written by tasks, an index of their records, and coalesced reads of the records selected from it."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import RangeReader, dealt_by_bytes, scratch, store_of
from shelfwise.session import materialize

#: A file is closed once it holds this many bytes, and the task goes on with another.
FILE_BYTES = 1 << 30
#: Payload groups with at least this share of the rows are joined by broadcast, so there are at most as many as it divides one.
HOT_SHARE = 0.001
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}|{digest}')}>"


def record(page: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> bytes:
    """One record: a response with its payload, or a revisit of the page ``refers_to`` without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page, digest),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if refers_to is None else _record_id(refers_to, digest),
        "X-Page-ID": page,
        "X-Refers-To-Page-ID": refers_to,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Fields of a record, the length of the full payload, and the payload it holds (none for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first != VERSION:
        raise ValueError("no record begins here")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError(f"{fields['WARC-Record-ID']} is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    if fields["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if len(payload) != size or fields["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
    return fields, size, payload


def with_originals(pages: DataFrame, least_bytes: int, hot_share: float) -> DataFrame:
    """page_id, url, html (null: empty), its SHA-1 and the largest page_id with the same payload if other rows have it."""
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    seen = page.where(F.octet_length("html") >= least_bytes).groupBy("digest")
    groups = seen.agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialize(groups)
    most = max(2.0, pages.count() * hot_share)
    hot = groups.where(F.col("n") >= most).select("digest", F.struct("top").alias("hot"))
    cold = groups.where(F.col("n") < most).select(F.col("digest").alias("key"), F.struct("top").alias("cold"))
    found = page.join(F.broadcast(hot), "digest", "left")  # at most 1 / hot_share groups
    # Rows that are settled, or in no group, must not meet at one key.
    aside = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    found = found.withColumn("key", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(aside))
    return found.join(cold, "key", "left").withColumn("top", F.coalesce("hot.top", "cold.top")).drop("key", "hot", "cold")


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    *,
    least_bytes: int = 0,
    compress: bool = False,
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
    hot_share: float = HOT_SHARE,
) -> tuple[str, DataFrame]:
    """Write every row of ``pages`` (page_id, url, html) as a record; gives the folder and the index of the records.

    The index has file, offset, length, url, digest, page_id and record_type per record. Of rows with equal payloads of
    at least ``least_bytes`` bytes the one with the largest page_id is the response and the others revisit it; where
    that page_id is repeated with the payload, each such row is a response. Rows with a null page_id revisit like
    others, and are responses where no row of the group has one. Null html is an empty payload, a null URL is left out.
    Other columns are not read. With ``compress`` every record is a gzip member. Tasks name their files anew at every
    attempt, and the index names only files of attempts that finished.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType
    schema = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("offset", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("url", T.StringType()),
            T.StructField("digest", T.StringType()),
            T.StructField("page_id", kind),
            T.StructField("record_type", T.StringType()),
        ]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        name, file, at = "", None, 0
        for batch in batches:
            rows = []
            for page, url, html, sha, top in zip(*(batch.column(c).to_pylist() for c in COLUMNS), strict=True):
                if file is None or at >= file_bytes:
                    if file is not None:
                        file.close()
                    store.create_dir(root, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc{'.gz' * compress}", 0
                    file = store.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                refers_to = None if top is None or top == page else top
                raw = record(page, url, html.encode(), digest, refers_to, date)
                if compress:
                    raw = (gz := zlib.compressobj(wbits=31)).compress(raw) + gz.flush()
                file.write(raw)
                rows.append((name, at, len(raw), url, digest, page, "response" if refers_to is None else "revisit"))
                at += len(raw)
            if rows:
                columns = [pa.array(c) for c in zip(*rows)]
                columns[3] = columns[3].cast(pa.string())
                columns[5] = batch.column("page_id")
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
        if file is not None:
            file.close()

    COLUMNS = ["page_id", "url", "html", "digest", "top"]
    rows = with_originals(pages, least_bytes, hot_share).select(*COLUMNS)
    return folder, materialize(rows.mapInArrow(write, schema))


def read_warc(folder: str, index: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """The records that ``index`` (file, offset, length, page_id's type) names, read from the archives.

    Places are sorted and neighbouring ones fetched together. Gives page_id, payload_bytes and payload_digest (of the
    full payload, for revisits too), record_type, refers_to, url, and with ``with_payload`` the payload of responses.
    Damaged or cut records raise.
    """
    kind = index.schema["page_id"].dataType
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers", "url", *(["payload"] if with_payload else [])]
    types = {"payload_bytes": "long", "payload": "binary"}
    arrow = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            rows = []
            for file, raw in zip(files, reader.read(list(zip(files, offsets, lengths, strict=True))), strict=True):
                fields, size, payload = parse(zlib.decompress(raw, wbits=31) if file.endswith(".gz") else raw)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                ids = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                row = (ids[0], size, digest, fields["WARC-Type"], ids[1], fields.get("WARC-Target-URI"))
                rows.append((*row, payload if fields["WARC-Type"] == "response" else None)[: len(names)])
            if rows:
                columns = [pa.array(c, arrow.get(n, pa.string())) for n, c in zip(names, zip(*rows), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    ordered = dealt_by_bytes(index.select("file", "offset", "length"), "file")
    found = ordered.mapInArrow(read, ", ".join(f"{n} {types.get(n, 'string')}" for n in names))
    ids = [F.col("page").cast(kind).alias("page_id"), F.col("refers").cast(kind).alias("refers_to")]
    return found.select(ids[0], *names[1:4], ids[1], *names[5:])
