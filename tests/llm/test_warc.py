import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import FOLDER, read_table
from shelfwise.llm import common
from shelfwise.llm.queries import LLM_CATALOG
from shelfwise.llm.warc import parse, read_warc, record, write_warc

PAGES = [
    (1, "http://a/\r\nx", "<p>same</p>"),
    (5, "http://b/", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (None, "http://c/", "<p>same</p>"),
    (4, "http://d/", None),
    (2, "http://e/", ""),
    (6, "http://f/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n é" * 5000),
    (7, "http://g/", "alone"),
    (7, "http://g/", "alone"),
    (None, None, "nameless"),
]


def expected(rows, least=0):
    top = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None:
            top[raw] = max(page, top.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        refers = None if len(raw) < least or top.get(raw) in (None, page) else top[raw]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("options", "hot"), [({}, 0.5), ({"compress": True, "file_bytes": 300}, 0.001), ({"least_bytes": 6}, 0.3)])
def test_round_trip(spark, options, hot):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("top", F.lit(1)).withColumn("digest", F.lit("x"))
    folder, index = write_warc(pages, hot_share=hot, **options)
    got = read_warc(folder, index, with_payload=True).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == expected(PAGES, options.get("least_bytes", 0))
    payloads = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response" and r["page_id"] is not None}
    assert payloads[6].decode() == PAGES[6][2] and payloads[5] == b"<p>same</p>"
    one = read_warc(folder, index.where("page_id = 6")).collect()
    assert [(r["page_id"], r["url"]) for r in one] == [(6, "http://f/")]


def test_no_pages(spark):
    folder, index = write_warc(spark.createDataFrame([], "page_id long, url string, html string"))
    assert read_warc(folder, index).count() == 0


def test_damage_is_noticed():
    raw = record(1, "http://a/", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, "1970-01-01T00:00:00Z")
    assert parse(raw)[2] == b"payload"
    for broken in (raw[:-1], raw.replace(b"payload", b"pAyload"), raw[1:]):
        with pytest.raises(ValueError):
            parse(broken)


def test_query(spark):
    got = LLM_CATALOG["op9_warc"](spark, FOLDER).collect()
    rows = list(read_table(FOLDER, "pages")[["page_id", "url", "html"]].itertuples(index=False, name=None))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == expected(rows)


def test_reading_is_dealt_by_the_bytes_named(spark, monkeypatch):
    rows = [(f"f{i % 3}", 1000 * (i // 3), 1000) for i in range(3000)]
    places = spark.createDataFrame(rows, "file string, offset long, length long")
    monkeypatch.setattr(common, "READ_BYTES", 100_000)
    monkeypatch.setattr(common, "STRETCH", 10_000)
    task = F.spark_partition_id().alias("task")
    dealt = common.dealt_by_bytes(places, "file").select("*", task).collect()
    assert len(dealt) == 3000 and 20 <= len({r["task"] for r in dealt}) <= 30
    for number in {r["task"] for r in dealt}:
        own = [(r["file"], r["offset"]) for r in dealt if r["task"] == number]
        assert own == sorted(own)
    assert len({(r["file"], r["offset"] // 10_000, r["task"]) for r in dealt}) == 300
    assert common.dealt_by_bytes(places.limit(0), "file").count() == 0
