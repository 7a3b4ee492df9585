import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm_fixtures import FOLDER, read_table
from shelfwise.llm import token_store
from shelfwise.llm.queries import LLM_CATALOG
from shelfwise.llm.tokens import encoder, tokenizer_path


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    h1, h2 = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
    sizes, bits, slots = token_store.build_hash(h1, h2)
    assert sorted(slots.tolist()) == list(range(n))
    raw = np.frombuffer(bits, np.uint8)
    assert (token_store.find_slots(h1, h2, sizes, raw, token_store.ranks_of(raw)) == slots).all()


def test_equal_hashes_raise():
    with pytest.raises(ValueError, match="128"):
        token_store.build_hash(np.array([5, 5], np.uint64), np.array([6, 6], np.uint64))


def expected(rows):
    """Rows in key order (null first), with start, count and checksum worked out one by one."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [np.append(np.frombuffer(x, "<u4"), 2).astype("<u4") for x in encoder(tokenizer_path()).whole([r[1] or "" for r in rows])]
    return [(r[0], len(i), zlib.crc32(i.tobytes())) for r, i in zip(rows, ids, strict=True)]


def test_round_trip_of_odd_rows(odd_docs, odd_rows):
    clash = odd_docs.withColumn("part", F.lit("x")).withColumn("copy", F.lit("y"))
    store = token_store.write_store(clash)
    keys = token_store.keys_of(clash)
    got = token_store.read_back(store, token_store.locate(store, keys), keep_ids=True).orderBy("start").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])  # noqa: E731  rows of one key may stand in any order
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(expected(odd_rows), key=key)
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    assert [r["doc_id"] for r in got] == [r[0] for r in expected(odd_rows)]
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)


def test_unknown_keys_are_told(spark, odd_docs):
    store = token_store.write_store(odd_docs)
    asked = spark.createDataFrame([(7, 0), (7, 3), (5, 0), (None, 1), (None, 2)], "doc_id long, copy long")
    found = {(r["doc_id"], r["copy"]): r["part"] is not None for r in token_store.locate(store, asked).collect()}
    assert found == {(7, 0): True, (7, 3): False, (5, 0): False, (None, 1): True, (None, 2): False}


def test_no_documents(no_docs):
    store = token_store.write_store(no_docs)
    assert token_store.read_back(store, token_store.locate(store, token_store.keys_of(no_docs))).count() == 0


def test_query(spark):
    got = LLM_CATALOG["op1_token_store"](spark, FOLDER).toPandas().sort_values("doc_id")
    docs = read_table(FOLDER, "documents")
    want = expected(list(docs[["doc_id", "text"]].itertuples(index=False)))
    assert list(zip(got["doc_id"], got["n_tokens"], got["ids_crc32"], strict=True)) == want
    assert (got["start"].to_numpy() == np.cumsum([0, *(w[1] for w in want)])[:-1]).all()
    assert isinstance(got, pd.DataFrame)
