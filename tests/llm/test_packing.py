import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import FOLDER, read_table
from shelfwise.llm import packing
from shelfwise.llm.queries import LLM_CATALOG
from shelfwise.llm.tokens import encoder, tokenizer_path


def one_by_one(lengths, capacity):
    """Best fit, longest first; gives the gaps of the sequences."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps[gaps.index(min(fits))] -= length
        else:
            gaps.append(capacity - length)
    return sorted(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=80))
def test_plan_is_best_fit(lengths):
    counts = Counter(lengths)
    runs = packing.plan(counts, 24)
    filled = {}
    for length in counts:
        own = [r for r in runs if r[0] == length]
        firsts = [r[1] for r in own] + [counts[length]]
        assert firsts[0] == 0 and firsts == sorted(set(firsts))
        for (_, rank, sequence, offset), upto in zip(own, firsts[1:], strict=True):
            for k in range(upto - rank):
                filled.setdefault(sequence + k, []).append((offset, length))
    for pieces in filled.values():
        pieces.sort()
        ends = np.cumsum([p[1] for p in pieces])
        assert [p[0] for p in pieces] == [0, *ends[:-1]] and ends[-1] <= 24
    assert sorted(24 - sum(p[1] for p in pieces) for pieces in filled.values()) == one_by_one(lengths, 24)


def check(rows, got, capacity, end):
    ids = {}
    for key, raw in zip([r[0] for r in rows], encoder(tokenizer_path()).whole([r[1] or "" for r in rows]), strict=True):
        ids.setdefault(key, []).append(np.append(np.frombuffer(raw, "<u4"), end).astype("<u4"))
    want = Counter()
    for key, own in ids.items():
        for x in own:
            cut = len(x) % capacity or capacity
            edges = [0, *range(cut, len(x) + 1, capacity)] if len(x) > capacity else [0, len(x)]
            for n, (a, b) in enumerate(zip(edges, edges[1:])):
                want[key, n, a, b - a, zlib.crc32(x[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        pieces.sort()
        ends = np.cumsum([p[1] for p in pieces])
        assert [p[0] for p in pieces] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert sorted(capacity - sum(p[1] for p in ps) for ps in by_sequence.values()) == one_by_one([r["length"] for r in got], capacity)
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [2048, 7])
def test_odd_rows(odd_docs, odd_rows, capacity):
    got = packing.pack(odd_docs, capacity, keep_ids=True).collect()
    used = check(odd_rows, got, capacity, 0)
    assert used == len(one_by_one([r["length"] for r in got], capacity))
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)


def test_no_documents(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_query(spark):
    got = LLM_CATALOG["op7_best_fit_packing"](spark, FOLDER).collect()
    docs = read_table(FOLDER, "documents")
    used = check(list(docs[["doc_id", "text"]].itertuples(index=False)), got, 2048, 0)
    assert used == len(one_by_one([r["length"] for r in got], 2048))
