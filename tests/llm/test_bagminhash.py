from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import FOLDER, LONG, read_table

from shelfwise.llm import bagminhash
from shelfwise.llm.bagminhash import REGISTERS, deduplicated, near_duplicates, shingles, signatures, similarity
from shelfwise.llm.queries import LLM_CATALOG


def bag(text):
    words = (text or "").encode().split()
    n = min(len(words), 5)
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if n == 5 else Counter([tuple(words)] if words else [])


def plainly(rows, least=0.8):
    """Class of every row (doc_id, text), all pairs of texts compared."""
    texts = list(dict.fromkeys(r[1] or "" for r in rows))
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            both = sum((a & bags[j]).values())
            if both and both >= least * (a.total() + bags[j].total() - both):
                parent[root(i)] = root(j)
    members = {}
    for r in rows:
        members.setdefault(root(texts.index(r[1] or "")), []).append(r[0])
    least_of = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return Counter((r[0], least_of[root(texts.index(r[1] or ""))]) for r in rows)


def test_registers_agree_as_often_as_multisets_overlap():
    rng = np.random.default_rng(5)
    alike, exact = [], []
    for _ in range(60):
        shared = rng.integers(0, 1 << 62, 120).astype(np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 62, k).astype(np.uint64)])) for k in rng.integers(1, 200, 2))
        one, two = ((x, rng.integers(1, 40, len(x))) for x in (a, b))
        s = signatures([one, two])
        alike.append((s[0] == s[1]).mean())
        exact.append(similarity(one, two))
    assert abs(np.mean(alike) - np.mean(exact)) < 4 * 0.5 / np.sqrt(60 * REGISTERS)
    assert np.abs(np.array(alike) - exact).max() < 5 * 0.5 / np.sqrt(REGISTERS)


def test_signature_does_not_depend_on_its_neighbours():
    bags = [shingles("a b c"), shingles("one two three four five six " * 9), shingles(""), shingles(LONG)]
    together = signatures(bags)
    for i, b in enumerate(bags):
        assert (signatures([b])[0] == together[i]).all()
    assert np.isinf(together[2]).all() and np.isfinite(together[[0, 1, 3]]).all()


def test_similarity_counts_repeats():
    a, b = "x y z v w " * 4, "x y z v w " * 5
    one, two = bag(a), bag(b)
    assert similarity(shingles(a), shingles(b)) == sum((one & two).values()) / sum((one | two).values())


def variants():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    rows, key = [], 0
    for group in range(12):
        text = list(rng.choice(words, int(rng.integers(6, 300))))
        for _ in range(int(rng.integers(1, 25))):
            own = list(text)
            for _ in range(int(rng.integers(0, max(2, len(text) // 40)))):
                own[int(rng.integers(0, len(own)))] = str(rng.choice(words))
            rows.append((key, " ".join(own)))
            key += 1
            if rng.random() < 0.3:
                text = own  # a chain of changes
    return rows


@pytest.mark.parametrize("block", [2000, 3])
def test_classes(spark, block, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK", block)
    rows = variants()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == plainly(rows)
    assert Counter(r["class_id"] for r in got if r["representative"]) == Counter({r["class_id"]: 1 for r in got})


@pytest.mark.parametrize("alike", [0, 1, 4])
def test_pairs_in_a_band_are_decided_by_their_overlap(alike):
    """Whether few, other or all registers agree in their marks: the first band that the pair shares is the fourth."""
    words = [f"w{i}" for i in range(100)]
    marks = np.arange(2 * REGISTERS, dtype="<u2").reshape(2, -1)
    marks[1, : alike * REGISTERS // 4] = marks[0, : alike * REGISTERS // 4]
    bands = np.arange(48).reshape(2, -1)
    bands[1, 3] = bands[0, 3]
    group = {"nid": [5, 6], "component": [5, 6], "block": [0, 0], "band": [3, 3], "low": [0, 0], "high": [0, 0]}
    group |= {"marks": [m.tobytes() for m in marks], "bands": bands.tolist(), "text": [" ".join(words), " ".join([*words, "end"])]}
    assert bagminhash._links_within(pa.table(group), 0.8) == [(5, 6)]
    assert bagminhash._links_within(pa.table(group | {"band": [5, 5]}), 0.8) == []


def test_odd_rows(odd_docs, odd_rows, no_docs):
    clash = odd_docs.withColumnRenamed("source", "node").withColumnRenamed("n_chars", "nid")
    got = near_duplicates(clash).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == plainly(odd_rows)
    kept = deduplicated(clash)
    assert kept.columns == clash.columns
    classes = {c for _, c in plainly(odd_rows)}
    rows = kept.collect()
    nameless = sum(1 for r in rows if r["doc_id"] is None)
    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == classes - {None}
    assert len(rows) == len([c for c in classes if c is not None]) + nameless + 1  # key 7 has two classes of its own
    assert deduplicated(no_docs).count() == 0


def test_query(spark):
    table = read_table(FOLDER, "documents")
    rows = list(zip(table["doc_id"].tolist(), table["text"], strict=True))
    got = LLM_CATALOG["op5_bagminhash"](spark, FOLDER).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == plainly(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
