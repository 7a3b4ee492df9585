import math
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import FOLDER, read_table

from shelfwise.llm import vectors
from shelfwise.llm.components import components
from shelfwise.llm.hnsw import Graph
from shelfwise.llm.queries import LLM_CATALOG
from shelfwise.llm.vectors import BEAM, MARGIN, audited_search, compared, cosines, near_vectors, pair_marks, searched, unit

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def plainly(rows, least=0.98):
    """Every pair compared; rows are (vec_id, vector, label)."""
    sound = []
    for v, label in ((r[1], r[2]) for r in rows):
        ok = label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        sound.append(unit(np.array([np.float32(x) for x in v], dtype=np.float64)[None])[0] if ok else None)
    links = defaultdict(set)
    for i, a in enumerate(sound):
        for j in range(i):
            b = sound[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= least:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        component = min(ids, default=None)
        out.append((r[0], len(links[i]), component, r[0] == component))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def clusters(n, seed=0, labels=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    spread = rng.choice([0.02, 0.07, 0.12], size=n)[:, None]
    points = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, 8))
    return [(int(i), [float(np.float32(x)) for x in p], int(rng.integers(0, labels))) for i, p in enumerate(points)]


@pytest.mark.parametrize(("shard", "queries"), [(16_384, 2048), (50, 30)])
def test_links_and_components(spark, shard, queries):
    rows = clusters(300)
    got = near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), shard=shard, queries=queries)
    assert rows_of(got) == plainly(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2e30, 1e29], 0), (4, [-1.0, 0.0], 0),
        (5, [1.0, 0.0], 1), (6, [1.0, 0.0], None), (7, [1.0, 0.0], None), (8, None, 0), (9, [0.0, 0.0], 0), (10, [0.0, 0.0], 0),
        (11, [nan, 1.0], 0), (12, [inf, 1.0], 0), (13, [None, 1.0], 0), (14, [1.0, 0.0, 0.0], 0), (15, [], 0),
        (None, [1.0, 0.01], 0), (None, [0.0, 1.0], 3), (16, [1e-30, 0.0], 0), (17, [0.1, 1.0], 3),
    ]
    assert rows_of(near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))) == plainly(rows)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_search_finds_links_in_tight_groups():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(800, 16)), rng.normal(size=(1, 16)) + 0.01 * rng.normal(size=(400, 16))])
    points = unit(points[rng.permutation(len(points))]).astype(np.float32)
    graph = Graph.load(Graph(points).dump())
    found = audited_search(graph, points, 0.98)
    truth = (points @ points.T >= 0.98).sum()
    assert sum(map(len, found)) >= 0.99 * truth


def unlinked(n=3000, far=25):
    """Pairs of near vectors, and a graph that no link leads to the later half of ``far`` of them."""
    rng = np.random.default_rng(5)
    half = rng.normal(size=(n // 2, 16))
    points = unit(np.concatenate([half, half + 0.01 * rng.normal(size=half.shape)])).astype(np.float32)
    graph = Graph(points)
    for table in graph.links:
        table[(table >= n // 2 + 1) & (table <= n // 2 + far)] = -1
    return graph, points


def directed(found):
    return {(i, int(j)) for i, own in enumerate(found) for j in own}


def test_graph_finds_links_of_groups_of_any_size():
    """Groups of 1 to 300: what the graph alone finds, counted from either end, is nearly every link."""
    rng = np.random.default_rng(11)
    sizes = [1] * 600 + [2] * 100 + [5] * 40 + [20] * 10 + [100] * 3 + [300]
    points = np.concatenate([rng.normal(size=(1, 32)) + 0.01 * rng.normal(size=(n, 32)) for n in sizes])
    points = unit(points[rng.permutation(len(points))]).astype(np.float32)
    graph = Graph.load(Graph(points).dump())
    floor = 0.98 - MARGIN
    found, true = directed(searched(graph, points, floor, BEAM)), directed(compared(graph, points, floor))
    assert found <= true
    assert len(found) >= 0.999 * len(true)
    assert len(true - found - {(j, i) for i, j in found}) <= 1e-4 * len(true)


def test_links_missed_from_one_end_are_told_by_marks():
    graph, points = unlinked()
    floor = 0.98 - MARGIN
    found, true = searched(graph, points, floor, BEAM), compared(graph, points, floor)
    out, into = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for i, own in enumerate(found):
        own = own[own != i]
        out[i] = np.bitwise_xor.reduce(pair_marks(i, own), initial=0)
        into[own] ^= pair_marks(i, own)
    short = [i for i, (own, all_) in enumerate(zip(found, true)) if set(all_) - set(own) - {i}]
    assert short and set(short) <= set(np.flatnonzero(out != into))


def test_failed_audits_widen_beams_and_end_in_comparison():
    graph, points = unlinked(600, far=100)
    true = compared(graph, points, 0.98 - MARGIN)
    assert [own.tolist() for own in audited_search(graph, points, 0.98)] == [own.tolist() for own in true]


def test_missed_links_are_counted_from_both_ends(spark, monkeypatch):
    """A search that sees links from their larger end only still gives every count."""
    rows = clusters(200)
    blind = lambda graph, queries, least: [own[own < i] for i, own in enumerate(compared(graph, queries, least - MARGIN))]
    monkeypatch.setattr(vectors, "audited_search", blind)
    assert rows_of(near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))) == plainly(rows)


def test_cosines_are_equal_from_both_ends():
    rng = np.random.default_rng(7)
    points = unit(rng.normal(size=64) + 0.05 * rng.normal(size=(60, 64)))
    for _ in range(300):
        i, j = rng.choice(60, 2, replace=False)
        some, others = (rng.choice(60, rng.integers(1, 20)) for _ in "ab")
        assert cosines(points[[*some, j]], points[i])[-1] == cosines(points[[*others, i]], points[j])[-1]


def test_queries_with_more_links_than_a_beam():
    rng = np.random.default_rng(6)
    points = unit(np.concatenate([rng.normal(size=(4500, 16)), rng.normal(size=(1, 16)) + 0.01 * rng.normal(size=(150, 16))])).astype(np.float32)
    found = searched(Graph(points), points, 0.98 - MARGIN, BEAM)
    assert all(np.isin(np.arange(4500, 4650), own).all() for own in found[4500:])


def test_query(spark):
    table = read_table(FOLDER, "embeddings")
    rows = [(int(a), list(map(float, b)), int(c)) for a, b, c in zip(table["vec_id"], table["embedding"], table["label"], strict=True)]
    assert rows_of(LLM_CATALOG["op2_hnsw_near_dedup"](spark, FOLDER)) == plainly(rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 50), (7, 7), (201, 200), (200, 201), (300, 305), (305, 310), (310, 300)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    assert {r["node"]: r["component"] for r in got} == {**dict.fromkeys([*range(61), 100], 0), 200: 200, 201: 200, 300: 300, 305: 300, 310: 300}
    assert len({r["node"] for r in got}) == len(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
