import math

import numpy as np
import pytest
from llm_fixtures import read_table
from pyspark.sql import functions as F

from shelfwise.llm.permutations import InvertedFiles, distances, nearest, nearest_pivots
from shelfwise.llm.queries import LLM_CATALOG

SCHEMA = "vec_id long, embedding array<double>, extra string"


def plainly(rows, wanted, k=10):
    """All distances; rows are (vec_id, vector)."""
    sound = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in sound:
        if wanted(i):
            near = sorted((math.dist(v, w), j) for j, w in sound if j != i and len(w) == len(v))[:k]
            out += [(i, rank, j, d) for rank, (d, j) in enumerate(near, 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-12)


def test_gain_is_footrule():
    rng = np.random.default_rng(3)
    points, pivots, m = rng.normal(size=(50, 6)), rng.normal(size=(20, 6)), 7
    index, orders = InvertedFiles(points, pivots, m), nearest_pivots(points, pivots, m)
    places = np.full((50, 20), m)
    for row, order in zip(places, orders):
        row[order] = np.arange(m)
    for i in range(50):
        footrule = np.abs(places - places[i]).sum(axis=1)
        assert (m * (m + 1) - 2 * index.gains(orders[i])).tolist() == footrule.tolist()
        depth = 9
        found = index.candidates(orders[i], depth)
        assert set(found) == set(np.flatnonzero(footrule <= np.sort(footrule)[depth - 1]))


def test_recall_over_many_shards(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)] * 0.4 + rng.normal(size=(3000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    got = nearest(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), F.col("vec_id") % 20 == 0, shard=700, pivots=64, prefix=32)
    got, want = rows_of(got), plainly(rows, lambda i: i % 20 == 0)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    worst = {w[0]: w[3] for w in want}
    assert sum(g[3] <= worst[g[0]] * (1 + 1e-12) for g in got) >= 0.95 * len(want)


def test_copies_and_ties(spark):
    rows = [(i, [1.0, 2.0]) for i in range(100)] + [(200 + i, [1.0, 2.0 + (i % 4)]) for i in range(40)] + [(300 + i, [float(i), 0.0]) for i in range(1, 9)]
    got = nearest(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), F.col("vec_id") % 20 == 0)
    same(rows_of(got), plainly(rows, lambda i: i % 20 == 0))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [None, 1.0]), (None, [1.0, 0.0]), (7, [1e200, 1e200]), (8, [1e-200, 0.0]), (20, [1.0, 0.0, 0.0]), (21, [0.0, 1.0, 0.0]),
        (40, [1.0]), (60, []), (80, [2e-200, 0.0]), (100, None),
    ]
    got = nearest(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).withColumnRenamed("extra", "nid"), F.col("vec_id") % 20 == 0)
    same(rows_of(got), plainly(rows, lambda i: i % 20 == 0))


def test_no_rows(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0], "x")], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_distances_neither_overflow_nor_vanish():
    assert distances(np.array([[3e200, 4e200], [0.0, 0.0]]), np.zeros(2))[0] == pytest.approx(5e200)
    assert distances(np.array([[3e-200, 4e-200]]), np.zeros(2))[0] == pytest.approx(5e-200)


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    table = read_table(folder, "embeddings")
    points, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    got = LLM_CATALOG["op11_permutation_index"](spark, folder).toPandas()
    hits = 0
    queries = np.flatnonzero(ids % 100 == 0)
    for i in queries:
        apart = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
        own = got[got.query_id == ids[i]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        assert own["score"].tolist() == pytest.approx([apart[ids == v][0] for v in own["vec_id"]], rel=1e-12)
        assert own["score"].is_monotonic_increasing and ids[i] not in set(own["vec_id"])
        hits += (own["score"] <= np.sort(np.delete(apart, i))[9] + 1e-12).sum()
    assert len(got) == 10 * len(queries)
    assert hits >= 0.95 * len(got)
