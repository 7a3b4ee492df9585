import math

import numpy as np
import pytest
from llm_fixtures import FOLDER, read_table
from pyspark.sql import functions as F

from shelfwise.llm.negatives import MOST, mine, products
from shelfwise.llm.queries import LLM_CATALOG

SCHEMA = "vec_id long, embedding array<double>, label int, extra string"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plainly(rows, is_anchor, positives=5, negatives=3):
    """Every pair scored; rows are (vec_id, vector, label)."""
    sound = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.append((i, label, tuple(math.floor(256 * x) for x in v), tuple(v)))
    sound, out = set(sound), []
    for a in sound:
        if not is_anchor(a[0]):
            continue
        others = [(max(-MOST, min(MOST, sum(x * y for x, y in zip(a[2], b[2])))), b[0], b[1]) for b in sound if b[0] != a[0] and len(a[2]) == len(b[2])]
        others.sort(key=lambda o: (-o[0], o[1]))
        for score, i, _ in [o for o in others if o[2] == a[1]][:positives]:
            window = [o for o in others if o[2] != a[1] and 50 * score <= 100 * o[0] <= 95 * score]
            out += [(a[0], i, rank, o[1], score, o[0]) for rank, o in enumerate(window[:negatives], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


def cloud(n, seed=0, labels=4, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    return [(int(i), (0.6 * centres[rng.integers(labels)] + rng.normal(size=width)).tolist(), int(rng.integers(labels))) for i in rng.permutation(n)]


@pytest.mark.parametrize("shard", [16_384, 60])
def test_against_every_pair(spark, shard):
    rows = cloud(400)
    got = mine(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3), F.col("vec_id") % 7 == 0, shard=shard)
    assert rows_of(got) == plainly(rows, lambda i: i % 7 == 0)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 0.5], i % 3) for i in range(60)] + [(100 + i, [0.9, 0.3], i % 2) for i in range(20)] + [(200 + i, [0.0, 0.0], i % 2) for i in range(5)]
    for shard in (16_384, 10):
        got = mine(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), F.col("vec_id") % 10 == 0, shard=shard)
        assert rows_of(got) == plainly(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (0, [0.5, 0.0], 1), (1, [0.9, 0.0], 0), (1, [0.9, 0.0], 0), (2, [0.8, 0.0], 1),
        (3, None, 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (None, [1.0, 0.0], 1), (7, [1.0, 0.0], None),
        (8, [1.0, 0.0, 0.0], 0), (9, [0.7, 0.0, 0.0], 1), (10, [1.0, 0.2, 0.0], 0), (11, [-1.0, 0.0], 0), (12, [-0.9, 0.0], 1),
        (20, [], 0), (21, [], 0), (22, [], 1), (30, [0.0, 0.0], 0),
    ]
    got = mine(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).withColumnRenamed("extra", "anchor"), F.col("vec_id") % 10 == 0)
    assert rows_of(got) == plainly(rows, lambda i: i % 10 == 0)


def test_scores_stay_exact(spark):
    big = 3e7 + 1 / 256
    rows = [(0, [big, big], 0), (1, [big, 1.0], 0), (2, [big / 2, 3.0], 1), (3, [big * 0.7, 5.0], 1), (4, [1e30, 1e30], 0), (5, [-1e30, 2.0], 1)]
    got = mine(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), F.col("vec_id") == 0)
    assert rows_of(got) == plainly(rows, lambda i: i == 0)
    assert products(np.array([[2.0**40]]), np.array([[2.0**20 + 1]])).tolist() == [[2**60 + 2**40]]


def test_no_rows(spark):
    assert mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 7 == 0).count() == 0
    assert mine(spark.createDataFrame([(1, [1.0], 0, "x")], SCHEMA), F.col("vec_id") % 7 == 0).count() == 0


def test_query(spark):
    table = read_table(FOLDER, "embeddings")
    rows = [
        (int(i), list(map(float, v)), (int(l) + 1) % 10 if i % 7 == 0 else int(l))
        for i, v, l in zip(table["vec_id"], table["embedding"], table["label"])
    ]
    assert rows_of(LLM_CATALOG["op13_hard_negatives"](spark, FOLDER)) == plainly(rows, lambda i: i % 50 == 0)
