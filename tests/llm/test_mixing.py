import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.llm.mixing import Target, find_exponent, mix
from shelfwise.llm.queries import LLM_CATALOG

FOLDER = "/root/testdata/sf0.001"


def powers(sizes, exponent):
    p = np.array(sizes, dtype=float) / sum(sizes)
    return p**exponent / (p**exponent).sum()


def entropy(w):
    return float(-(w * np.log(w)).sum())


def plainly(sizes, target):
    """The exponent by bisection, one value at a time."""
    budget, least = target.budget or sum(sizes), target.entropy * math.log(len(sizes))
    most = lambda a: (budget * powers(sizes, a) / np.array(sizes)).max()
    if entropy(powers(sizes, 1)) >= least:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(powers(sizes, mid)) >= least else (low, mid)
    if most(low) > target.repetitions:
        if most(1) > target.repetitions:
            return 1.0
        high = 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if most(mid) > target.repetitions else (low, mid)
    return low


@pytest.mark.parametrize(
    ("sizes", "target"),
    [
        ([1000, 10, 10, 5], Target(entropy=0.9, repetitions=1e9)),
        ([1000, 10, 10, 5], Target(entropy=0.9, repetitions=6)),
        ([1000, 10, 10, 5], Target(budget=9000, entropy=0.5, repetitions=2)),
        ([10, 10, 10], Target()),
        ([70], Target()),
    ],
)
def test_exponent(spark, sizes, target):
    totals = spark.createDataFrame([(s,) for s in sizes], "tokens long")
    assert find_exponent(totals, target) == pytest.approx(plainly(sizes, target), abs=1e-5)


def rows_of(counts, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, s, int(rng.integers(1, 50))) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]


@pytest.mark.parametrize("target", [Target(), Target(budget=200_000, entropy=0.99), Target(budget=3000, entropy=0.8)])
def test_budgets_and_whole_epochs(spark, target):
    rows = rows_of({"a": 5000, "b": 300, None: 120})
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").repartition(3)
    got = mix(df, target).collect()
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    names = list(sizes)
    weights = powers(list(sizes.values()), plainly(list(sizes.values()), target))
    for name, weight in zip(names, weights, strict=True):
        budget = weight * (target.budget or sum(sizes.values()))
        own = [r for r in got if r["source"] == name]
        spent = sum(r["n_tokens"] for r in own)
        assert budget - 60 < spent <= budget + 1
        per_epoch = defaultdict(list)
        for r in own:
            per_epoch[r["epoch"]].append(r)
        last = max(per_epoch, default=0)
        assert sorted(per_epoch) == list(range(last + 1)) if own else True
        for epoch, drawn in per_epoch.items():
            ids = [r["doc_id"] for r in drawn]
            assert len(ids) == len(set(ids))
            if epoch < last:
                assert len(ids) == sum(s == name for _, s, _ in rows)
    # The last epoch is a prefix of its permutation: blocks in order, and rows in order within the last block.
    for name in names:
        own = [r for r in got if r["source"] == name]
        last = max((r["epoch"] for r in own), default=None)
        ranks = Counter(r["block_rank"] for r in own if r["epoch"] == last)
        assert len(ranks) <= 2


def test_same_rows_whatever_the_partitioning(spark):
    df = spark.createDataFrame(rows_of({"a": 3000, "b": 30}), "doc_id long, source string, n_tokens long")
    draws = [sum(r["n_tokens"] for r in mix(df.repartition(n)).collect()) for n in (1, 6)]
    assert abs(draws[0] - draws[1]) < 100


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumnRenamed("lang", "epoch").withColumnRenamed("text", "mix_row")
    got = mix(clash, tokens="n_chars")
    assert got.columns == [*clash.columns, "epoch_", "block", "block_rank", "row_rank"]
    assert {r["source"] for r in got.collect()} <= {"a", "b", "c", None}
    assert mix(no_docs, tokens="n_chars").count() == 0
    zero = spark.createDataFrame([(1, "a", 0), (2, "a", None), (3, "b", 5)], "doc_id long, source string, n_tokens long")
    assert [r["doc_id"] for r in mix(zero).collect()] == [3]


def test_query(spark):
    got = LLM_CATALOG["op10_temperature_mixing"](spark, FOLDER).toPandas()
    spent = got.groupby("source")["n_tokens"].sum()
    w = spent / spent.sum()
    assert entropy(w.to_numpy()) >= 0.94 * math.log(len(w))
    assert got["epoch"].max() < 5
