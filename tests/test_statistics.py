"""Quantiles, ranks, analysis of variance and Q-Q points against brute force and published figures."""

import math
import statistics
from unittest.mock import MagicMock

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.functions.ftest import f_upper_tail
from shelfwise.functions.scalars import normal_quantile
from shelfwise.operators import categories as cat
from shelfwise.operators import lookup
from shelfwise.operators import plots
from shelfwise.operators import profile as prof
from shelfwise.operators.quantiles import exact_boxes, exact_quantiles

PROBS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.9, 1.0]


def skewed(rows: int = 4000) -> pd.DataFrame:
    """A third of the rows in one group, a third of those one value; negatives, zeros and missing values."""
    rng = np.random.default_rng(7)
    key = np.where(rng.random(rows) < 0.34, "hot", rng.integers(0, 40, rows).astype(str))
    value = np.round(rng.lognormal(0, 2, rows) - 3, 3)
    value[rng.random(rows) < 0.1] = 0.0
    value[(key == "hot") & (rng.random(rows) < 0.33)] = 5.25
    frame = pd.DataFrame({"k": key, "v": value})
    frame.loc[rng.random(rows) < 0.05, "v"] = np.nan
    return frame


@pytest.mark.parametrize("bins_per_e", [64, 1])
def test_grouped_quantiles_match_pandas(spark, bins_per_e):
    """Also with bins so coarse that nearly everything must be resolved exactly."""
    frame = skewed()
    got = exact_quantiles(
        spark.createDataFrame(frame).repartition(7), ["k"], "v", PROBS, bins_per_e=bins_per_e
    ).toPandas().set_index("k")
    groups = frame.groupby("k")["v"]
    assert set(got.index) == set(groups.groups)
    for k, values in groups:
        assert got.loc[k, "n"] == values.count()
        np.testing.assert_allclose(got.loc[k, "q"], values.quantile(PROBS), rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(
            got.loc[k, ["mean", "std", "min", "max", "sum"]].astype(float),
            [values.mean(), values.std(), values.min(), values.max(), values.sum()],
            rtol=1e-9,
            atol=1e-9,
        )


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, float("inf")])), min_size=1, max_size=60))
def test_global_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    row = exact_quantiles(df, [], "v", [0.0, 0.5, 1.0]).first()
    present = sorted(v for v in values if v is not None)
    assert row["n"] == len(present)
    if present:
        assert row["q"][0] == present[0] and row["q"][2] == present[-1]
        middle = statistics.median(present)
        assert row["q"][1] == pytest.approx(middle, rel=1e-12) or math.isinf(middle) or math.isnan(row["q"][1])
    else:
        assert row["q"] is None


def test_all_missing_group_is_kept(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    rows = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", [0.5]).collect()}
    assert rows["a"]["n"] == 0 and rows["a"]["q"] is None
    assert rows["b"]["q"] == [2.0] and rows["b"]["std"] is None


@pytest.mark.parametrize("piece", [1_000_000, 7])
def test_qq_points_are_complete_and_in_order(spark, piece):
    frame = skewed(900).dropna()
    points = plots.qq_points(spark.createDataFrame(frame), "v", piece=piece)
    got = points.orderBy("rank").toPandas()
    n = len(frame)
    assert list(got["rank"]) == list(range(1, n + 1))
    assert list(got["value"]) == sorted(frame["v"])
    position = (got["rank"] - 0.3175) / (n + 0.365)
    position.iloc[0], position.iloc[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    expected = [statistics.NormalDist().inv_cdf(p) for p in position]
    np.testing.assert_allclose(got["theoretical"], expected, atol=1e-12)
    fit = plots.qq_fit(points).first()
    assert fit["r"] == pytest.approx(np.corrcoef(expected, got["value"])[0, 1], rel=1e-9)


def test_normal_quantile(spark):
    p = [1e-300, 1e-20, 1e-6, 0.01, 0.075, 0.3, 0.5, 0.8, 0.975, 1 - 1e-9]
    rows = spark.createDataFrame([(x,) for x in p], "p double").select("p", normal_quantile(F.col("p")).alias("z")).collect()
    for r in rows:
        assert r["z"] == pytest.approx(statistics.NormalDist().inv_cdf(r["p"]), rel=1e-12, abs=1e-14)


# Published group summaries (mean, standard deviation, count) and the F statistics they lead to.
FAT = [(2157.71, 1697.97, 5517), (2224.56, 1721.48, 3006)]


def test_published_anova_is_reproduced(spark):
    rows = [("fat", str(i), n, m, s * s * (n - 1) / n) for i, (m, s, n) in enumerate(FAT)]
    moments = spark.createDataFrame(rows, "feature string, value string, n bigint, mean double, variance double")
    got = cat.with_p_values(cat.anova_from_moments(moments)).first()
    assert got["f_statistic"] == pytest.approx(2.9867, rel=1e-3)
    assert (got["df_between"], got["df_within"]) == (1, 8521)


def test_published_p_values(spark):
    df = spark.createDataFrame([(2.9867, 1.0, 8521.0), (2.7007, 15.0, 8507.0), (0.0, 3.0, 10.0)], "f double, a double, b double")
    p = [r[0] for r in df.select(f_upper_tail(F.col("f"), F.col("a"), F.col("b"))).collect()]
    assert p[0] == pytest.approx(0.0840, abs=5e-5)
    assert p[1] == pytest.approx(0.0004, abs=5e-5)
    assert p[2] == 1.0


def chi_square_tail(u, half):
    """Upper tail of the chi-square distribution with an even number of degrees of freedom, 2 x ``half``."""
    return math.exp(-u / 2) * sum((u / 2) ** k / math.factorial(k) for k in range(half))


def test_p_values_of_many_rows_reach_the_chi_square_limit(spark):
    cases = [(d1, f, rows) for d1 in (2, 6, 20) for f in (0.5, 1.0, 2.1, 3.0, 12.0) for rows in (1e9, 1e10, 1e11, 1e12, 1e13, 1e14)]
    df = spark.createDataFrame([(f, float(d1), n) for d1, f, n in cases], "f double, a double, b double")
    p = [r[0] for r in df.select(f_upper_tail(F.col("f"), F.col("a"), F.col("b"))).collect()]
    for (d1, f, rows), got in zip(cases, p, strict=True):
        limit = chi_square_tail(d1 * f, d1 // 2)
        # The limit itself is off by about (d1 F)^2 / (4 rows).
        assert got == pytest.approx(limit, rel=1e-9 + (d1 * f + 2) ** 2 / rows), (d1, f, rows)


def test_p_values_agree_where_the_ways_meet(spark):
    """Closed form for two degrees of freedom: (1 + 2 F / d2) ** (-d2 / 2)."""
    cases = [(f, 2.0, d2) for f in (0.01, 0.9, 3.0, 40.0) for d2 in (10.0, 1e3, 2e5, 5.6e5, 5.8e5, 1e7, 1e9)]
    df = spark.createDataFrame(cases, "f double, a double, b double")
    p = [r[0] for r in df.select(f_upper_tail(F.col("f"), F.col("a"), F.col("b"))).collect()]
    for (f, _, d2), got in zip(cases, p, strict=True):
        assert got == pytest.approx(math.exp(-d2 / 2 * math.log1p(2 * f / d2)), rel=1e-10), (f, d2)


def test_published_fences():
    q1, q3 = 834.2474, 3101.2964
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (round(low, 2), round(high, 2)) == (-2566.33, 6501.87)


def test_display_rounding_takes_cv_from_rounded_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0)], "o string, y double")
    row = cat.outlet_performance(df, "o", "y", digits=2).first()
    assert (row["mean"], row["std"], row["cv"]) == (2.33, 1.53, 0.657)


def test_one_group_has_no_anova_row(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0), ("x", "b", 4.0)], "one string, two string, y double")
    assert [r["feature"] for r in cat.anova_f(df, ["one", "two"], "y").collect()] == ["two"]


def test_anova_keeps_precision_far_from_zero(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(0, 1, 300)
    g = rng.integers(0, 3, 300).astype(str)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "near": y, "far": y + 1e9}))
    near, far = (cat.anova_f(df, ["g"], c).first()["f_statistic"] for c in ("near", "far"))
    assert far == pytest.approx(near, rel=1e-5)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in prof.correlation_matrix(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0}


def test_correlation_is_pairwise_complete(spark):
    frame = pd.DataFrame({"a": [1.0, 2, 3, None, 5], "b": [2.0, 1, None, 4, 7], "c": [5.0, 1, 2, 2, None]})
    df = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in frame.values], "a double, b double, c double")
    want = frame.corr()
    for r in prof.correlation_matrix(df, ["a", "b", "c"]).collect():
        assert r["corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]])


def test_histogram_edges(spark):
    values = [0.0, 1.0, 2.0, 2.5, 9.999, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["n"] for r in plots.histogram(df, ["x"], 10).collect()]
    assert got == list(np.histogram(values, bins=10)[0])
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r["n"] for r in plots.histogram(constant, ["x"], 4).collect()] == list(np.histogram([3.0, 3.0], bins=4)[0])


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert prof.duplicate_rows(df).first()[0] == 2


def test_equal_width_bands(spark):
    labels = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([(float(x), 1.0) for x in (0, 2, 2.1, 10)], "p double, y double")
    assert [(r["band"], r["n"]) for r in cat.price_band_stats(df, "p", "y", labels).collect()] == [
        ("a", 2), ("b", 1), ("c", 0), ("d", 0), ("e", 1),
    ]
    constant = spark.createDataFrame([(5.0, 1.0)], "p double, y double")
    assert [r["n"] for r in cat.price_band_stats(constant, "p", "y", labels).collect()] == [0, 0, 1, 0, 0]


def test_long_pivot_has_no_limit(spark):
    df = spark.createDataFrame([("r", str(i), float(i)) for i in range(1500)] + [("r", "7", 9.0), (None, "7", 1.0)], "r string, c string, y double")
    got = {(r["row_label"], r["column_label"]): r["mean"] for r in cat.pivot_cells(df, "r", "c", "y").collect()}
    assert len(got) == 1500 and got["r", "7"] == 8.0 and got["r", "9"] == 9.0


def test_pivot_refuses_too_many_labels(spark):
    df = spark.createDataFrame([("r", str(i), 1.0) for i in range(5)], "r string, c string, y double")
    with pytest.raises(ValueError, match="more than 3"):
        cat.pivot_mean(df, "r", "c", "y", max_labels=3)


@pytest.mark.parametrize("bins_per_e", [64, 1])
def test_boxes_match_pandas(spark, bins_per_e):
    """Fences cut bins, in coarse bins nearly all of them; a third of the rows in one group."""
    frame = skewed()
    got = exact_boxes(spark.createDataFrame(frame).repartition(7), ["k"], "v", bins_per_e=bins_per_e).toPandas().set_index("k")
    assert set(got.index) == set(frame["k"])
    for k, values in frame.groupby("k")["v"]:
        q1, median, q3 = values.quantile([0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        expected = [len(values), values.count(), q1, median, q3, values[values >= low].min(), values[values <= high].max()]
        np.testing.assert_allclose(got.loc[k, ["rows", "n", "q1", "median", "q3", "low", "high"]].astype(float), expected, rtol=1e-12)
        assert got.loc[k, "outside"] == ((values < low) | (values > high)).sum()


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100), st.sampled_from([0.0, 1.0, 1e9])), min_size=1, max_size=40))
def test_global_box_matches_numpy(spark, values):
    row = exact_boxes(spark.createDataFrame([(v,) for v in values], "v double").repartition(3), [], "v").first()
    present = np.array([v for v in values if v is not None])
    assert (row["rows"], row["n"]) == (len(values), len(present))
    if len(present):
        low, high = row["q1"] - 1.5 * (row["q3"] - row["q1"]), row["q3"] + 1.5 * (row["q3"] - row["q1"])
        assert row["outside"] == ((present < low) | (present > high)).sum()
        np.testing.assert_allclose([row["q1"], row["median"], row["q3"]], np.quantile(present, [0.25, 0.5, 0.75]), rtol=1e-12, atol=1e-300)


def test_boxes_scan_the_rows_twice(spark, tmp_path):
    """Counted where the rows are read: no third pass looks for whiskers."""
    frame, reads = skewed(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.createDataFrame(frame).mapInPandas(counted, "k string, v double")
    plots.box_stats(df, "v", ["k"]).collect()
    assert reads.value == 2 * len(frame)


def test_outliers_of_no_rows_and_of_missing_values(spark):
    empty = spark.createDataFrame([], "v double")
    assert prof.iqr_outliers(empty, "v").first()["outlier_count"] == 0
    gaps = prof.iqr_outliers(spark.createDataFrame([(None,), (None,)], "v double"), "v").first()
    assert (gaps["q1"], gaps["outlier_count"], gaps["outlier_pct"]) == (None, 0, 0.0)
    assert plots.box_stats(empty, "v").count() == 0


def test_duplicates_are_compared_whole_only_where_a_hash_repeats(spark, monkeypatch):
    rows = [(i, "x" if i % 3 else None) for i in range(300)] + [(1, "x")] * 200 + [(None, None)] * 5
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    expected = len(rows) - len(set(rows))
    assert prof.duplicate_rows(df).first()[0] == expected
    # Hashes skip NULLs, so these two rows share one and must be told apart by their columns.
    assert prof.duplicate_rows(spark.createDataFrame([("a", None), (None, "a")], "a string, b string")).first()[0] == 0
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)  # repeats too many to broadcast, one of them hot
    assert prof.duplicate_rows(df).first()[0] == expected


def test_profile_shares_passes(spark, monkeypatch):
    """Numbers are described once and the target is boxed once; sections equal those worked out by themselves."""
    from shelfwise.config import RETAIL as R
    from shelfwise.plans import profiling
    from shelfwise.sources.tables import sales_schema

    rng = np.random.default_rng(5)
    rows = [
        (f"FD{i % 7}", None if i % 6 == 0 else float(i % 9), "LF" if i % 4 == 0 else None if i % 11 == 0 else "Regular", 0.01 * (i % 5),
         f"type {i % 3}", 100.0 + i % 13, f"OUT{i % 5}", 1990 + i % 4, None if i % 3 == 0 else "Small", "Tier 1", f"T{i % 2}",
         None if i % 17 == 0 else float(np.round(rng.lognormal(5, 1), 2)))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, sales_schema()).replace({"LF": "Low Fat"}, subset=[R.fat_content])
    calls, other = [], MagicMock()  # sections that share nothing are left out
    monkeypatch.setattr(profiling, "cat", other)
    monkeypatch.setattr(plots, "histogram", other)
    monkeypatch.setattr(plots, "box_stats_by_category", other)
    monkeypatch.setattr(prof, "duplicate_rows", other)
    for module, name in ((profiling, "exact_boxes"), (prof, "exact_quantiles"), (prof, "exact_boxes"), (plots, "exact_boxes")):
        own = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _own=own, _name=name, **k: calls.append((_name, tuple(a[1]))) or _own(*a, **k))
    sections = profiling.profile(df, stage=False)
    assert sorted(calls) == [("exact_boxes", ()), ("exact_quantiles", ("column",))]
    monkeypatch.undo()
    alone = {
        "describe_target": prof.describe(df, [R.target]),
        "iqr_outliers": prof.iqr_outliers(df, R.target),
        "box_stats": plots.box_stats(df, R.target),
    }
    for name, want in alone.items():
        got, want = (x.toPandas().sort_values(x.columns).reset_index(drop=True) for x in (sections[name], want))
        pd.testing.assert_frame_equal(got, want, rtol=1e-12)
