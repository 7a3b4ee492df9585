"""Preparation steps on hand-made edge cases, and the fitted preparer as a whole."""

import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.config import RETAIL as R
from shelfwise.operators import lookup as lk
from shelfwise.operators import prepare as prep
from shelfwise.operators.preparer import TablePreparer, TablePreparerModel, preparer
from shelfwise.operators.regress import assemble, check_complete
from shelfwise.operators.target import TargetScale, learn_target_scale, roundtrip_check
from shelfwise.session import materialize, scratch_scope
from shelfwise.sources.sales import SALES_KEYS, read_sales
from shelfwise.sources.tables import clean_missing


@pytest.fixture(scope="module")
def sales(spark, folder):
    return read_sales(spark, folder)


@pytest.fixture(scope="module")
def model(sales):
    return TablePreparer().fit(sales)


def test_nan_is_missing(spark):
    df = clean_missing(spark.createDataFrame(pd.DataFrame({"x": [1.0, float("nan")]})))
    assert df.agg(F.count("x"), F.avg("x")).first() == (1, 1.0)


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("o", s) for s in ("b", "a", "b", "a", None)], "o string, s string")
    lookups, overall = prep.learn_modes(prep.count_cube(df, ["o", "s"]), "s", [["o"]])
    assert overall == "a"
    assert sorted(r["s"] for r in prep.fill_modes(df, "s", lookups, overall).collect()) == ["a", "a", "a", "b", "b"]


def test_modes_see_what_earlier_levels_filled(spark):
    """Filling outlet 1 makes 'b' the mode of the type, which is what outlet 3 then gets."""
    rows = [("1", "t", "b"), ("1", "t", None), ("1", "t", None), ("2", "t", "a"), ("2", "t", "a"), ("3", "t", None)]
    df = spark.createDataFrame(rows, "o string, t string, s string")
    lookups, overall = prep.learn_modes(prep.count_cube(df, ["o", "t", "s"]), "s", [["o"], ["t"]])
    filled = {(r["o"], r["s"]) for r in prep.fill_modes(df, "s", lookups, overall).collect()}
    assert filled == {("1", "b"), ("2", "a"), ("3", "b")}


def test_null_group_key_keeps_present_values(spark):
    df = spark.createDataFrame([(None, "x"), (None, None), ("o", "y"), ("o", "y")], "o string, s string")
    lookups, overall = prep.learn_modes(prep.count_cube(df, ["o", "s"]), "s", [["o"]])
    got = sorted((str(r["o"]), r["s"]) for r in prep.fill_modes(df, "s", lookups, overall).collect())
    assert got == [("None", "x"), ("None", "y"), ("o", "y"), ("o", "y")]


def test_means_fall_through_levels(spark):
    rows = [("i1", "t1", 2.0), ("i1", "t1", None), ("i2", "t1", None), ("i3", "t2", None), ("i4", "t3", 8.0)]
    df = spark.createDataFrame(rows, "i string, t string, w double")
    levels = {"w": [["i"], ["t"]]}
    got = {(r["i"], r["w"]) for r in prep.fill_means(df, levels, *prep.learn_means(df, levels)).collect()}
    assert got == {("i1", 2.0), ("i2", 2.0), ("i3", 5.0), ("i4", 8.0)}


def test_mean_of_equal_values_is_that_value(spark):
    df = spark.createDataFrame([("i", 919.7)] * 1001 + [("i", None)], "i string, w double")
    lookups, _ = prep.learn_means(df, {"w": [["i"]]})
    assert lookups[0].table.first()["_mean_i_w"] == 919.7


def test_zero_without_positive_value_stays(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 2.0), ("a", 4.0), ("b", 0.0), ("a", None)], "t string, v double")
    got = prep.fill_zeros(df, "v", prep.learn_positive_medians(df, "v", "t")).collect()
    assert sorted((r["t"], -1.0 if r["v"] is None else r["v"]) for r in got) == [
        ("a", -1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 0.0),
    ]


def test_ordinal_and_one_hot_edges(spark):
    df = spark.createDataFrame([(None, None), ("Huge", "c"), ("High", "a")], "s string, n string")
    coded = prep.ordinal_encode(df, {"s": ("Small", "Medium", "High")})
    assert sorted(str(r["s"]) for r in coded.collect()) == ["2", "None", "None"]
    labels = prep.learn_labels(spark.createDataFrame([("a",), ("b",), (None,)], "n string"), ["n"])
    assert list(labels["n"]) == ["a", "b", "nan"]
    wide = {tuple(r[c] for c in ("n_a", "n_b", "n_nan")) for r in prep.one_hot_encode(df, labels).collect()}
    assert wide == {(0.0, 0.0, 1.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)}


def test_one_hot_refuses_too_many_labels(spark):
    df = spark.createDataFrame([(str(i),) for i in range(6)], "n string")
    with pytest.raises(ValueError, match="6 labels"):
        prep.learn_labels(df, ["n"], max_labels=5)


def test_incomplete_rows_are_named(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 1.0)], "a double, b double")
    with pytest.raises(ValueError, match=r"\{'a': 1\}"):
        check_complete(df, ["a", "b"])
    assert assemble(df.na.fill(0.0), ["a", "b"]).count() == 2


def test_band_edges(spark):
    with pytest.raises(ValueError, match="increasing"):
        prep.price_edges([5.0, 5.0, 5.0, 5.0])
    df = spark.createDataFrame([(x, 2000) for x in (1.0, 1.5, 4.0, 4.5)] + [(None, 2000)], f"{R.price} double, {R.opened_year} int")
    got = [r[R.price_band] for r in prep.add_features(df, R, [1.0, 2.0, 3.0, 4.0]).orderBy(F.col(R.price).asc_nulls_last()).collect()]
    assert got == ["Low", "Low-Med", "Med-High", "High", None]


def test_caps_keep_null_and_rows(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    assert [r["x"] for r in prep.cap_outliers(df, {"x": (0.0, 1.0)}).collect()] == [None, 0.0, 0.5, 1.0]


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.5, 2000)], f"{R.price} double, {R.weight} double, {R.visibility} double, {R.opened_year} int")
    row = prep.add_features(df, R, None).first()
    assert row[R.price_per_weight] is None and row[R.visibility_per_price] is None
    assert row[R.age] == 24 and row[R.price_times_age] == 0.0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e5, 1e5), min_size=1, max_size=20), st.booleans())
def test_target_scale_round_trip(spark, values, log):
    df = spark.createDataFrame([(v,) for v in values], "y double")
    scale = learn_target_scale(df, "y", log=log)
    spread = max(abs(v) for v in values) + 2
    for r in df.select("y", scale.forward(F.col("y")).alias("s"), scale.inverse(scale.forward(F.col("y"))).alias("b")).collect():
        assert -1e-12 <= r["s"] <= 1 + 1e-12
        assert r["b"] == pytest.approx(r["y"], abs=1e-9 * spread)


def test_target_scale_edges(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (5.0,)], "y double")
    scale = learn_target_scale(df, "y", log=True)
    assert scale.offset == 4.0
    constant = learn_target_scale(df.where("y = 5"), "y")
    row = df.where("y = 5").select(constant.forward(F.col("y")), constant.inverse(constant.forward(F.col("y")))).first()
    assert tuple(row) == (0.0, 5.0)
    assert TargetScale(active=False).forward(F.col("y")) is not None


def test_published_round_trip(spark):
    """The series 1..8523 survives log scaling and back to a relative 1e-10."""
    df = spark.range(1, 8524).select(F.col("id").cast("double").alias("y"))
    row = roundtrip_check(df, "y", learn_target_scale(df, "y", log=True)).first()
    assert row["n"] == 8523 and row["all_close"] and row["max_rel_diff"] < 1e-10


def test_sparse_one_hot_equals_the_wide_one(spark):
    rows = [(i, f"a{i % 1200}", None if i % 5 == 0 else f"b{i % 3}") for i in range(1300)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    positions = prep.label_positions(df, ["a", "b"])
    place = {(r["feature"], r["label"]): r["position"] for r in positions.collect()}
    assert sorted(place, key=place.get) == sorted(place) and sorted(place.values()) == list(range(1204))
    new = df.union(spark.createDataFrame([(9999, "unseen", "b1")], df.schema))
    got = {r["id"]: r["one_hot"] for r in prep.one_hot_sparse(new, ["a", "b"], positions).collect()}
    assert got[9999] == [place["b", "b1"]] and len(got) == 1301
    assert all(got[i] == sorted([place["a", a], place["b", b or "nan"]]) for i, a, b in rows)


# --- lookups under skew ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_bytes", [lk.BROADCAST_BYTES, 0])
def test_lookup_strategies_agree(spark, broadcast_bytes):
    """One key holds a third of the rows, many are cold, some are missing or unknown."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 1900).cast("string"))).alias("k"),
        F.col("id"),
    )
    table = df.where("k IS NOT NULL AND id % 7 <> 0 OR k = 'hot'").groupBy("k").agg(F.max("id").alias("_m"), F.count("*").alias("_n"))
    lookup = lk.store_lookup(table, ["k"])
    got = lk.attach(df, lookup, broadcast_bytes=broadcast_bytes)
    known = {r["k"]: r["_m"] for r in lookup.table.collect()}
    rows = got.collect()
    assert len(rows) == 6000 and {r["id"] for r in rows} == set(range(6000))
    assert all(r["_m"] == known.get(r["k"]) for r in rows)


def test_hot_key_that_the_lookup_does_not_know(spark):
    """A key that is rare, or unknown, where the lookup was learned, and holds most rows of the frame."""
    lookup = lk.store_lookup(spark.createDataFrame([("rare", 1, 1), ("common", 2, 5000)], "k string, _m int, _n long"), ["k"])
    rows = [("unknown",)] * 900 + [("rare",)] * 600 + [("common",)] * 2 + [(None,)] * 50
    got = lk.attach(spark.createDataFrame(rows, "k string").repartition(4), lookup, broadcast_bytes=0)
    counts = {(r["k"], r["_m"]): r["count"] for r in got.groupBy("k", "_m").count().collect()}
    assert counts == {("unknown", None): 900, ("rare", 1): 600, ("common", 2): 2, (None, None): 50}


def test_scratch_scope_leaves_nothing(spark, sales, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfwise.session.shared_folder", lambda spark: str(tmp_path))
    with scratch_scope(spark):
        prepared = TablePreparer().fit_transform(sales)[1]
        assert prepared.count() == sales.count() and any(tmp_path.rglob("*.parquet"))
    assert not list(tmp_path.rglob("*.parquet"))


def test_fit_transform_equals_fit_then_transform(model, sales):
    other, frame = TablePreparer().fit_transform(sales)
    rounded = [F.round(F.col(f"`{c}`"), 6).alias(c) for c in model.feature_names]
    assert other.feature_names == model.feature_names
    assert frame.select(*rounded).exceptAll(model.transform(sales).select(*rounded)).isEmpty()


def test_rows_that_need_nothing_are_not_joined(spark):
    df = spark.range(200).select((F.col("id") % 9).cast("string").alias("k"), "id")
    lookup = lk.store_lookup(df.groupBy("k").agg(F.max("id").alias("_m"), F.count("*").alias("_n")), ["k"])
    got = lk.attach(df, lookup, needed=F.col("id") % 4 == 0, broadcast_bytes=0).collect()
    assert {r["id"] for r in got} == set(range(200)) and len(got) == 200
    assert all((r["_m"] is not None) == (r["id"] % 4 == 0) for r in got)


def test_preparer_gives_the_same_with_shuffled_lookups(model, sales, monkeypatch):
    """The plan for lookups too large to broadcast, through fit and transform."""
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)
    other = TablePreparer().fit(sales)
    assert {c: pytest.approx(b) for c, b in other.fitted.bounds.items()} == model.fitted.bounds
    rounded = [F.round(F.col(f"`{c}`"), 6).alias(c) for c in model.feature_names]
    shuffled = other.transform(sales).select(*rounded)
    monkeypatch.undo()
    assert shuffled.exceptAll(model.transform(sales).select(*rounded)).isEmpty()


def test_large_lookup_is_not_broadcast(spark):
    df = spark.range(100).select((F.col("id") % 10).cast("string").alias("k"))
    lookup = lk.store_lookup(df.groupBy("k").agg(F.count("*").alias("_n"), F.lit(1.0).alias("_m")), ["k"])
    plan = lk.attach(df, lookup, broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


# --- the fitted preparer --------------------------------------------------------------------------------------------


def test_features_in_order(model):
    names = model.feature_names
    assert names[:12] == [
        "Item_Weight", "Item_Fat_Content", "Item_Visibility", "Item_MRP", "Outlet_Establishment_Year", "Outlet_Size",
        "Outlet_Location_Type", "Outlet_Age", "MRP_per_Weight", "Visibility_MRP_Ratio", "MRP_x_Outlet_Age",
        "Outlet_Target_Encoded",
    ]
    assert names[-5:] == [f"MRP_Category_{b}" for b in ("High", "Low", "Low-Med", "Med-High", "Medium")]
    assert len(names) - len(model.fitted.scale) == 3  # the ordinal codes are not scaled


def test_prepared_frame_is_complete(model, sales):
    out = model.transform(sales)
    assert out.count() == sales.count()
    check_complete(out, model.feature_names)
    low, high = out.agg(F.min("scaled_target"), F.max("scaled_target")).first()
    assert (low, high) == (0.0, 1.0)


def test_partitioning_does_not_matter(model, sales):
    def digest(df):
        rounded = [F.round(F.col(f"`{c}`"), 6) for c in model.feature_names]
        return df.select(F.xxhash64(*rounded).alias("h")).agg(F.sum(F.col("h").cast("decimal(38,0)"))).first()[0]

    assert digest(model.transform(sales.repartition(1))) == digest(model.transform(sales.repartition(7)))


def test_statistics_of_batch_and_fit_agree_on_the_training_frame(sales):
    fit = TablePreparer(statistics="fit").fit(sales)
    batch = fit.copy({fit.statistics: "batch"})
    a, b = (m.transform(sales).groupBy("Outlet_Size").count().orderBy("Outlet_Size").collect() for m in (fit, batch))
    assert a == b


def test_save_and_load(spark, model, sales, tmp_path):
    model.save_to(str(tmp_path / "m"), spark)
    loaded = TablePreparerModel.load_from(str(tmp_path / "m"), spark)
    assert loaded.feature_names == model.feature_names and loaded.target_scale == model.target_scale
    assert model.transform(sales).exceptAll(loaded.transform(sales)).isEmpty()


def test_parameters_are_checked(spark, sales):
    with pytest.raises(ValueError, match="outlierMethod"):
        TablePreparer(outlierMethod="isolation")
    with pytest.raises(ValueError, match="target column"):
        TablePreparer().fit(sales.drop(R.target))


def test_short_hand_leaves_target_unscaled(sales):
    out = preparer(outlierMethod="zscore", scaleFeatures=False).fit(sales).transform(sales)
    assert out.where(F.col("scaled_target") != F.col(R.target)).isEmpty()


def test_absent_columns_are_skipped(sales):
    slim = sales.drop(R.weight, R.outlet_size)
    got = TablePreparer().fit(slim)
    assert R.weight not in got.feature_names and R.price_per_weight not in got.feature_names
    check_complete(got.transform(slim), got.feature_names)


def test_new_rows_without_target(model, sales):
    fresh = sales.drop(R.target).withColumn(R.outlet, F.lit("OUT9999"))
    out = model.transform(fresh)
    mean, std = model.fitted.scale[R.outlet_encoding]
    expected = (model.fitted.overall_target - mean) / std
    assert out.agg(F.max(F.abs(F.col(R.outlet_encoding) - expected))).first()[0] < 1e-9
    assert "scaled_target" not in out.columns


def test_sales_keys_are_optional(spark, folder):
    assert set(read_sales(spark, folder, keys=True).columns) - set(read_sales(spark, folder).columns) == set(SALES_KEYS)
    assert math.isclose(read_sales(spark, folder).count(), 6000, rel_tol=0.05)


def test_rows_that_need_nothing_stay_out_of_the_shuffle(spark):
    rows = [(i, f"k{i % 50}" if i % 11 else None, None if i % 4 == 0 else float(i)) for i in range(2000)]
    df = materialize(spark.createDataFrame(rows, "id int, k string, x double").repartition(4))
    lookup = lk.store_lookup(spark.range(45).selectExpr("concat('k', id) AS k", "id * 1.5D AS v"), ["k"])
    joined = lk.attach(df, lookup, needed=F.col("x").isNull(), broadcast_bytes=0, stored=True)
    got = {r["id"]: r for r in joined.collect()}
    assert joined.count() == len(got) == 2000
    for i, k, x in rows:
        wanted = int(k[1:]) * 1.5 if x is None and k is not None and int(k[1:]) < 45 else None
        assert (got[i]["k"], got[i]["x"], got[i]["v"]) == (k, x, wanted)
    # One side of a union joins, and reads no row that has a value.
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    joins, rest = plan.split("Union", 1)[1].rsplit("Project", 1)
    assert "Join" in joins and "isnull(x" in joins and "Join" not in rest and "isnotnull(x" in rest
