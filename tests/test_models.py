"""Members, tuning, ensemble, evaluation and the files they end in."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfwise.catalog import queries as catalog
from shelfwise.config import RETAIL as R
from shelfwise.operators import evaluate as ev
from shelfwise.operators import regress
from shelfwise.plans.profiling import profile
from shelfwise.plans.sales_model import SCALED, SalesTrainer
from shelfwise.sources import tables
from shelfwise.sources.sales import SALES_KEYS, read_sales

SMALL = {"rf": {"numTrees": 5, "maxDepth": 5}, "gbt": {"maxIter": 4, "maxDepth": 3}}


@pytest.fixture(scope="module")
def sales(spark, folder):
    return read_sales(spark, folder, keys=True)


@pytest.fixture(scope="module")
def model(sales):
    return SalesTrainer(keys=SALES_KEYS, tune=False, members=SMALL).fit(sales)


def signal(spark, rows=400):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(rows, 3)) * [1, 5, 0.2] + [0, 10, 3]
    y = x @ [2.0, -0.5, 7.0] + 4 + rng.normal(0, 0.3, rows)
    frame = pd.DataFrame(x, columns=["a", "b", "c"]).assign(label=y, key=range(rows))
    vector = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    return x, y, vector.transform(spark.createDataFrame(frame))


@pytest.mark.parametrize("alpha", [0.1, 1.0, 100.0])
def test_ridge_equals_closed_form(spark, alpha):
    x, y, df = signal(spark)
    fitted = regress.RidgeParity(alpha=alpha).fit(df)
    cx, cy = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(cx.T @ cx + alpha * np.eye(3), cx.T @ cy)
    np.testing.assert_allclose(fitted.coefficients.toArray(), w, rtol=1e-8)
    assert fitted.intercept == pytest.approx(y.mean() - x.mean(0) @ w, rel=1e-8)


def test_tuning_picks_the_lowest_error(spark):
    _, _, df = signal(spark)
    folded = regress.with_fold(df, ["key"])
    best, scores = regress.tune(regress.ridge("label"), {"alpha": [0.1, 1000.0]}, folded)
    errors = {p["alpha"]: e for p, e in scores}
    assert errors[0.1] < errors[1000.0]
    assert best.coefficients[0] == pytest.approx(2.0, abs=0.1)


def test_folds_and_split_do_not_depend_on_partitioning(sales):
    marked = [
        regress.with_fold(regress.with_split(sales.repartition(n), SALES_KEYS), SALES_KEYS).groupBy("is_test", "fold").count()
        for n in (1, 5)
    ]
    assert marked[0].exceptAll(marked[1]).isEmpty()
    share = regress.with_split(sales, SALES_KEYS).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert 0.17 < share < 0.23


def test_full_grids_have_their_published_size():
    sizes = {name: int(np.prod([len(v) for v in grid.values()])) for name, grid in regress.DEFAULT_GRIDS.items()}
    assert sizes == {"rf": 81, "gbt": 243, "ridge": 4}


def test_ensemble_is_the_weighted_mean(model):
    row = model.scored.agg(
        F.max(F.abs(F.col("prediction") - (0.4 * F.col("pred_rf") + 0.4 * F.col("pred_gbt") + 0.2 * F.col("pred_ridge"))))
    ).first()
    assert row[0] < 1e-12


def test_model_beats_the_mean(model):
    scores = {(r["model"], r["split"], r["units"]): r for r in model.metrics().collect()}
    assert len(scores) == 16
    assert scores["ensemble", "test", "scaled"]["r2"] > 0.6
    for name in ("ensemble", "rf", "gbt", "ridge"):
        assert scores[name, "test", "scaled"]["r2"] == pytest.approx(scores[name, "test", "real"]["r2"], rel=1e-6)
    summary = model.summary().first()
    assert summary["best_model"] in ("rf", "gbt", "ridge") and summary["rating"] in ("Excellent", "Good", "Fair")


def test_same_seed_same_model(sales, model):
    again = SalesTrainer(keys=SALES_KEYS, tune=False, members=SMALL).fit(sales)
    a, b = (m.scored.agg(F.sum(F.round("prediction", 6))).first()[0] for m in (model, again))
    assert a == pytest.approx(b, rel=1e-9)


def test_tuned_leak_free_run(sales):
    grids = {"ridge": {"alpha": [0.1, 10.0]}}
    plain = sales.drop(*SALES_KEYS)  # identifiers serve as split keys
    trainer = SalesTrainer(keys=R.ids, grids=grids, members=SMALL, leak_free=True, statistics="fit")
    fitted = trainer.fit(plain)
    assert fitted.predict_real(plain).columns == [R.item, R.outlet, R.target, "prediction"]
    assert set(fitted.ensemble.best_params) == {"ridge"} and len(fitted.ensemble.cv_scores["ridge"]) == 2
    assert fitted.summary().first()["tuned"]


def test_predictions_are_clipped_and_written(spark, model, sales, tmp_path):
    fresh = sales.drop(R.target)
    submission = model.submission(fresh)
    assert submission.columns == [R.item, R.outlet, R.target]
    low, high = submission.agg(F.min(R.target), F.max(R.target)).first()
    assert 0 <= low and high <= model.largest_target
    path = str(tmp_path / "submission")
    tables.write_predictions_csv(submission, path, {c: c for c in submission.columns})
    back = spark.read.csv(path, header=True, schema="i string, o string, y double")
    assert back.count() == sales.count()


def test_weights_are_normalised(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert df.select(ev.combine({"x": "a", "y": "b"}, {"x": 3, "y": 1})).first()[0] == 1.25
    with pytest.raises(ValueError, match="no weight"):
        regress.WeightedEnsemble({"other": regress.ridge("label")})


@pytest.mark.parametrize(
    "train,test,rating,status",
    [
        (0.83, 0.81, "Excellent", "No overfitting"),
        (0.86, 0.80, "Good", "Slight overfitting"),
        (0.70, 0.70, "Fair", "No overfitting"),
        (0.90, 0.60, "Needs Improvement", "Significant overfitting"),
    ],
)
def test_rating_limits(spark, train, test, rating, status):
    row = ev.model_rating(spark.createDataFrame([(train, test)], "train_r2 double, test_r2 double")).first()
    assert (row["rating"], row["overfitting"]) == (rating, status)


def test_metrics_of_constant_and_zero_targets(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, -1.0)], "y double, p double")
    row = ev.regression_metrics(df, "y", {"m": "p"}).first()
    assert (row["mse"], row["r2"], row["mape"]) == (1.0, 0.0, None)


def test_prediction_frame_needs_an_identifier(spark):
    df = spark.createDataFrame([("a", 1.0)], "id string, p double")
    assert ev.prediction_frame(df, "p", "id").first().asDict() == {"id": "a", "Predicted_Sales": 1.0}
    with pytest.raises(ValueError, match="identifier"):
        ev.prediction_frame(df, "p", "missing")


def test_csv_round_trip_and_header_check(spark, sales, tmp_path):
    path = str(tmp_path / "csv")
    sales.select(tables.sales_schema().names).write.csv(path, header=True)
    back = tables.read_sales_csv(spark, path)
    assert back.schema == tables.sales_schema()
    assert back.agg(F.count(R.weight)).first() == sales.agg(F.count(R.weight)).first()
    swapped = str(tmp_path / "swapped")
    sales.select(*reversed(tables.sales_schema().names)).write.csv(swapped, header=True)
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_sales_csv(spark, swapped).agg(F.max(R.weight)).collect()


def test_sections_and_metrics_history(spark, sales, model, tmp_path):
    small = sales.drop(*SALES_KEYS)
    wanted = ("missing_values", "anova", "mrp_equal_width")
    sections = {k: v for k, v in profile(small).items() if k in wanted}
    for _ in range(2):  # a second profile replaces the first
        tables.write_sections(sections, str(tmp_path / "profile"))
    assert spark.read.parquet(str(tmp_path / "profile" / "mrp_equal_width")).count() == 5
    for _ in range(2):  # metrics accumulate
        tables.append_metrics(model.metrics(), str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    assert history.count() == 32 and history.where("recorded_at IS NULL").isEmpty()


def test_model_queries_train_the_full_settings_on_the_tables_as_they_are(spark, folder, monkeypatch):
    runs = []
    monkeypatch.setattr(catalog.SalesTrainer, "fit", lambda self, df: runs.append(regress.default_members(SCALED, self.members)))
    for _ in range(2):
        catalog.trained(spark, folder)
    assert len(runs) == 2
    for members in runs:
        for name, settings in (("rf", regress.FOREST), ("gbt", regress.BOOSTING), ("ridge", regress.RIDGE)):
            assert {k: members[name].getOrDefault(k) for k in settings} == settings


def test_score_queries_train_one_member(spark, folder, monkeypatch):
    runs = []

    class Stopped(Exception):
        pass

    def fit(self, df):
        runs.append(list(self.only))
        raise Stopped

    monkeypatch.setattr(catalog.SalesTrainer, "fit", fit)
    for name in ("rf", "gbt", "ridge"):
        with pytest.raises(Stopped):
            catalog.CATALOG[f"{name}_scores"](spark, folder)
    assert runs == [["rf"], ["gbt"], ["ridge"]]


def test_cv_results_equal_separate_fits(spark, folder):
    got = {r["params"]: r["cv_mse"] for r in catalog.cv_results(spark, folder).collect()}
    assert list(got) == [f"alpha={a}" for a in regress.RIDGE_GRID["alpha"]]
    fitted, prepared = SalesTrainer(keys=SALES_KEYS, test_rule=catalog.HELD_OUT).prepare(read_sales(spark, folder, keys=True))
    ready = regress.assemble(prepared.where("NOT is_test"), fitted.feature_names)
    _, scores = regress.tune(regress.ridge(SCALED), {"alpha": [1.0]}, ready)
    assert got["alpha=1.0"] == pytest.approx(scores[0][1], rel=1e-9)


def test_tree_members_train_on_evenly_dealt_rows(spark, monkeypatch):
    _, _, df = signal(spark, 960)
    uneven = df.repartition(3).withColumns({"is_test": F.lit(False), "other": F.lit("x")})
    seen = []
    monkeypatch.setattr(regress, "refit", lambda member, point, rows: seen.append(rows) or regress.ridge("label").fit(df))
    members = regress.default_members("label")
    for least, parts in ((961, [3, 3, 3]), (960, [8, 8, 3])):
        monkeypatch.setattr(regress, "DEALT_FROM", least)
        seen.clear()
        regress.WeightedEnsemble(members).fit(uneven)
        assert [rows.rdd.getNumPartitions() for rows in seen] == parts
    sizes = seen[0].groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 8
    assert seen[0] is seen[1] and set(seen[0].columns) == {"features", "label"}
    pairs = [rows.select("label", "features") for rows in (seen[0], uneven)]
    assert pairs[0].exceptAll(pairs[1]).isEmpty() and pairs[0].count() == 960
    monkeypatch.setattr(regress, "DEALT_ROWS", 70)
    assert len(regress.dealt(df).inputFiles()) == 16
