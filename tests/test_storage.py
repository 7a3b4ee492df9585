"""Saved models predict after loading what they predicted before."""

from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfwise.config import RETAIL as R
from shelfwise.config import Roles
from shelfwise.operators import regress
from shelfwise.operators.boost import ColumnBoosting, ColumnBoostingModel
from shelfwise.operators.preparer import TablePreparer
from shelfwise.plans.sales_model import SCALED, SalesModel, SalesTrainer
from shelfwise.sources.sales import SALES_KEYS, read_sales

SMALL = {"rf": {"numTrees": 4, "maxDepth": 4}, "gbt": {"maxIter": 3, "maxDepth": 3}}


@pytest.fixture(scope="module")
def sales(spark, folder):
    return read_sales(spark, folder, keys=True)


@pytest.fixture(scope="module")
def trained(sales):
    return SalesTrainer(keys=SALES_KEYS, tune=False, members=SMALL, weights={"rf": 0.3, "gbt": 0.1, "ridge": 0.3}).fit(sales)


def test_roles_survive_json():
    import json

    special = replace(R, passthrough=("a", "b"), smoothing=3.5)
    assert Roles.of_dict(json.loads(json.dumps(special.as_dict()))) == special


def test_a_whole_trained_model(spark, sales, trained, tmp_path):
    path = str(tmp_path / "model")
    trained.save(path)
    loaded = SalesModel.load(path, spark)
    assert loaded.roles == trained.roles and loaded.tuned == trained.tuned
    assert loaded.ensemble.weights == trained.ensemble.weights
    assert trained.predict_real(sales).exceptAll(loaded.predict_real(sales)).isEmpty()
    assert trained.metrics().exceptAll(loaded.metrics()).isEmpty()
    assert trained.summary().collect() == loaded.summary().collect()
    with pytest.raises(Exception, match="(?i)exist"):
        trained.save(path)
    trained.save(path, overwrite=True)
    assert SalesModel.load(path, spark).largest_target == trained.largest_target


def test_a_fitted_pipeline_and_its_estimators(spark, sales, tmp_path):
    roles = replace(R, passthrough=tuple(SALES_KEYS))
    inputs = [R.price, R.outlet_encoding, R.age]
    stages = [
        TablePreparer(roles=roles, outlierMethod="zscore", outlierThreshold=2.5, scaledTargetCol=SCALED),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        regress.ridge(SCALED, alpha=10.0),
    ]
    Pipeline(stages=stages).write().save(str(tmp_path / "unfitted"))
    again = Pipeline.load(str(tmp_path / "unfitted"))
    first = again.getStages()[0]
    assert first.roles == roles and first.getOrDefault("outlierThreshold") == 2.5 and first.uid == stages[0].uid
    assert again.getStages()[2].getOrDefault("alpha") == 10.0

    fitted = Pipeline(stages=stages).fit(sales)
    fitted.write().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    columns = [*SALES_KEYS, "pred_ridge"]
    assert fitted.transform(sales).select(*columns).exceptAll(loaded.transform(sales).select(*columns)).isEmpty()
    refitted = again.fit(sales).transform(sales).select(*SALES_KEYS, F.round("pred_ridge", 9).alias("p"))
    assert refitted.exceptAll(fitted.transform(sales).select(*SALES_KEYS, F.round("pred_ridge", 9).alias("p"))).isEmpty()


def test_an_ensemble_keeps_its_search(spark, tmp_path):
    rows = [(float(i % 7), float(i % 5), float(3 * (i % 7) - (i % 5)), i % 3) for i in range(120)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, label double, fold int"))
    ensemble = regress.WeightedEnsemble(
        {"rf": regress.forest("label", numTrees=3, maxDepth=3), "ridge": regress.ridge("label")},
        weights={"rf": 0.5, "ridge": 0.5}, grids={"ridge": {"alpha": [0.1, 10.0]}}, folds=3,
    )
    ensemble.write().save(str(tmp_path / "ensemble"))
    again = regress.WeightedEnsemble.load(str(tmp_path / "ensemble"))
    assert (again.grids, again.weights, again.folds) == (ensemble.grids, ensemble.weights, 3)
    model = ensemble.fit(df)
    model.write().save(str(tmp_path / "model"))
    loaded = regress.WeightedEnsembleModel.load(str(tmp_path / "model"))
    assert (loaded.best_params, loaded.cv_scores) == (model.best_params, model.cv_scores)
    assert model.transform(df).select("prediction").collect() == loaded.transform(df).select("prediction").collect()


def test_boosting_by_columns(spark, tmp_path):
    rows = [(float(i % 7), float(i % 5), float((i % 7) * (i % 5))) for i in range(140)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, label double"))
    model = ColumnBoosting(maxIter=3, maxDepth=3, columnShare=0.5).fit(df)
    model.write().save(str(tmp_path / "boosted"))
    loaded = ColumnBoostingModel.load(str(tmp_path / "boosted"))
    assert [c for _, c, _ in loaded.steps] == [c for _, c, _ in model.steps]
    assert model.transform(df).select("prediction").collect() == loaded.transform(df).select("prediction").collect()
