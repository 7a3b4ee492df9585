"""One-hot blocks of any number of labels inside the preparer, and ridge over many sparse features."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from shelfwise.config import RETAIL as R
from shelfwise.operators import lookup as lk
from shelfwise.operators import prepare as prep
from shelfwise.operators import regress
from shelfwise.operators.preparer import TablePreparer, TablePreparerModel
from shelfwise.sources.sales import SALES_KEYS, read_sales


@pytest.fixture(scope="module")
def sales(spark, folder):
    return read_sales(spark, folder)


@pytest.fixture(scope="module")
def forms(sales):
    """The same fit with a column for each label, and with every label of more than four in a sparse vector."""
    return TablePreparer().fit(sales), TablePreparer(maxLabels=4).fit(sales)


def test_the_block_replaces_columns(forms, sales):
    dense, sparse = forms
    assert sparse.feature_names[-1] == "one_hot" and len(sparse.fitted.block.features) >= 2
    gone = [n for n in dense.feature_names if n not in sparse.feature_names]
    assert len(gone) == sparse.fitted.block.size
    out = sparse.transform(sales)
    assert not set(sparse.fitted.block.features) & set(out.columns)
    regress.check_complete(out, sparse.feature_names)
    assert regress.width(out, "one_hot") == len(gone)


def test_predictions_equal_those_of_the_dense_form(forms, sales):
    predicted = []
    for model in forms:
        ready = regress.assemble(model.transform(sales), model.feature_names)
        members = {"ridge": regress.ridge("scaled_target"), "tree": DecisionTreeRegressor(labelCol="scaled_target", maxDepth=3)}
        for name, member in members.items():
            scored = member.fit(ready).transform(ready)
            column = "pred_ridge" if name == "ridge" else "prediction"
            rows = scored.select(*R.ids, R.target, F.col(column).alias("p")).collect()
            predicted.append(np.array([r["p"] for r in sorted(rows, key=lambda r: (*r[:3], r[3]))]))
    assert np.allclose(predicted[0], predicted[2], atol=1e-8)
    assert np.allclose(predicted[1], predicted[3], atol=1e-12)


def test_the_block_is_saved(forms, sales, spark, tmp_path):
    model = forms[1]
    model.save_to(str(tmp_path / "m"), spark)
    loaded = TablePreparerModel.load_from(str(tmp_path / "m"), spark)
    assert loaded.feature_names == model.feature_names

    def digest(m):
        return m.transform(sales).agg(F.count("*"), F.sum(F.xxhash64(F.col("one_hot").cast("string")).cast("decimal(38,0)"))).first()

    assert digest(loaded) == digest(model)


def test_labels_nulls_and_large_lookups(spark, monkeypatch):
    rows = [("a", "x"), ("a", None), ("b", "y"), ("c", "x")]
    df = spark.createDataFrame(rows, "p string, q string")
    counts = prep.count_labels(df, ["p", "q"])
    assert prep.wide_features(counts, 2) == {"p": 3, "q": 3}
    block = prep.learn_sparse_block(counts, ["q", "p"], scaled=True)
    assert block.features == ("p", "q") and block.size == 6
    new = spark.createDataFrame([*rows, ("new", "new")], df.schema)

    def shown():
        return sorted((r["v"].size, tuple(zip(r["v"].indices.tolist(), r["v"].values.round(9).tolist()))) for r in prep.one_hot_vector(new, block, "v").collect())

    half, quarter = 2.0, round(1 / np.sqrt(3 / 16), 9)  # p = 1/2 and 1/4
    expected = sorted([
        (6, ((0, half), (4, half))), (6, ((0, half), (3, quarter))), (6, ((1, quarter), (5, quarter))), (6, ((2, quarter), (4, half))), (6, ()),
    ])
    assert shown() == expected
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)
    assert shown() == expected


def test_the_name_of_the_block_must_be_free(sales):
    with pytest.raises(ValueError, match="another oneHotCol"):
        TablePreparer(maxLabels=4).fit(sales.withColumn("one_hot", F.lit(1.0)))


def test_iterated_ridge_equals_the_closed_form(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, label double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    monkeypatch.setattr(regress, "NORMAL_FEATURES", 0)
    fitted = regress.RidgeParity(alpha=10.0).fit(df)
    centred = x - x.mean(axis=0)
    w = np.linalg.solve(centred.T @ centred + 10.0 * np.eye(3), centred.T @ (y - y.mean()))
    assert np.allclose(fitted.coefficients.toArray(), w, atol=1e-6)
    assert abs(fitted.intercept - (y.mean() - x.mean(axis=0) @ w)) < 1e-6


def test_fifty_thousand_labels(spark, folder):
    """Every copy of a row has an item type of its own, which no column per label could hold."""
    rows = read_sales(spark, folder, keys=True).withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(10))))
    label = F.concat(F.lit("t"), F.xxhash64(*SALES_KEYS, "_k").cast("string"))
    many = rows.withColumn(R.item_type, label).drop(*SALES_KEYS, "_k")
    model, out = TablePreparer().fit_transform(many)
    assert model.fitted.block.features == (R.item_type,) and model.fitted.block.size > 50_000
    ready = regress.assemble(out, model.feature_names)
    assert regress.width(ready) == model.fitted.block.size + len(model.feature_names) - 1
    scored = regress.ridge("scaled_target", alpha=100.0).fit(ready).transform(ready)
    error, spread = scored.agg(F.avg(F.pow(F.col("pred_ridge") - F.col("scaled_target"), 2)), F.var_pop("scaled_target")).first()
    assert 0 <= error < spread
