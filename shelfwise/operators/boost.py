"""Gradient boosting whose trees each see a drawn share of the columns, with shrunken leaves."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasStepSize
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.storage import Stored, load_stages, save_stages
from shelfwise.session import materialize

#: Rounds between two stores of the running prediction, which cut its lineage.
STORED = 10


def leaf_value(total: float, rows: int, penalty: float) -> float:
    """Value of a leaf: the sum of its residuals over its rows and the penalty."""
    return total / (rows + penalty)


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows that a tree is grown on", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "share of the columns that a tree may split by", TypeConverters.toFloat)
    leafPenalty = Param(Params._dummy(), "leafPenalty", "added to the rows of a leaf, which draws its value to zero", TypeConverters.toFloat)


class ColumnBoosting(Estimator, _BoostParams, DefaultParamsWritable, DefaultParamsReadable):
    """Boosting for squared error.

    Each round draws ``columnShare`` of the columns and ``subsamplingRate`` of the rows (by a hash of round and row
    values, so that no partitioning changes it), grows a regression tree on their residuals, and gives every leaf the sum
    of its drawn residuals over their number and ``leafPenalty``, times ``stepSize``. Leaves are summed by one aggregate
    over leaf numbers. The prediction starts from the mean of the label.
    """

    def __init__(
        self, *, maxIter=200, stepSize=0.1, maxDepth=6, subsamplingRate=0.8, columnShare=0.8, leafPenalty=1.0,
        featuresCol="features", labelCol="label", predictionCol="prediction", seed=42,
    ):
        super().__init__()
        self._set(
            maxIter=maxIter, stepSize=stepSize, maxDepth=maxDepth, subsamplingRate=subsamplingRate, columnShare=columnShare,
            leafPenalty=leafPenalty, featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, seed=seed,
        )

    def columns_of(self, number: int, width: int) -> list[int]:
        """The columns that the tree of a round may split by."""
        most = max(1, round(width * self.getOrDefault("columnShare")))
        draw = np.random.default_rng([self.getSeed(), number]).permutation(width)
        return sorted(draw[:most].tolist())

    def drawn(self, number: int) -> F.Column:
        """Whether the tree of a round is grown on a row."""
        place = F.pmod(F.xxhash64(F.lit(self.getSeed()), F.lit(number), F.col("row")), F.lit(1 << 20))
        return place < round(self.getOrDefault("subsamplingRate") * (1 << 20))

    def _fit(self, dataset: DataFrame) -> ColumnBoostingModel:
        features, label = self.getFeaturesCol(), self.getLabelCol()
        rows = dataset.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"))
        start = rows.agg(F.avg("label")).first()[0]
        if start is None:
            raise ValueError("no row has a label")
        first = rows.first()
        width = len(first["features"])
        # A row's own number decides whether it is drawn; equal rows have different ones, written once.
        now = materialize(rows.withColumns({"row": F.monotonically_increasing_id(), "prediction": F.lit(float(start))}))
        steps: list[tuple[DecisionTreeRegressionModel, list[int], dict[int, float]]] = []
        for number in range(self.getMaxIter()):
            columns = self.columns_of(number, width)
            sliced = VectorSlicer(inputCol="features", outputCol="seen", indices=columns).transform(now)
            sliced = sliced.withColumn("residual", F.col("label") - F.col("prediction"))
            grower = DecisionTreeRegressor(
                featuresCol="seen", labelCol="residual", predictionCol="grown", leafCol="leaf", maxDepth=self.getOrDefault("maxDepth"), seed=self.getSeed()
            )
            drawn = sliced.where(self.drawn(number))
            tree = grower.fit(drawn)
            sums = tree.transform(drawn).groupBy(F.col("leaf").cast("int").alias("leaf")).agg(F.sum("residual").alias("total"), F.count(F.lit(1)).alias("n"))
            penalty, step = self.getOrDefault("leafPenalty"), self.getStepSize()
            values = {r["leaf"]: step * leaf_value(r["total"], r["n"], penalty) for r in sums.collect()}
            steps.append((tree, columns, values))
            now = _stepped(now, tree, columns, values).select(*now.columns)
            if (number + 1) % STORED == 0:
                now = materialize(now)
        return ColumnBoostingModel(float(start), steps, features, self.getPredictionCol())


def _stepped(df: DataFrame, tree: DecisionTreeRegressionModel, columns: Sequence[int], values: dict[int, float], features: str = "features", prediction: str = "prediction") -> DataFrame:
    """``df`` with the value of each row's leaf added to its prediction; a leaf that no drawn row fell in adds nothing."""
    sliced = VectorSlicer(inputCol=features, outputCol="seen", indices=list(columns)).transform(df)
    found = tree.setFeaturesCol("seen").setPredictionCol("grown").setLeafCol("leaf").transform(sliced)
    # Values by leaf number: a leaf's place in an array.
    table = F.array(*[F.lit(values.get(leaf, 0.0)) for leaf in range(max(values, default=0) + 1)])
    step = F.coalesce(F.get(table, F.col("leaf").cast("int")), F.lit(0.0))
    return found.withColumn(prediction, F.col(prediction) + step).drop("seen", "grown", "leaf")


class ColumnBoostingModel(Model, HasFeaturesCol, HasPredictionCol, Stored):
    """The start value and, for each round, its tree, its columns and the values of its leaves."""

    def __init__(self, start: float, steps, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(featuresCol=featuresCol, predictionCol=predictionCol)
        self.start, self.steps = start, list(steps)

    def first(self, rounds: int) -> ColumnBoostingModel:
        """The model as it was after so many rounds."""
        return ColumnBoostingModel(self.start, self.steps[:rounds], self.getFeaturesCol(), self.getPredictionCol())

    def _save_state(self, path: str, spark: SparkSession) -> dict:
        names = save_stages({f"{i:05d}": tree for i, (tree, _, _) in enumerate(self.steps)}, f"{path}/trees")
        return {"start": self.start, "trees": names, "columns": [c for _, c, _ in self.steps], "leaves": [list(v.items()) for _, _, v in self.steps]}

    @classmethod
    def _load_state(cls, path: str, state: dict, spark: SparkSession) -> ColumnBoostingModel:
        trees = load_stages(state["trees"], f"{path}/trees", spark).values()
        return cls(state["start"], list(zip(trees, state["columns"], map(dict, state["leaves"]))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumn(self.getPredictionCol(), F.lit(self.start))
        for tree, columns, values in self.steps:
            out = _stepped(out, tree, columns, values, self.getFeaturesCol(), self.getPredictionCol())
        return out
