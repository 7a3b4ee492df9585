"""Regression metrics, rating, clipping and prediction output."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import clip, ratio
from shelfwise.operators.profile import to_rows
from shelfwise.operators.quantiles import exact_quantiles


def regression_metrics(
    df: DataFrame, actual: Column | str, predictions: Mapping[str, Column | str], *, label: str = "model"
) -> DataFrame:
    """MSE, RMSE, MAE, R2 and MAPE (%) of every prediction column, all from one aggregate.

    Rows without the actual value or without a prediction do not count. Zero actual values are left out of MAPE only.
    """
    y = (F.col(actual) if isinstance(actual, str) else actual).cast("double")
    sums, rows = [], []
    for i, (name, column) in enumerate(predictions.items()):
        p = (F.col(column) if isinstance(column, str) else column).cast("double")
        seen = F.when(p.isNotNull(), y)
        sums += [
            F.count(y - p).alias(f"_n{i}"),
            F.avg((y - p) * (y - p)).alias(f"_mse{i}"),
            F.avg(F.abs(y - p)).alias(f"_mae{i}"),
            F.var_pop(seen).alias(f"_var{i}"),
            F.avg(F.abs(F.try_divide(y - p, y))).alias(f"_ape{i}"),
        ]
        mse, spread = F.col(f"_mse{i}"), F.col(f"_var{i}")
        rows.append(
            {
                label: F.lit(name),
                "n": F.col(f"_n{i}"),
                "mse": mse,
                "rmse": F.sqrt(mse),
                "mae": F.col(f"_mae{i}"),
                "r2": F.when((spread == 0) & (mse == 0), 1.0).when(spread == 0, 0.0).otherwise(1.0 - ratio(mse, spread)),
                "mape": F.col(f"_ape{i}") * 100.0,
            }
        )
    return to_rows(df.agg(*sums), rows)


def rating_of(test_r2: Column) -> Column:
    return (
        F.when(test_r2 > 0.8, "Excellent").when(test_r2 > 0.7, "Good").when(test_r2 > 0.6, "Fair")
        .otherwise("Needs Improvement")
    )


def overfitting_of(train_r2: Column, test_r2: Column) -> Column:
    gap = F.abs(train_r2 - test_r2)
    return (
        F.when(gap < 0.05, "No overfitting").when(gap < 0.1, "Slight overfitting").otherwise("Significant overfitting")
    )


def model_rating(scores: DataFrame) -> DataFrame:
    """Rating and overfitting status from columns ``train_r2`` and ``test_r2``."""
    train, test = F.col("train_r2"), F.col("test_r2")
    return scores.withColumns({"rating": rating_of(test), "overfitting": overfitting_of(train, test)})


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest R2."""
    best = F.max_by(F.struct("model", "r2"), F.col("r2"))
    return metrics.agg(best.alias("_best")).select("_best.model", "_best.r2")


def split_r2(df: DataFrame, actual: str, prediction: str, is_test: Column) -> DataFrame:
    """R2 on the training and the test rows, side by side, in one scan."""
    y, p = F.col(actual), F.col(prediction)

    def r2(rows: Column) -> Column:
        error = F.when(rows, (y - p) * (y - p))
        return 1.0 - ratio(F.avg(error), F.var_pop(F.when(rows, y)))

    return df.agg(r2(~is_test).alias("train_r2"), r2(is_test).alias("test_r2"))


def clip_predictions(df: DataFrame, prediction: str, high: float) -> DataFrame:
    """Real-unit predictions limited to [0, largest training target]."""
    return df.withColumn(prediction, clip(F.col(prediction), 0.0, high))


def prediction_stats(df: DataFrame, prediction: str) -> DataFrame:
    """Mean, exact median, population standard deviation, minimum and maximum."""
    return exact_quantiles(df, [], prediction, [0.5]).select(
        "mean", F.col("q")[0].alias("median"), F.col("std_pop").alias("std"), "min", "max"
    )


def prediction_frame(df: DataFrame, prediction: str, id_column: str) -> DataFrame:
    """(identifier, Predicted_Sales). Rows of a distributed table have no position, so an identifier is required."""
    if id_column not in df.columns:
        raise ValueError(f"identifier column {id_column!r} not found; add one before predicting")
    return df.select(F.col(id_column), F.col(prediction).alias("Predicted_Sales"))


def combine(predictions: Mapping[str, Column | str], weights: Mapping[str, float]) -> Column:
    """Weighted mean of prediction columns; weights are normalised to add up to 1."""
    total = float(sum(weights.values()))
    terms = [
        (F.col(p) if isinstance(p, str) else p) * F.lit(weights[name] / total) for name, p in predictions.items()
    ]
    return sum(terms[1:], terms[0])
