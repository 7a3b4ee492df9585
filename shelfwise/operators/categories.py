"""Statistics of the target by label, for many label columns in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.ftest import f_upper_tail
from shelfwise.functions.scalars import band, equal_width_edges, ratio, rounded
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.session import materialize

# Pivots and one-hot blocks turn labels into columns; more labels than this is an error, never a truncation.
MAX_LABELS = 1000


def labels_long(df: DataFrame, features: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """(feature, value, carried columns), one row per non-NULL label; all features come from one scan."""
    text = df.select(*carry, *[F.col(f).cast("string").alias(f) for f in features])
    return text.unpivot(list(carry), list(features), "feature", "value").where(F.col("value").isNotNull())


def value_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per label, NULL not counted."""
    return (
        labels_long(df, features)
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("feature", F.desc("n"), "value")
    )


def cardinality(df: DataFrame, features: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Distinct non-NULL labels per column. ``exact=False`` is the single-pass estimate, on request only."""
    long = labels_long(df, features)
    if not exact:
        return long.groupBy("feature").agg(F.approx_count_distinct("value").alias("distinct_count"))
    return long.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_count"))


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).distinct()


def prefix_counts(df: DataFrame, column: str, length: int = 3) -> DataFrame:
    """Rows per leading characters of an identifier."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.substring(column, 1, length).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "prefix")
    )


def target_by_category(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Mean, median, standard deviation and count of the target for each label of each feature."""
    stats = exact_quantiles(labels_long(df, features, [target]), ["feature", "value"], target, [0.5])
    return stats.select("feature", "value", "mean", F.col("q")[0].alias("median"), "std", "n").orderBy(
        "feature", "value"
    )


def group_stats(df: DataFrame, by: str, target: str, stats: Sequence[str], *, digits: int | None = None) -> DataFrame:
    """Chosen statistics of the target per group: any of mean, median, sum, count, std, and cv = std / mean.

    ``digits`` rounds half-even for display; ``cv`` is then taken from the rounded mean and std.
    """
    simple = {
        "mean": F.avg(target),
        "sum": F.sum(target),
        "count": F.count(target),
        "std": F.stddev_samp(target),
    }
    needed = [s for s in simple if s in stats or ("cv" in stats and s in ("mean", "std"))]
    if "median" in stats:
        out = exact_quantiles(df, [by], target, [0.5]).select(
            by, *[s for s in needed if s != "count"], F.col("n").alias("count"), F.col("q")[0].alias("median")
        )
    else:
        out = df.where(F.col(by).isNotNull()).groupBy(by).agg(*[simple[s].alias(s) for s in needed])
    out = out.withColumns({s: rounded(F.col(s), digits) for s in out.columns if s not in (by, "count")})
    if "cv" in stats:
        out = out.withColumn("cv", rounded(ratio(F.col("std"), F.col("mean")), None if digits is None else 3))
    return out.select(by, *stats)


def outlet_performance(
    df: DataFrame, outlet: str, target: str, *, top: int = 10, digits: int | None = None
) -> DataFrame:
    """The best outlets by mean target, with how variable they are. Ties are ordered by outlet."""
    stats = group_stats(df, outlet, target, ["mean", "median", "sum", "count", "std", "cv"], digits=digits)
    return stats.orderBy(F.desc("mean"), outlet).limit(top)


def price_band_stats(df: DataFrame, price: str, target: str, labels: Sequence[str]) -> DataFrame:
    """Mean and count of the target in equal-width price bands; bands without rows are listed with count 0."""
    low, high = df.agg(F.min(price), F.max(price)).first()
    if low is None:
        grouped = df.sparkSession.createDataFrame([], "band string, mean double, n bigint")
    else:
        edges = equal_width_edges(F.lit(float(low)), F.lit(float(high)), len(labels))
        grouped = (
            df.where(F.col(price).isNotNull())
            .groupBy(band(F.col(price), edges, labels).alias("band"))
            .agg(F.avg(target).alias("mean"), F.count(target).alias("n"))
        )
    listed = df.sparkSession.createDataFrame(list(enumerate(labels)), "position int, band string")
    return (
        listed.join(grouped, "band", "left")
        .orderBy("position")
        .select("band", "mean", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    )


def pivot_cells(df: DataFrame, rows: str, columns: str, target: str) -> DataFrame:
    """Mean target for each pair of labels, one row per pair: a pivot of any width."""
    whole = df.dropna(subset=[rows, columns, target])
    return whole.groupBy(F.col(rows).alias("row_label"), F.col(columns).alias("column_label")).agg(F.avg(target).alias("mean"))


def pivot_mean(df: DataFrame, rows: str, columns: str, target: str, *, max_labels: int = MAX_LABELS) -> DataFrame:
    """Mean target for each pair of labels, one output column per label of ``columns``.

    The data is scanned once; the labels come from the (rows x columns) aggregate, which is what gets pivoted. For
    more labels than columns can be made of, use :func:`pivot_cells`.
    """
    cells = materialize(
        df.dropna(subset=[rows, columns, target]).groupBy(rows, columns).agg(F.avg(target).alias("_mean"))
    )
    labels = [r[0] for r in cells.select(columns).distinct().orderBy(columns).limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"{columns} has more than {max_labels} labels; pivot on a column with fewer")
    if not labels:
        return cells.select(rows).distinct()
    return cells.groupBy(rows).pivot(columns, labels).agg(F.first("_mean")).orderBy(rows)


def group_moments(df: DataFrame, features: Sequence[str], target: str, center: Column | float = 0.0) -> DataFrame:
    """Count, mean (less ``center``) and population variance of the target for each label of each feature."""
    return (
        labels_long(df.where(F.col(target).isNotNull()), features, [target])
        .groupBy("feature", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col(target) - center).alias("mean"),
            F.var_pop(target).alias("variance"),
        )
    )


def anova_from_moments(moments: DataFrame) -> DataFrame:
    """One-way analysis of variance per feature from (feature, n, mean, variance) rows; needs two groups or more.

    Sums of squares add up from group moments, so nothing larger than the group table is shuffled.
    """
    n, mean = F.col("n"), F.col("mean")
    sums = moments.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(n * F.col("variance")).alias("within"),
        (F.sum(n * mean * mean) - F.try_divide(F.sum(n * mean) * F.sum(n * mean), F.sum("n"))).alias("between"),
    )
    between_df, within_df = F.col("k") - 1, F.col("n") - F.col("k")
    statistic = F.when(
        (F.col("within") == 0) & (F.col("between") > 0), F.lit(float("inf"))
    ).otherwise(F.try_divide(F.col("between") / between_df, F.try_divide(F.col("within"), within_df)))
    return sums.where("k > 1").select(
        "feature",
        "k",
        "n",
        between_df.alias("df_between"),
        within_df.alias("df_within"),
        statistic.alias("f_statistic"),
    )


def anova_f(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """F statistic of the target across the labels of each feature."""
    center = df.agg(F.coalesce(F.avg(target), F.lit(0.0))).scalar()
    return anova_from_moments(group_moments(df, features, target, center))


def with_p_values(anova: DataFrame, level: float = 0.05) -> DataFrame:
    """Add the p-value and whether it is below ``level``."""
    p = f_upper_tail(F.col("f_statistic"), F.col("df_between"), F.col("df_within"))
    return anova.withColumn("p_value", p).withColumn("significant", F.col("p_value") < level)


def between_group_cv(df: DataFrame, by: str, target: str, *, limit: float = 0.3) -> DataFrame:
    """Spread of the group means relative to their mean, and whether it exceeds ``limit``."""
    means = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(target).alias("_m"))
    return means.agg(ratio(F.stddev_samp("_m"), F.avg("_m")).alias("cv")).withColumn(
        "high", F.coalesce(F.col("cv") > limit, F.lit(False))
    )
