"""The data behind the usual charts: histograms, box statistics, normal Q-Q points and scatter pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import normal_quantile
from shelfwise.operators.categories import labels_long
from shelfwise.operators.quantiles import exact_boxes
from shelfwise.operators.ranks import running_totals
from shelfwise.session import materialize

# Ranks of one repeated value are produced in pieces of at most this many rows.
QQ_PIECE = 1_000_000


def histogram(df: DataFrame, columns: Sequence[str], bins: int, *, log: bool = False) -> DataFrame:
    """Equal-width counts per column. Bins are closed on the left, the last one on both sides; empty bins stay.

    ``log=True`` bins ``log(1 + x)``. A constant column gets a range one wide around its value.
    """
    picked = [F.log1p(c).alias(c) if log else F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(*picked).unpivot([], list(columns), "feature", "x").where(F.col("x").isNotNull())
    ends = long.groupBy("feature").agg(F.min("x").alias("_min"), F.max("x").alias("_max"))
    pad = F.when(F.col("_min") == F.col("_max"), 0.5).otherwise(0.0)
    ranges = materialize(ends.select("feature", (F.col("_min") - pad).alias("lo"), (F.col("_max") + pad).alias("hi")))

    lo, hi, x = F.col("lo"), F.col("hi"), F.col("x")
    step = (hi - lo) / bins

    def edge(i):
        return F.when(i == bins, hi).otherwise(lo + i * step)

    guess = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1))
    guessed = long.join(F.broadcast(ranges), "feature").withColumn("_guess", guess)  # one range per column
    g = F.col("_guess")
    settled = (
        F.when(x < edge(g), g - 1).when((x >= edge(g + 1)) & (g != bins - 1), g + 1).otherwise(g).cast("int")
    )
    counts = guessed.groupBy("feature", settled.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    b = F.col("bin")
    return (
        grid.join(counts, ["feature", "bin"], "left")
        .select(
            "feature", "bin", edge(b).alias("left_edge"), edge(b + 1).alias("right_edge"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
        .orderBy("feature", "bin")
    )


def box_stats(
    df: DataFrame, target: str, by: Sequence[str] = (), *, width: float = 1.5, boxes: DataFrame | None = None
) -> DataFrame:
    """Quartiles, whiskers (the most extreme values within ``width`` IQR of the box) and fliers per group.

    ``boxes`` are the :func:`exact_boxes` of the target in these groups, if known.
    """
    found = exact_boxes(df, list(by), target, width=width) if boxes is None else boxes
    return found.where("n > 0").select(
        *by,
        "n",
        F.least("low", "q1").alias("whisker_low"),
        "q1",
        "median",
        "q3",
        F.greatest("high", "q3").alias("whisker_high"),
        F.col("outside").alias("flier_count"),
    )


def box_stats_by_category(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Box statistics of the target for each label of each feature, from one unpivoted scan per pass."""
    return box_stats(labels_long(df, features, [target]), target, ["feature", "value"])


def qq_points(df: DataFrame, column: str, *, piece: int = QQ_PIECE) -> DataFrame:
    """Every value with its rank and the normal quantile of its plotting position.

    Equal values are counted before anything is sorted, the counts are numbered range by range, and a value that
    occurs very often is expanded to its ranks in pieces that go to different tasks.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("c")
    )
    counts = materialize(counts)
    n = int(counts.agg(F.sum("c")).first()[0] or 0)
    ranked = running_totals(counts, [], [F.col("value").asc()], "c")

    pieces = ranked.select(
        "value",
        F.explode(F.sequence(F.col("start"), F.col("end") - 1, F.lit(piece).cast("long"))).alias("_from"),
        "end",
    ).repartition("_from")
    last = F.least(F.col("_from") + piece, F.col("end"))
    points = pieces.select("value", F.explode(F.sequence(F.col("_from") + 1, last)).alias("rank"))

    rank = F.col("rank")
    tail = 0.5 ** (1.0 / n) if n else None
    position = (
        F.when(rank == n, F.lit(tail))
        .when(rank == 1, F.lit(1.0 - tail if n else None))
        .otherwise((rank - F.lit(0.3175)) / F.lit(n + 0.365))
    )
    return points.select("rank", normal_quantile(position).alias("theoretical"), "value")


def qq_fit(points: DataFrame) -> DataFrame:
    """Least-squares line through the Q-Q points, and their correlation."""
    return points.agg(
        F.regr_slope("value", "theoretical").alias("slope"),
        F.regr_intercept("value", "theoretical").alias("intercept"),
        F.sqrt(F.regr_r2("value", "theoretical")).alias("r"),
        F.count(F.lit(1)).alias("n"),
    )


def scatter_points(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(pair, x, y) for every row where both are present; all pairs from one scan, no row left out."""
    each = F.array(
        *[
            F.struct(
                F.lit(f"{x} vs {y}").alias("pair"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
            )
            for x, y in pairs
        ]
    )
    return df.select(F.inline(each)).where("x IS NOT NULL AND y IS NOT NULL")
