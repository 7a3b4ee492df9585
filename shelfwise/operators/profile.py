"""Table overview, missing values, distribution, outliers, correlation, quality checks and insight rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import Roles
from shelfwise.functions.scalars import pearson, ratio
from shelfwise.operators.categories import between_group_cv, cardinality
from shelfwise.operators.lookup import attach, store_lookup
from shelfwise.operators.quantiles import exact_boxes, exact_quantiles


def to_rows(one_row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into several rows, each given as name -> expression."""
    structs = F.array(*[F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows])
    return one_row.select(F.inline(structs))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a numeric type, less ``exclude``."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def column_types(df: DataFrame) -> DataFrame:
    """Every column in order with its type and how many values it holds."""
    counts = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return to_rows(
        counts,
        [
            {
                "position": F.lit(i + 1),
                "column": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()),
                "non_null": F.col(f"_{i}"),
            }
            for i, f in enumerate(df.schema)
        ],
    )


def describe(df: DataFrame, columns: Sequence[str], *, found: DataFrame | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum per numeric column.

    ``found`` is what this gave for more columns of the same frame; its rows are taken then, without another scan.
    """
    if found is not None:
        return found.where(F.col("column").isin(list(columns)))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "_x")
    q = F.col("q")
    return exact_quantiles(long, ["column"], "_x", [0.25, 0.5, 0.75]).select(
        "column",
        F.col("n").alias("count"),
        "mean",
        "std",
        "min",
        q[0].alias("q25"),
        q[1].alias("q50"),
        q[2].alias("q75"),
        "max",
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)]
    )
    rows = to_rows(
        counts,
        [
            {
                "column": F.lit(c),
                "missing_count": F.col(f"_{i}"),
                "missing_pct": ratio(F.col(f"_{i}") * 100.0, F.col("_rows")),
            }
            for i, c in enumerate(df.columns)
        ],
    )
    return rows.where("missing_count > 0").orderBy(F.desc("missing_count"), "column")


def iqr_fences(df: DataFrame, column: str, width: float = 1.5) -> tuple[float, float, float, float] | None:
    """(first quartile, third quartile, lower fence, upper fence); ``None`` for a column without values."""
    quartiles = exact_quantiles(df, [], column, [0.25, 0.75]).first()["q"]
    if quartiles is None:
        return None
    q1, q3 = quartiles
    return q1, q3, q1 - width * (q3 - q1), q3 + width * (q3 - q1)


def iqr_outlier_rows(df: DataFrame, column: str, width: float = 1.5) -> DataFrame:
    """Rows outside the fences. The fences are plain numbers by then, so the filter reaches the scan."""
    fences = iqr_fences(df, column, width)
    if fences is None:
        return df.limit(0)
    return df.where((F.col(column) < fences[2]) | (F.col(column) > fences[3]))


def iqr_outliers(df: DataFrame, column: str, width: float = 1.5, *, boxes: DataFrame | None = None) -> DataFrame:
    """Quartiles, fences, and how many rows fall outside. ``boxes`` are the :func:`exact_boxes` of the column, if known."""
    box = (exact_boxes(df, [], column, width=width) if boxes is None else boxes).first()
    found = box.asDict() if box else {"rows": 0, "q1": None, "q3": None, "outside": 0}
    number = {c: F.lit(found[c]).cast("double") for c in ("q1", "q3")}
    iqr = number["q3"] - number["q1"]
    outside = F.lit(found["outside"]).cast("long")
    return df.sparkSession.range(1).select(
        number["q1"].alias("q1"),
        number["q3"].alias("q3"),
        iqr.alias("iqr"),
        (number["q1"] - iqr * width).alias("lower_bound"),
        (number["q3"] + iqr * width).alias("upper_bound"),
        outside.alias("outlier_count"),
        ratio(outside * 100.0, F.lit(found["rows"]).cast("long")).alias("outlier_pct"),
    )


def distribution_shape(df: DataFrame, column: str) -> DataFrame:
    """Skewness and excess kurtosis, both of the population form."""
    return df.agg(F.skewness(column).alias("skewness"), F.kurtosis(column).alias("kurtosis"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, each pair over the rows where both are present. One scan; long form.

    Pairs are grouped as rows rather than aggregated side by side: dozens of aggregates in one projection outgrow what
    Spark compiles to one method.
    """
    number = {c: F.col(c).cast("double") for c in columns}
    pairs = F.array(
        *[
            F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"), number[a].alias("x"), number[b].alias("y")
            )
            for i, a in enumerate(columns)
            for b in columns[i:]
        ]
    )
    both = F.when(F.col("y").isNotNull(), F.col("x")), F.when(F.col("x").isNotNull(), F.col("y"))
    spread = F.stddev_samp(both[0]) * F.stddev_samp(both[1])
    upper = df.select(F.inline(pairs)).groupBy("a", "b").agg(F.try_divide(F.covar_samp("x", "y"), spread).alias("_r"))
    corr = F.when(F.col("a") == F.col("b"), F.when(F.col("_r").isNotNull(), 1.0)).otherwise(F.col("_r"))
    mirrored = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return upper.select(F.explode(mirrored).alias("_p"), corr.alias("corr")).select(
        F.col("_p.a").alias("feature_a"), F.col("_p.b").alias("feature_b"), "corr"
    )


def corr_with_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    sums = df.agg(*[pearson(f, target).alias(f"_{i}") for i, f in enumerate(features)])
    return to_rows(sums, [{"feature": F.lit(f), "corr": F.col(f"_{i}")} for i, f in enumerate(features)])


def top_correlated(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The feature with the strongest correlation of either sign; the target itself never competes."""
    rows = corr_with_target(df, [f for f in features if f != target], target).where("corr IS NOT NULL")
    return rows.orderBy(F.desc(F.abs("corr")), "feature").limit(1).withColumn("abs_corr", F.abs("corr"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column (NULL equals NULL).

    The first scan counts 128-bit row hashes; only rows whose hash occurs again are then compared, and shuffled, whole.
    Equal rows have equal hashes, so no repeat is missed, and unequal rows that share one are told apart.
    """
    hashed = df.withColumns({f"_hash{seed}": F.xxhash64(F.lit(seed), *df.columns) for seed in (0, 1)})
    marks = ["_hash0", "_hash1"]
    repeated = store_lookup(
        hashed.groupBy(*marks).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("_again", F.lit(True)), marks
    )
    if not repeated.total:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("duplicate_rows"))
    again = attach(hashed, repeated).where("_again").drop(*marks, "_again")
    copies = again.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def target_sign_checks(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(target) < 0).alias("negative_count"), F.count_if(F.col(target) == 0).alias("zero_count")
    )


def insights(df: DataFrame, roles: Roles) -> DataFrame:
    """One row per rule: whether it fired, and what it found. Three scans: moments, labels, outlet means."""
    features = roles.numeric_features
    base = df.agg(
        F.skewness(roles.target).alias("_skew"),
        *[F.count_if(F.col(c).isNull()).alias(f"_missing{i}") for i, c in enumerate(df.columns)],
        *[pearson(f, roles.target).alias(f"_corr{i}") for i, f in enumerate(features)],
    )
    with_gaps = F.concat_ws(", ", *[F.when(F.col(f"_missing{i}") > 0, c) for i, c in enumerate(df.columns)])
    strengths = F.array(
        *[F.struct(F.abs(f"_corr{i}").alias("size"), F.lit(-i).alias("place"), F.lit(f).alias("name"))
          for i, f in enumerate(features)]
    )
    known = F.filter(strengths, lambda s: s["size"].isNotNull())
    strongest = F.array_max(known)
    from_base = to_rows(
        base,
        [
            {"rule_id": F.lit("missing_values"), "triggered": with_gaps != "", "detail": with_gaps},
            {
                "rule_id": F.lit("skewed_target"),
                "triggered": F.coalesce(F.abs("_skew") > 1, F.lit(False)),
                "detail": F.format_string("%.3f", F.col("_skew")),
            },
            {
                "rule_id": F.lit("top_correlation"),
                "triggered": strongest.isNotNull(),
                "detail": F.format_string("%s %.3f", strongest["name"], strongest["size"]),
            },
        ],
    )
    many = cardinality(df, roles.categorical).where("distinct_count > 20")
    named = many.agg(F.array_sort(F.collect_list("feature")).alias("_f")).select(
        F.lit("high_cardinality").alias("rule_id"),
        (F.size("_f") > 0).alias("triggered"),
        F.concat_ws(", ", "_f").alias("detail"),
    )
    spread = between_group_cv(df, roles.outlet, roles.target).select(
        F.lit("outlet_variation").alias("rule_id"),
        F.col("high").alias("triggered"),
        F.format_string("%.3f", F.col("cv")).alias("detail"),
    )
    return from_base.unionByName(named).unionByName(spread)
