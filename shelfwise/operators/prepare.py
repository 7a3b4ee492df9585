"""Preparation steps as DataFrame functions, each usable on its own. What learns runs jobs, what applies is lazy.

Statistics are learned from compact aggregates: one table of sums per (item, type) serves every mean-based lookup,
and one table of counts per (outlet, outlet type, location, size) serves the size modes and the outlet encoding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import Roles
from shelfwise.functions.scalars import band, clip, code_of, ratio, standard_score
from shelfwise.operators.categories import MAX_LABELS, labels_long
from shelfwise.operators.lookup import Lookup, attach, store_lookup
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.operators.ranks import running_totals
from shelfwise.session import materialize

NO_LABEL = "nan"  # text that stands for a missing label in one-hot blocks
MAX_POSITIONS = 2**31 - 1  # positions of a vector are 32-bit integers


# --- labels ---------------------------------------------------------------------------------------------------------


def standardize_labels(df: DataFrame, fixes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Replace known misspellings; labels without an entry, and NULL, stay."""
    for column, mapping in fixes.items():
        if column in df.columns:
            df = df.replace(dict(mapping), subset=[column])
    return df


def ordinal_encode(df: DataFrame, orders: Mapping[str, Sequence[str]]) -> DataFrame:
    """Labels become their position; a label outside the order becomes NULL."""
    return df.withColumns({c: code_of(F.col(c), order) for c, order in orders.items() if c in df.columns})


def count_labels(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Stored (feature, value, n): the rows of every label; NULL counts as the text ``nan``."""
    filled = df.select(*[F.coalesce(F.col(f).cast("string"), F.lit(NO_LABEL)).alias(f) for f in features])
    return materialize(labels_long(filled, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def wide_features(counts: DataFrame, max_labels: int = MAX_LABELS) -> dict[str, int]:
    """Features with more than ``max_labels`` labels, and how many they have."""
    sizes = counts.groupBy("feature").count().where(F.col("count") > max_labels)
    return {row["feature"]: row["count"] for row in sizes.collect()}  # at most one row per feature


def collect_labels(counts: DataFrame, features: Sequence[str]) -> dict[str, dict[str, int]]:
    """Sorted labels of each feature with their row counts, for features that :func:`wide_features` does not name."""
    learned: dict[str, dict[str, int]] = {f: {} for f in features}
    for row in counts.where(F.col("feature").isin(list(features))).orderBy("feature", "value").collect():
        learned[row["feature"]][row["value"]] = row["n"]
    return learned


def learn_labels(df: DataFrame, features: Sequence[str], *, max_labels: int = MAX_LABELS) -> dict[str, dict[str, int]]:
    """Sorted labels of each feature with their row counts; NULL counts as the text ``nan``."""
    counts = count_labels(df, features)
    for feature, n in wide_features(counts, max_labels).items():
        raise ValueError(f"{feature} has {n} labels, more than {max_labels} one-hot columns")
    return collect_labels(counts, features)


def one_hot_encode(df: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each feature by 0/1 columns ``feature_label`` at the end; an unseen label gives zeros throughout."""
    blocks = [
        F.when(F.coalesce(F.col(f).cast("string"), F.lit(NO_LABEL)) == label, 1.0).otherwise(0.0).alias(f"{f}_{label}")
        for f, values in labels.items()
        for label in values
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in labels], *blocks)


def label_positions(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, label, position): positions of a one-hot vector over all labels of ``features``, sorted by feature and
    label; NULL counts as the text ``nan``. Any number of labels, numbered range by range."""
    filled = df.select(*[F.coalesce(F.col(f).cast("string"), F.lit(NO_LABEL)).alias(f) for f in features])
    distinct = labels_long(filled, features).distinct().withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(distinct, [], [F.col("feature").asc(), F.col("value").asc()], "_one")
    return materialize(ranked.select("feature", F.col("value").alias("label"), F.col("start").alias("position")))


def one_hot_sparse(df: DataFrame, features: Sequence[str], positions: DataFrame, output: str = "one_hot") -> DataFrame:
    """Add the one-hot block of ``features`` as the sorted positions that hold a 1; unseen labels have none.

    The long form of :func:`one_hot_encode`, without a limit on the labels: each feature finds its position by a lookup.
    """
    joined, found = df, []
    for i, feature in enumerate(features):
        own = positions.where(F.col("feature") == feature).select(F.col("label").alias(f"_label{i}"), F.col("position").alias(f"_at{i}"))
        label = F.coalesce(F.col(feature).cast("string"), F.lit(NO_LABEL))
        joined = attach(joined.withColumn(f"_label{i}", label), store_lookup(own, [f"_label{i}"], stored=True))
        found.append(F.col(f"_at{i}"))
    return joined.withColumn(output, F.sort_array(F.array_compact(F.array(*found)))).select(*df.columns, output)


@dataclass(frozen=True)
class SparseBlock:
    """A one-hot block over any number of labels: for each feature the lookup from label to position and value."""

    features: tuple[str, ...]
    lookups: tuple[Lookup, ...]
    size: int


def learn_sparse_block(counts: DataFrame, features: Sequence[str], *, scaled: bool) -> SparseBlock:
    """Positions of all labels of ``features``, sorted by feature and label, from :func:`count_labels`.

    A label of share p stands for 1, or with ``scaled`` for 1 / sqrt(p (1 - p)): the standard score without its centre. The
    centre is a constant for each position, which splits of trees and linear models with a free intercept do not see, and
    leaving it out keeps all other positions zero.
    """
    features = sorted(features)
    own = counts.where(F.col("feature").isin(features)).withColumn("_one", F.lit(1).cast("long"))
    placed = materialize(running_totals(own, [], [F.col("feature").asc(), F.col("value").asc()], "_one"))
    rows, size = placed.where(F.col("feature") == features[0]).agg(F.sum("n")).first()[0], placed.count()
    if size > MAX_POSITIONS:
        raise ValueError(f"{size} labels, more than the {MAX_POSITIONS} positions of a vector")
    share = F.col("n") / F.lit(rows)
    spread = F.sqrt(share * (1 - share))
    stands_for = F.when(spread > 0, 1 / spread).otherwise(1.0) if scaled else F.lit(1.0)
    lookups = [
        store_lookup(
            placed.where(F.col("feature") == feature).select(
                F.col("value").alias(f"_label{i}"),
                F.col("start").cast("int").alias(f"_at{i}"),
                stands_for.alias(f"_for{i}"),
                F.col("n").alias("_n"),
            ),
            [f"_label{i}"],
            stored=True,
        )
        for i, feature in enumerate(features)
    ]
    return SparseBlock(tuple(features), tuple(lookups), size)


def one_hot_vector(df: DataFrame, block: SparseBlock, output: str) -> DataFrame:
    """Replace the features of ``block`` by one sparse vector at the end; an unseen label has no entry in it."""
    joined = df
    for i, (feature, lookup) in enumerate(zip(block.features, block.lookups)):
        label = F.coalesce(F.col(f"`{feature}`").cast("string"), F.lit(NO_LABEL))
        joined = attach(joined.withColumn(f"_label{i}", label), lookup)
    each = range(len(block.features))
    parts = F.struct(
        F.lit(0).alias("type"),  # a sparse vector
        F.lit(block.size).alias("size"),
        F.array_compact(F.array(*[F.col(f"_at{i}") for i in each])).alias("indices"),
        F.array_compact(F.array(*[F.col(f"_for{i}") for i in each])).alias("values"),
    )
    # Spark has no function from positions to a sparse vector; its JSON reader makes one without leaving the JVM.
    shape = T.StructType([T.StructField("v", VectorUDT())])
    vector = F.from_json(F.to_json(F.struct(parts.alias("v"))), shape)["v"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in block.features]
    return VectorSizeHint(inputCol=output, size=block.size, handleInvalid="optimistic").transform(
        joined.select(*kept, vector.alias(output))
    )


# --- imputation -----------------------------------------------------------------------------------------------------


def learn_means(
    df: DataFrame, levels: Mapping[str, Sequence[Sequence[str]]]
) -> tuple[list[Lookup], dict[str, float | None]]:
    """Group means for imputation. ``levels`` maps a column to its key lists, most specific first.

    Returns one lookup per key list, shared by all columns that use it, and the overall means. The data is scanned
    once, into sums per combination of keys; all means roll up from there.
    """
    columns = list(levels)
    key_lists = list(dict.fromkeys(tuple(keys) for lists in levels.values() for keys in lists))
    cube_keys = list(dict.fromkeys(k for keys in key_lists for k in keys))
    sums = [F.sum(F.col(c).cast("double")).alias(f"_sum_{c}") for c in columns]
    known = [F.count(c).alias(f"_known_{c}") for c in columns]
    ends = [f(F.col(c).cast("double")).alias(f"_{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    cube = materialize(df.groupBy(*cube_keys).agg(*sums, *known, *ends, F.count(F.lit(1)).alias("_n")))

    def mean(c: str):
        # A mean lies between its values. Holding a rounded sum to that makes the mean of equal values that value.
        raw = F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_known_{c}"))
        return clip(raw, F.min(f"_min_{c}"), F.max(f"_max_{c}"))

    lookups = []
    for keys in key_lists:
        used = [c for c in columns if list(keys) in [list(k) for k in levels[c]]]
        table = (
            cube.dropna(subset=list(keys))
            .groupBy(*keys)
            .agg(*[mean(c).alias(f"_mean_{'_'.join(keys)}_{c}") for c in used], F.sum("_n").alias("_n"))
        )
        lookups.append(store_lookup(table, keys))
    overall = cube.agg(*[mean(c).alias(c) for c in columns]).first().asDict()
    return lookups, overall


def fill_means(
    df: DataFrame,
    levels: Mapping[str, Sequence[Sequence[str]]],
    lookups: Sequence[Lookup],
    overall: Mapping[str, float | None],
    *,
    stored: bool = False,
) -> DataFrame:
    """Fill NULLs from the most specific level that has a mean, then from the overall mean. ``stored``: see :func:`attach`."""
    joined = df
    for lookup in lookups:  # a table of item means can outgrow a broadcast; only rows with a gap go to meet it
        gaps = [F.col(c).isNull() for c, lists in levels.items() if list(lookup.keys) in [list(k) for k in lists]]
        joined = attach(joined, lookup, needed=reduce(or_, gaps), stored=stored)
    filled = {
        c: F.coalesce(
            F.col(c).cast("double"), *[F.col(f"_mean_{'_'.join(keys)}_{c}") for keys in lists], F.lit(overall[c]).cast("double")
        )
        for c, lists in levels.items()
    }
    return joined.withColumns(filled).select(*df.columns)


def count_cube(df: DataFrame, keys: Sequence[str], target: str | None = None) -> DataFrame:
    """Stored counts per combination of keys, with the sum and count of the target when one is given."""
    sums = [F.sum(target).alias("_target_sum"), F.count(target).alias("_target_n")] if target else []
    return materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums))


def learn_modes(cube: DataFrame, column: str, levels: Sequence[Sequence[str]]) -> tuple[list[Lookup], str | None]:
    """Most frequent value per group and overall; ties go to the smallest value.

    Each level is learned from the column as the levels before it have left it, which the cube of counts allows
    without touching the rows again.
    """

    def modes(table: DataFrame, keys: list[str], name: str) -> DataFrame:
        # Groups without any value stay, with a NULL mode: the lookup then knows how many rows their key holds.
        per_value = table.groupBy(*keys, column).agg(F.sum("_n").alias("_c"))
        ranked = F.struct((-F.col("_c")).alias("_rank"), F.col(column).alias("_v"))
        best = F.min(F.when(F.col(column).isNotNull(), ranked))["_v"]
        return per_value.groupBy(*keys).agg(best.alias(name), F.sum("_c").alias("_n"))

    lookups = []
    for keys in map(list, levels):
        name = f"_mode_{'_'.join(keys)}"
        lookup = store_lookup(modes(cube.dropna(subset=keys), keys, name), keys)
        lookups.append(lookup)
        cube = attach(cube, lookup).withColumn(column, F.coalesce(F.col(column), F.col(name))).drop(name)
    overall = modes(cube, [], "_mode").first()
    return lookups, overall["_mode"] if overall else None


def fill_modes(
    df: DataFrame, column: str, lookups: Sequence[Lookup], overall: str | None
) -> DataFrame:
    """Fill NULLs level by level, then with the overall mode. Present values stay, even where a key is NULL."""
    joined = reduce(attach, lookups, df)
    modes = [F.col(name) for lookup in lookups for name in lookup.values]
    return joined.withColumn(column, F.coalesce(F.col(column), *modes, F.lit(overall).cast("string"))).select(*df.columns)


def learn_positive_medians(df: DataFrame, column: str, by: str) -> Lookup:
    """Exact median of the positive values per group."""
    medians = exact_quantiles(df.where(F.col(column) > 0), [by], column, [0.5])
    return store_lookup(medians.select(by, F.col("q")[0].alias("_positive_median"), F.col("n").alias("_n")), [by])


def fill_zeros(df: DataFrame, column: str, medians: Lookup) -> DataFrame:
    """Zeros take the median of their group; NULLs stay, and so do zeros of groups without a positive value."""
    value = F.col(column)
    filled = F.when(value == 0, F.coalesce(F.col("_positive_median"), value)).otherwise(value)
    return attach(df, medians).withColumn(column, filled).select(*df.columns)


# --- outliers -------------------------------------------------------------------------------------------------------

OUTLIER_METHODS = ("iqr", "zscore")


def zscore_bounds(df: DataFrame, columns: Sequence[str], threshold: float) -> dict[str, tuple[float, float]]:
    """mean -/+ threshold x sample standard deviation, all columns in one scan; columns without spread are left out."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: (row[f"_m{i}"] - threshold * row[f"_s{i}"], row[f"_m{i}"] + threshold * row[f"_s{i}"])
        for i, c in enumerate(columns)
        if row[f"_s{i}"] is not None
    }


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> tuple[dict[str, list[float]], dict[str, tuple[float, float]]]:
    """Exact quantiles of several columns, and their means and population standard deviations, in one pass over the
    unpivoted values. Columns without a value are left out."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "_x")
    rows = exact_quantiles(long, ["column"], "_x", probs).collect()  # one row per column
    some = [r for r in rows if r["q"] is not None]
    return {r["column"]: r["q"] for r in some}, {r["column"]: (r["mean"], r["std_pop"]) for r in some}


def iqr_bounds(quartiles: Mapping[str, tuple[float, float]], threshold: float) -> dict[str, tuple[float, float]]:
    return {c: (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)) for c, (q1, q3) in quartiles.items()}


def cap_outliers(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Pull values beyond the bounds back to them. No row is dropped and NULL stays NULL."""
    return df.withColumns(
        {c: clip(F.col(c).cast("double"), float(lo), float(hi)) for c, (lo, hi) in bounds.items() if c in df.columns}
    )


# --- features -------------------------------------------------------------------------------------------------------


def price_edges(quantiles: Sequence[float]) -> list[float]:
    """Inner edges of the price bands; repeated edges would leave a band undefined."""
    edges = [float(q) for q in quantiles]
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError(f"price band edges must be increasing, got {edges}")
    return edges


def learn_target_encoding(cube: DataFrame, key: str, smoothing: float) -> tuple[Lookup, float]:
    """Target mean per key, pulled towards the overall mean as if ``smoothing`` extra rows had that mean."""
    total, n = cube.agg(F.sum("_target_sum"), F.sum("_target_n")).first()
    if not n:
        raise ValueError("target encoding needs rows with a target")
    overall = total / n
    groups = cube.dropna(subset=[key]).groupBy(key).agg(
        F.sum("_target_sum").alias("_s"), F.sum("_target_n").alias("_k"), F.sum("_n").alias("_n")
    )
    encoding = (F.col("_s") + F.lit(overall * smoothing)) / (F.col("_k") + F.lit(smoothing))
    return store_lookup(groups.where("_k > 0").select(key, encoding.alias("_encoding"), "_n"), [key]), overall


def apply_target_encoding(df: DataFrame, encoding: Lookup, overall: float, name: str) -> DataFrame:
    """Add the encoding; keys not seen at fit get the overall mean."""
    return attach(df, encoding).withColumn(name, F.coalesce(F.col("_encoding"), F.lit(overall))).select(*df.columns, name)


def add_features(df: DataFrame, roles: Roles, edges: Sequence[float] | None) -> DataFrame:
    """Outlet age, price band, and the three price combinations, for the columns that exist."""
    has = set(df.columns)
    price, weight, visibility = F.col(roles.price), F.col(roles.weight), F.col(roles.visibility)
    new = {roles.age: F.lit(roles.reference_year) - F.col(roles.opened_year)}
    if roles.price in has and edges is not None:
        new[roles.price_band] = band(price, list(edges), roles.price_labels)
    if {roles.price, roles.weight} <= has:
        new[roles.price_per_weight] = ratio(price, weight)
    if {roles.price, roles.visibility} <= has:
        new[roles.visibility_per_price] = ratio(visibility, price)
    if roles.price in has:
        new[roles.price_times_age] = price * new[roles.age]
    return df.withColumns(new)


def learn_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column in one scan; missing values are ignored."""
    row = df.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"_m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"_s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"_m{i}"], row[f"_s{i}"]) for i, c in enumerate(columns) if row[f"_m{i}"] is not None}


def scale_features(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Standardise the learned columns in place; a column without spread is only centred."""
    return df.select(
        *[
            standard_score(F.col(f"`{c}`").cast("double"), *scale[c]).alias(c) if c in scale else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
