"""Every operator as a named query over the test tables: ``(spark, folder) -> DataFrame``.

All queries read whole tables. Values are rounded here, never inside the operators, so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import RETAIL as R
from shelfwise.operators import categories as cat
from shelfwise.operators import evaluate as ev
from shelfwise.operators import gram, plots, regress, target
from shelfwise.operators import prepare as prep
from shelfwise.operators import profile as prof
from shelfwise.operators.preparer import TablePreparer, TablePreparerModel, mean_levels, size_cube, size_levels
from shelfwise.plans.profiling import profile, profiled_frame, stacked
from shelfwise.plans.sales_model import SCALED, SalesModel, SalesTrainer
from shelfwise.session import materialize
from shelfwise.sources.sales import SALES_KEYS, read_sales
from shelfwise.sources.tables import clean_missing

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

# Rows whose key sum divides by five are held out; the rule is arithmetic so that SQL can repeat it.
HELD_OUT = "(l_orderkey + l_partkey + l_suppkey + l_linenumber) % 5 = 0"


def query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


def tidy(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round every floating column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), special.get(c, digits)) for c in floats}) if floats else df


def profiled(spark: SparkSession, folder: str) -> DataFrame:
    return profiled_frame(clean_missing(read_sales(spark, folder)))


def base(spark: SparkSession, folder: str, *, keys: bool = False) -> DataFrame:
    return prep.standardize_labels(clean_missing(read_sales(spark, folder, keys=keys)), R.label_fixes)


def predicted(spark: SparkSession, folder: str, *, keys: bool = False) -> DataFrame:
    """A prediction that needs no model: a shrunken, shifted target."""
    df = read_sales(spark, folder, keys=keys)
    return df.withColumn("p", F.lit(0.9) * F.col(R.target) + F.lit(100.0))


# --- profiling ------------------------------------------------------------------------------------------------------


@query
def dataset_shape(spark, folder):
    return prof.dataset_shape(profiled(spark, folder))


@query
def column_types(spark, folder):
    return prof.column_types(profiled(spark, folder))


@query
def describe_numeric(spark, folder):
    return tidy(prof.describe(profiled(spark, folder), R.numeric))


@query
def describe_target(spark, folder):
    return tidy(prof.describe(profiled(spark, folder), [R.target]))


@query
def missing_values(spark, folder):
    return tidy(prof.missing_values(profiled(spark, folder)))


@query
def iqr_outliers(spark, folder):
    return tidy(prof.iqr_outliers(profiled(spark, folder), R.target))


@query
def distribution_shape(spark, folder):
    return tidy(prof.distribution_shape(profiled(spark, folder), R.target), 6)


@query
def correlation_matrix(spark, folder):
    return tidy(prof.correlation_matrix(profiled(spark, folder), R.numeric), 6)


@query
def corr_with_target(spark, folder):
    return tidy(prof.corr_with_target(profiled(spark, folder), R.numeric_features, R.target), 6)


@query
def top_correlated(spark, folder):
    return tidy(prof.top_correlated(profiled(spark, folder), R.numeric, R.target), 6)


@query
def value_counts(spark, folder):
    return cat.value_counts(profiled(spark, folder), R.category_features)


@query
def cardinality(spark, folder):
    return cat.cardinality(profiled(spark, folder), R.categorical)


@query
def target_by_category(spark, folder):
    return tidy(cat.target_by_category(profiled(spark, folder), R.category_features, R.target))


@query
def outlet_performance(spark, folder):
    """Which outlets sell best on average, and how variable are they?"""
    return tidy(cat.outlet_performance(profiled(spark, folder), R.outlet, R.target), sum=2, cv=6)


@query
def sales_by_year(spark, folder):
    return tidy(cat.group_stats(profiled(spark, folder), R.opened_year, R.target, ["mean", "count"]))


@query
def sales_by_location(spark, folder):
    return tidy(cat.group_stats(profiled(spark, folder), R.outlet_location, R.target, ["mean"]))


@query
def item_type_stats(spark, folder):
    stats = cat.group_stats(profiled(spark, folder), R.item_type, R.target, ["mean", "median", "count", "std"])
    return tidy(stats.orderBy(F.desc("mean"), R.item_type))


@query
def fat_content_stats(spark, folder):
    return tidy(cat.group_stats(profiled(spark, folder), R.fat_content, R.target, ["mean", "median", "count"]))


@query
def mrp_equal_width(spark, folder):
    return tidy(cat.price_band_stats(profiled(spark, folder), R.price, R.target, R.price_labels))


def _pivot(spark, folder, rows, columns):
    return tidy(cat.pivot_mean(profiled(spark, folder), rows, columns, R.target))


@query
def pivot_type_size(spark, folder):
    return _pivot(spark, folder, R.outlet_type, R.outlet_size)


@query
def pivot_itemtype_outlettype(spark, folder):
    return _pivot(spark, folder, R.item_type, R.outlet_type)


@query
def pivot_fat_size(spark, folder):
    return _pivot(spark, folder, R.fat_content, R.outlet_size)


@query
def pivot_location_outlettype(spark, folder):
    return _pivot(spark, folder, R.outlet_location, R.outlet_type)


@query
def pivot_itemtype_location(spark, folder):
    return _pivot(spark, folder, R.item_type, R.outlet_location)


@query
def pivot_cells(spark, folder):
    """A pivot too wide for columns: items by outlets."""
    return tidy(cat.pivot_cells(profiled(spark, folder), R.item, R.outlet, R.target), 8)


@query
def anova_f(spark, folder):
    return tidy(cat.anova_f(profiled(spark, folder), R.categorical, R.target))


@query
def anova_tests(spark, folder):
    return cat.with_p_values(cat.anova_f(profiled(spark, folder), R.categorical, R.target))


@query
def duplicate_rows(spark, folder):
    return prof.duplicate_rows(profiled(spark, folder))


@query
def target_sign_checks(spark, folder):
    return prof.target_sign_checks(profiled(spark, folder), R.target)


@query
def distinct_labels(spark, folder):
    return cat.distinct_labels(profiled(spark, folder), R.fat_content)


@query
def id_prefix_counts(spark, folder):
    return cat.prefix_counts(profiled(spark, folder), R.outlet)


@query
def between_group_cv(spark, folder):
    return tidy(cat.between_group_cv(profiled(spark, folder), R.outlet, R.target), 6)


@query
def insights(spark, folder):
    return prof.insights(profiled(spark, folder), R)


@query
def profile_sections(spark, folder):
    return stacked(profile(clean_missing(read_sales(spark, folder)), R))


# --- chart data -----------------------------------------------------------------------------------------------------


@query
def histogram_target(spark, folder):
    return tidy(plots.histogram(profiled(spark, folder), [R.target], 50))


@query
def histogram_log_target(spark, folder):
    return tidy(plots.histogram(profiled(spark, folder), [R.target], 50, log=True), 6)


@query
def histogram_features(spark, folder):
    return tidy(plots.histogram(profiled(spark, folder), R.numeric_features, 30), 6)


@query
def box_stats(spark, folder):
    return tidy(plots.box_stats(profiled(spark, folder), R.target))


@query
def box_stats_by_category(spark, folder):
    return tidy(plots.box_stats_by_category(profiled(spark, folder), R.category_features, R.target))


@query
def qq_points(spark, folder):
    return tidy(plots.qq_points(profiled(spark, folder), R.target), 6)


@query
def qq_fit(spark, folder):
    return tidy(plots.qq_fit(plots.qq_points(profiled(spark, folder), R.target)))


@query
def scatter_points(spark, folder):
    pairs = [(f, R.target) for f in R.numeric_features]
    return plots.scatter_points(profiled(spark, folder), pairs)


# --- preparation steps ----------------------------------------------------------------------------------------------


@query
def standardize_values(spark, folder):
    return base(spark, folder).select(*R.ids, *R.label_fixes)


@query
def ordinal_encode(spark, folder):
    return prep.ordinal_encode(base(spark, folder), R.label_order).select(*R.ids, *R.ordinal)


@query
def one_hot_encode(spark, folder):
    df = base(spark, folder).select(*R.ids, R.item_type, R.outlet_type, R.outlet_size)
    labels = prep.learn_labels(df, [R.item_type, R.outlet_type, R.outlet_size])
    return prep.one_hot_encode(df, labels)


def _fill_mean(spark, folder, column):
    df = base(spark, folder)
    levels = {column: mean_levels(df, R)[column]}
    lookups, overall = prep.learn_means(df, levels)
    return tidy(prep.fill_means(df, levels, lookups, overall).select(*R.ids, R.item_type, column))


@query
def impute_weight(spark, folder):
    return _fill_mean(spark, folder, R.weight)


@query
def impute_mrp(spark, folder):
    return _fill_mean(spark, folder, R.price)


@query
def impute_outlet_size(spark, folder):
    df = base(spark, folder)
    lookups, overall = prep.learn_modes(size_cube(df, R), R.outlet_size, size_levels(R))
    return prep.fill_modes(df, R.outlet_size, lookups, overall).select(
        *R.ids, R.outlet_type, R.outlet_location, R.outlet_size
    )


@query
def zero_visibility_impute(spark, folder):
    df = base(spark, folder)
    medians = prep.learn_positive_medians(df, R.visibility, R.item_type)
    return tidy(prep.fill_zeros(df, R.visibility, medians).select(*R.ids, R.item_type, R.visibility), 6)


def _bounds_frame(spark, bounds):
    rows = [(c, float(lo), float(hi)) for c, (lo, hi) in bounds.items()]
    return tidy(spark.createDataFrame(rows, "column string, lower_bound double, upper_bound double"), 6)


def _iqr_bounds(df):
    quartiles, _ = prep.column_quantiles(df, R.numeric_features, [0.25, 0.75])
    return prep.iqr_bounds({c: (q[0], q[1]) for c, q in quartiles.items()}, 1.5)


@query
def outlier_bounds_iqr(spark, folder):
    return _bounds_frame(spark, _iqr_bounds(base(spark, folder)))


@query
def outlier_bounds_zscore(spark, folder):
    return _bounds_frame(spark, prep.zscore_bounds(base(spark, folder), R.numeric_features, 3.0))


@query
def cap_outliers(spark, folder):
    """Caps at one standard deviation, tight enough to reach many rows."""
    df = base(spark, folder)
    bounds = prep.zscore_bounds(df, R.numeric_features, 1.0)
    return tidy(prep.cap_outliers(df, bounds).select(*R.ids, *R.numeric_features), 6)


def _price_edges(df):
    return prep.price_edges(prep.column_quantiles(df, [R.price], [0.2, 0.4, 0.6, 0.8])[0][R.price])


@query
def mrp_quintile_bins(spark, folder):
    df = base(spark, folder)
    return prep.add_features(df, R, _price_edges(df)).select(*R.ids, R.price, R.price_band)


@query
def feature_engineering(spark, folder):
    df = base(spark, folder)
    encoding, overall = prep.learn_target_encoding(
        prep.count_cube(df, [R.outlet], R.target), R.outlet, R.smoothing
    )
    df = prep.apply_target_encoding(
        prep.add_features(df, R, _price_edges(df)), encoding, overall, R.outlet_encoding
    )
    return tidy(
        df.select(
            *R.ids, R.age, R.price_band, R.price_per_weight, R.visibility_per_price, R.price_times_age, R.outlet_encoding
        ),
        6,
    )


@query
def target_encode_fit(spark, folder):
    cube = prep.count_cube(base(spark, folder), [R.outlet], R.target)
    encoding, _ = prep.learn_target_encoding(cube, R.outlet, R.smoothing)
    return tidy(encoding.table.select(R.outlet, F.col("_encoding").alias("encoding"), F.col("_n").alias("n")))


@query
def target_encode_apply(spark, folder):
    """Learned on the rows that are not held out, applied to all rows."""
    df = base(spark, folder, keys=True)
    cube = prep.count_cube(df.where(f"NOT ({HELD_OUT})"), [R.outlet], R.target)
    encoding, overall = prep.learn_target_encoding(cube, R.outlet, R.smoothing)
    out = prep.apply_target_encoding(df, encoding, overall, R.outlet_encoding)
    return tidy(out.select(*SALES_KEYS, R.outlet, R.outlet_encoding))


@query
def scale_features(spark, folder):
    df = base(spark, folder)
    scale = prep.learn_scale(df, R.numeric_features)
    return tidy(prep.scale_features(df, scale).select(*R.ids, *R.numeric_features), 6)


@query
def scale_target(spark, folder):
    df = read_sales(spark, folder)
    plain, log = target.learn_target_scale(df, R.target), target.learn_target_scale(df, R.target, log=True)
    y = F.col(R.target)
    return tidy(df.select(*R.ids, y, plain.forward(y).alias("scaled"), log.forward(y).alias("log_scaled")), 8)


@query
def inverse_target(spark, folder):
    """Scaled values are halved before going back, so that the inverse is seen to do something."""
    df = read_sales(spark, folder)
    plain, log = target.learn_target_scale(df, R.target), target.learn_target_scale(df, R.target, log=True)
    y = F.col(R.target)
    return tidy(
        df.select(
            *R.ids,
            plain.inverse(plain.forward(y) / 2).alias("from_scaled"),
            log.inverse(log.forward(y) / 2).alias("from_log_scaled"),
        )
    )


@query
def roundtrip_check(spark, folder):
    """Log scaling and back, over every target value."""
    df = read_sales(spark, folder)
    return tidy(target.roundtrip_check(df, R.target, target.learn_target_scale(df, R.target, log=True)), 6)


def _prepared(spark, folder) -> tuple[DataFrame, TablePreparerModel]:
    """The sales table, stored once for the many passes over it, and the preparer fitted to it."""
    df = materialize(read_sales(spark, folder))
    return df, TablePreparer(stageInput=False).fit(df)


@query
def prepare_fit_stats(spark, folder):
    """What the preparer learned, one number per row."""
    got = _prepared(spark, folder)[1].fitted
    rows = [("mean", c, m) for c, m in got.overall_means.items()]
    rows += [("lower_bound", c, lo) for c, (lo, _) in got.bounds.items()]
    rows += [("upper_bound", c, hi) for c, (_, hi) in got.bounds.items()]
    rows += [("price_edge", f"{i}", e) for i, e in enumerate(got.edges or [], start=1)]
    rows += [("scale_mean", c, m) for c, (m, _) in got.scale.items()]
    rows += [("scale_std", c, s) for c, (_, s) in got.scale.items()]
    rows += [("target", "mean", got.overall_target)]
    rows += [("target", "low", got.target_scale.low), ("target", "high", got.target_scale.high)]
    return tidy(spark.createDataFrame(rows, "kind string, name string, value double"), 7)


@query
def prepare_transform(spark, folder):
    df = materialize(read_sales(spark, folder))
    return tidy(TablePreparer(stageInput=False).fit_transform(df)[1], 5)


# --- evaluation -----------------------------------------------------------------------------------------------------


@query
def split_counts(spark, folder):
    df = read_sales(spark, folder, keys=True)
    side = F.when(F.expr(HELD_OUT), "test").otherwise("train").alias("split")
    return df.groupBy(side).agg(F.count(F.lit(1)).alias("n"))


@query
def regression_metrics(spark, folder):
    df = predicted(spark, folder)
    scale = target.learn_target_scale(df, R.target)
    y, p = F.col(R.target), F.col("p")
    real = ev.regression_metrics(df, y, {"real": p}, label="units")
    scaled = ev.regression_metrics(df, scale.forward(y), {"scaled": scale.forward(p)}, label="units")
    # The smallest target scales to zero, which has no percentage error.
    return tidy(real.unionByName(scaled), 6)


@query
def model_rating(spark, folder):
    df = predicted(spark, folder, keys=True)
    return tidy(ev.model_rating(ev.split_r2(df, R.target, "p", F.expr(HELD_OUT))), 6)


@query
def clip_predictions(spark, folder):
    """Predictions stretched past both ends of the target, then clipped."""
    df = predicted(spark, folder)
    high = df.agg(F.max(R.target)).first()[0]
    wide = df.withColumn("p", F.lit(1.5) * F.col("p") - F.lit(900.0))
    return tidy(ev.clip_predictions(wide, "p", high).select(*R.ids, "p"), 6)


@query
def prediction_stats(spark, folder):
    return tidy(ev.prediction_stats(predicted(spark, folder), "p"))


@query
def prediction_frame(spark, folder):
    return tidy(ev.prediction_frame(predicted(spark, folder), "p", R.item), 6)


@query
def ensemble_combine(spark, folder):
    """The weighted mean of three made-up members."""
    df = predicted(spark, folder)
    members = {"rf": F.col("p"), "gbt": F.col(R.target), "ridge": F.lit(0.5) * F.col("p")}
    return tidy(df.select(*R.ids, ev.combine(members, regress.WEIGHTS).alias("prediction")), 6)


# --- models ---------------------------------------------------------------------------------------------------------


def trained(spark: SparkSession, folder: str, only: list[str] | None = None) -> SalesModel:
    """A training run with the library's settings; every query does its own, on the tables as they are."""
    trainer = SalesTrainer(keys=SALES_KEYS, tune=False, test_rule=HELD_OUT, only=only)
    return trainer.fit(read_sales(spark, folder, keys=True))


def _member_scores(spark, folder, name):
    return trained(spark, folder, [name]).metrics().where(F.col("model") == name)


@query
def rf_scores(spark, folder):
    return _member_scores(spark, folder, "rf")


@query
def gbt_scores(spark, folder):
    return _member_scores(spark, folder, "gbt")


@query
def ridge_scores(spark, folder):
    return _member_scores(spark, folder, "ridge")


@query
def best_model(spark, folder):
    model = trained(spark, folder)
    test = ev.regression_metrics(model.scored.where("is_test"), SCALED, model.ensemble.member_columns)
    return ev.best_model(test)


@query
def model_predictions(spark, folder):
    model = trained(spark, folder)
    return model.scored.select(*SALES_KEYS, *model.ensemble.member_columns.values())


@query
def ensemble_predict(spark, folder):
    """Scaled predictions for the sales table without its target, prepared as new data."""
    model = trained(spark, folder)
    fresh = read_sales(spark, folder, keys=True).drop(R.target)
    return model.transform(fresh).select(*SALES_KEYS, "prediction")


@query
def real_predictions(spark, folder):
    return trained(spark, folder).predict_real(read_sales(spark, folder, keys=True))


@query
def train_summary(spark, folder):
    return trained(spark, folder).summary()


@query
def cv_results(spark, folder):
    """Five-fold search over the whole ridge grid, on all prepared features of the training rows."""
    fitted, prepared = SalesTrainer(keys=SALES_KEYS, test_rule=HELD_OUT).prepare(read_sales(spark, folder, keys=True))
    ready = regress.assemble(prepared.where("NOT is_test"), fitted.feature_names)
    scores = regress.search(regress.ridge(SCALED), regress.RIDGE_GRID, ready)
    rows = [("ridge", ", ".join(f"{k}={v}" for k, v in p.items()), float(error)) for p, error in scores]
    return spark.createDataFrame(rows, "model string, params string, cv_mse double")


@query
def ridge_cv_one_feature(spark, folder):
    """Every fit of a five-fold ridge search of sales by price: penalty, fold left out, coefficient, intercept, error there."""
    df = read_sales(spark, folder, keys=True).where(F.col(R.price).isNotNull())
    folded = df.withColumn("fold", ((F.col("l_orderkey") + 3 * F.col("l_partkey") + F.col("l_linenumber")) % 5).cast("int"))
    grams = gram.fold_grams(regress.assemble(folded, [R.price]), R.target)
    total, rows = gram.total_of(grams) if grams else None, []
    for fold, own in sorted(grams.items()):
        for alpha in regress.RIDGE_GRID["alpha"]:
            w, intercept = (total - own).ridge(alpha)
            rows.append((alpha, fold, float(w[0]), intercept, own.error(w, intercept)))
    found = spark.createDataFrame(rows, "alpha double, fold int, coefficient double, intercept double, mse double")
    return tidy(found, 5, mse=1)


@query
def best_of_fixed_members(spark, folder):
    """The best of three made-up members on the held-out rows, by R2."""
    df = predicted(spark, folder, keys=True).where(HELD_OUT)
    members = {"rf": F.col("p"), "gbt": F.lit(0.8) * F.col(R.target) + 10.0, "ridge": F.lit(0.5) * F.col("p")}
    return tidy(ev.best_model(ev.regression_metrics(df, R.target, members)), 6)
