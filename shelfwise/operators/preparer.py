"""The preparation steps as a ``pyspark.ml`` estimator and model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import RETAIL, Roles
from shelfwise.operators import prepare as steps
from shelfwise.operators.categories import MAX_LABELS
from shelfwise.operators.lookup import Lookup, store_lookup
from shelfwise.operators.profile import numeric_columns
from shelfwise.operators.storage import Stored
from shelfwise.operators.target import TargetScale, learn_target_scale
from shelfwise.session import materialize
from shelfwise.sources.tables import clean_missing


class _PreparerParams(Params):
    outlierMethod = Param(Params._dummy(), "outlierMethod", "iqr or zscore", TypeConverters.toString)
    outlierThreshold = Param(Params._dummy(), "outlierThreshold", "width of the bounds", TypeConverters.toFloat)
    scaleFeatures = Param(Params._dummy(), "scaleFeatures", "standardise numeric features", TypeConverters.toBoolean)
    scaleTarget = Param(Params._dummy(), "scaleTarget", "scale the target to [0, 1]", TypeConverters.toBoolean)
    logTarget = Param(Params._dummy(), "logTarget", "log the target before scaling", TypeConverters.toBoolean)
    statistics = Param(
        Params._dummy(),
        "statistics",
        "where size modes and visibility medians come from: 'batch' (the frame being transformed) or 'fit'",
        TypeConverters.toString,
    )
    scaledTargetCol = Param(Params._dummy(), "scaledTargetCol", "output name of the target", TypeConverters.toString)
    maxLabels = Param(
        Params._dummy(),
        "maxLabels",
        "labels up to which a feature becomes one column per label; beyond, it goes into the sparse vector oneHotCol",
        TypeConverters.toInt,
    )
    oneHotCol = Param(Params._dummy(), "oneHotCol", "name of the sparse one-hot vector", TypeConverters.toString)
    stageInput = Param(
        Params._dummy(),
        "stageInput",
        "store the cleaned input once before fitting reads it several times; turn off for a plain columnar table",
        TypeConverters.toBoolean,
    )


@dataclass
class Fitted:
    """What was learned. Lookups are stored tables, everything else is a handful of numbers."""

    means: list[Lookup] = field(default_factory=list)
    overall_means: dict[str, float | None] = field(default_factory=dict)
    size_modes: list[Lookup] = field(default_factory=list)
    overall_size: str | None = None
    visibility: Lookup | None = None
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    edges: list[float] | None = None
    encoding: Lookup | None = None
    overall_target: float = 0.0
    labels: dict[str, list[str]] = field(default_factory=dict)
    block: steps.SparseBlock | None = None
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    target_scale: TargetScale = field(default_factory=lambda: TargetScale(active=False))
    features: list[str] = field(default_factory=list)


def mean_levels(df: DataFrame, roles: Roles) -> dict[str, list[list[str]]]:
    """Which means fill which column: weight by item, then by item type; price by item."""
    levels = {roles.weight: [[roles.item], [roles.item_type]], roles.price: [[roles.item]]}
    return {c: lists for c, lists in levels.items() if c in df.columns}


def size_levels(roles: Roles) -> list[list[str]]:
    return [[roles.outlet], [roles.outlet_type, roles.outlet_location]]


def size_cube(df: DataFrame, roles: Roles, target: str | None = None) -> DataFrame:
    return steps.count_cube(
        df, [roles.outlet, roles.outlet_type, roles.outlet_location, roles.outlet_size], target
    )


class TablePreparer(Estimator, _PreparerParams, Stored):
    """Learns the preparation of a sales table; see :class:`TablePreparerModel` for what it does to a frame.

    Bounds, band edges and scales are learned before capping while ``transform`` caps first, as in the pipeline this
    reproduces. ``roles.passthrough`` names columns that are neither features nor identifiers (line keys, folds).
    """

    @keyword_only
    def __init__(
        self,
        *,
        roles: Roles = RETAIL,
        outlierMethod: str = "iqr",
        outlierThreshold: float = 1.5,
        scaleFeatures: bool = True,
        scaleTarget: bool = True,
        logTarget: bool = False,
        statistics: str = "batch",
        scaledTargetCol: str = "scaled_target",
        maxLabels: int = MAX_LABELS,
        oneHotCol: str = "one_hot",
        stageInput: bool = True,
    ):
        super().__init__()
        settings = dict(self._input_kwargs)
        self.roles = settings.pop("roles", RETAIL)
        self._setDefault(
            outlierMethod="iqr",
            outlierThreshold=1.5,
            scaleFeatures=True,
            scaleTarget=True,
            logTarget=False,
            statistics="batch",
            scaledTargetCol="scaled_target",
            maxLabels=MAX_LABELS,
            oneHotCol="one_hot",
            stageInput=True,
        )
        self._set(**settings)
        if self.getOrDefault("outlierMethod") not in steps.OUTLIER_METHODS:
            raise ValueError(f"outlierMethod must be one of {steps.OUTLIER_METHODS}")
        if self.getOrDefault("statistics") not in ("batch", "fit"):
            raise ValueError("statistics must be 'batch' or 'fit'")

    def copy(self, extra=None):
        that = super().copy(extra)
        that.roles = self.roles
        return that

    def _save_state(self, path: str, spark: SparkSession) -> dict:
        return {"roles": self.roles.as_dict()}

    @classmethod
    def _load_state(cls, path: str, state: dict, spark: SparkSession) -> "TablePreparer":
        return cls(roles=Roles.of_dict(state["roles"]))

    def _fit(self, dataset: DataFrame) -> "TablePreparerModel":
        return self._learn(dataset)[0]

    def fit_transform(self, dataset: DataFrame) -> "tuple[TablePreparerModel, DataFrame]":
        """The fitted model, and ``dataset`` as it transforms it: statistics and the filled frame are not worked out twice.

        On the frame of the fit both settings of ``statistics`` agree.
        """
        model, filled = self._learn(dataset)
        return model, model._finish(filled)

    def _learn(self, dataset: DataFrame) -> "tuple[TablePreparerModel, DataFrame]":
        """The fitted model and the stored frame with labels standardised and gaps filled."""
        roles, got = self.roles, Fitted()
        if roles.target not in dataset.columns:
            raise ValueError(f"fit needs the target column {roles.target!r}")
        if roles.opened_year not in dataset.columns:
            raise ValueError(f"fit needs the column {roles.opened_year!r}")
        base = steps.standardize_labels(clean_missing(dataset), roles.label_fixes)
        if self.getOrDefault("stageInput"):
            base = materialize(base)
        has = set(base.columns)

        levels = mean_levels(base, roles)
        if levels:
            got.means, got.overall_means = steps.learn_means(base, levels)
        if roles.outlet_size in has:
            cube = size_cube(base, roles, roles.target)
            got.size_modes, got.overall_size = steps.learn_modes(cube, roles.outlet_size, size_levels(roles))
        else:
            cube = steps.count_cube(base, [roles.outlet], roles.target)
        got.encoding, got.overall_target = steps.learn_target_encoding(cube, roles.outlet, roles.smoothing)
        if roles.visibility in has:
            got.visibility = steps.learn_positive_medians(base, roles.visibility, roles.item_type)
        filled = materialize(_impute(base, roles, got, stored=True))  # lookups are joined once, for the passes below and transform

        moments = self._learn_bounds(filled, got)
        featured = steps.apply_target_encoding(
            steps.add_features(filled, roles, got.edges), got.encoding, got.overall_target, roles.outlet_encoding
        )
        nominal = [c for c in roles.nominal if c in featured.columns]
        counted: dict[str, dict[str, int]] = {}
        if nominal:
            counts = steps.count_labels(featured, nominal)
            wide = steps.wide_features(counts, self.getOrDefault("maxLabels"))
            counted = steps.collect_labels(counts, [c for c in nominal if c not in wide])
            if wide:
                if self.getOrDefault("oneHotCol") in featured.columns:
                    raise ValueError(f"the input has a column {self.getOrDefault('oneHotCol')!r}; choose another oneHotCol")
                got.block = steps.learn_sparse_block(counts, list(wide), scaled=self.getOrDefault("scaleFeatures"))
        got.labels = {c: list(labels) for c, labels in counted.items()}

        left_out = {*roles.ids, roles.target, *roles.passthrough}
        plain = [c for c in featured.columns if c not in left_out and c not in nominal]
        got.features = plain + [f"{c}_{label}" for c in counted for label in counted[c]]
        got.features += [self.getOrDefault("oneHotCol")] if got.block else []
        if self.getOrDefault("scaleFeatures"):
            skip = {*left_out, *roles.ordinal, *nominal}
            scaled = numeric_columns(featured, exclude=list(skip))
            got.scale = {c: moments[c] for c in scaled if c in moments}
            derived = [c for c in scaled if c not in moments]
            got.scale |= steps.learn_scale(featured, derived) if derived else {}
            for c, labels in counted.items():  # a 0/1 column with share p has mean p and variance p(1-p)
                total = sum(labels.values())
                got.scale |= {
                    f"{c}_{label}": (n / total, math.sqrt(n / total * (1 - n / total))) for label, n in labels.items()
                }
        if self.getOrDefault("scaleTarget"):
            got.target_scale = learn_target_scale(base, roles.target, log=self.getOrDefault("logTarget"))
        return self._copyValues(TablePreparerModel(roles, got)), filled

    def _learn_bounds(self, filled: DataFrame, got: Fitted) -> dict[str, tuple[float, float]]:
        """Outlier bounds of all numeric columns and the price band edges, sharing one quantile pass.

        Gives the mean and population standard deviation of the columns that went through it.
        """
        roles, threshold = self.roles, self.getOrDefault("outlierThreshold")
        columns = numeric_columns(filled, exclude=[roles.target, *roles.passthrough])
        fifths = [0.2, 0.4, 0.6, 0.8]
        if self.getOrDefault("outlierMethod") == "iqr":
            found, moments = steps.column_quantiles(filled, columns, [0.25, 0.75, *fifths])
            got.bounds = steps.iqr_bounds({c: (q[0], q[1]) for c, q in found.items()}, threshold)
            fifths_found = found.get(roles.price, [])[2:]
        else:
            got.bounds = steps.zscore_bounds(filled, columns, threshold)
            found, moments = (
                steps.column_quantiles(filled, [roles.price], fifths) if roles.price in columns else ({}, {})
            )
            fifths_found = found.get(roles.price, [])
        got.edges = steps.price_edges(fifths_found) if fifths_found else None
        return moments


def _impute(df: DataFrame, roles: Roles, got: Fitted, *, stored: bool = False) -> DataFrame:
    levels = mean_levels(df, roles)
    if levels and got.means:
        df = steps.fill_means(df, levels, got.means, got.overall_means, stored=stored)
    if roles.outlet_size in df.columns:
        df = steps.fill_modes(df, roles.outlet_size, got.size_modes, got.overall_size)
    if roles.visibility in df.columns and got.visibility is not None:
        df = steps.fill_zeros(df, roles.visibility, got.visibility)
    return df


class TablePreparerModel(Model, _PreparerParams, Stored):
    """Standardise labels, impute, cap, add features, encode, scale: one projection plus sized lookups.

    Output: identifiers and passthrough columns, the target if the input has one (raw and scaled), then
    ``feature_names`` in order. Nominal features of more than ``maxLabels`` labels share one sparse vector, ``oneHotCol``,
    which is the last feature; :func:`~shelfwise.operators.regress.assemble` takes it like any other. With ``statistics='batch'`` size modes and visibility medians are recomputed from the
    frame at hand (aggregates only); with ``'fit'`` the learned ones are used and nothing is computed up front.
    """

    def __init__(self, roles: Roles = RETAIL, fitted: Fitted | None = None):
        super().__init__()
        self._setDefault(
            outlierMethod="iqr",
            outlierThreshold=1.5,
            scaleFeatures=True,
            scaleTarget=True,
            logTarget=False,
            statistics="batch",
            scaledTargetCol="scaled_target",
            maxLabels=MAX_LABELS,
            oneHotCol="one_hot",
            stageInput=True,
        )
        self.roles, self.fitted = roles, fitted or Fitted()

    def copy(self, extra=None):
        that = super().copy(extra)
        that.roles, that.fitted = self.roles, self.fitted
        return that

    @property
    def feature_names(self) -> list[str]:
        return list(self.fitted.features)

    @property
    def target_scale(self) -> TargetScale:
        return self.fitted.target_scale

    def outlier_summary(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(lo), float(hi)) for c, (lo, hi) in self.fitted.bounds.items()]
        return spark.createDataFrame(rows, "column string, lower_bound double, upper_bound double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        roles, got = self.roles, self.fitted
        base = steps.standardize_labels(clean_missing(dataset), roles.label_fixes)
        in_use = got if self.getOrDefault("statistics") == "fit" else self._batch_statistics(base)
        return self._finish(_impute(base, roles, in_use))

    def _finish(self, filled: DataFrame) -> DataFrame:
        """Everything after imputation."""
        roles, got = self.roles, self.fitted
        x = steps.cap_outliers(filled, got.bounds)
        x = steps.add_features(x, roles, got.edges)
        x = steps.apply_target_encoding(x, got.encoding, got.overall_target, roles.outlet_encoding)
        x = steps.one_hot_encode(steps.ordinal_encode(x, roles.label_order), got.labels)
        x = steps.scale_features(x, got.scale)
        if got.block:
            x = steps.one_hot_vector(x, got.block, self.getOrDefault("oneHotCol"))
        carried = [c for c in dict.fromkeys([*roles.ids, *roles.passthrough, roles.target]) if c in x.columns]
        if roles.target in x.columns:
            x = x.withColumn(self.getOrDefault("scaledTargetCol"), got.target_scale.forward(F.col(roles.target)))
            carried.append(self.getOrDefault("scaledTargetCol"))
        return x.select(*carried, *[F.col(f"`{c}`") for c in got.features if c in x.columns])

    def _batch_statistics(self, base: DataFrame) -> Fitted:
        roles, got = self.roles, self.fitted
        fresh = Fitted(means=got.means, overall_means=got.overall_means)
        if roles.outlet_size in base.columns:
            fresh.size_modes, fresh.overall_size = steps.learn_modes(
                size_cube(base, roles), roles.outlet_size, size_levels(roles)
            )
        if roles.visibility in base.columns:
            fresh.visibility = steps.learn_positive_medians(base, roles.visibility, roles.item_type)
        return fresh

    # --- storage ----------------------------------------------------------------------------------------------------

    def save_to(self, path: str, spark: SparkSession) -> None:
        """Save, replacing what an earlier save left there."""
        self.write().session(spark).overwrite().save(path)

    @classmethod
    def load_from(cls, path: str, spark: SparkSession) -> "TablePreparerModel":
        return cls.read().session(spark).load(path)

    def _save_state(self, path: str, spark: SparkSession) -> dict:
        """Every lookup as a table, the rest as numbers."""
        got = self.fitted
        tables = {
            **{f"mean_{i}": lookup for i, lookup in enumerate(got.means)},
            **{f"mode_{i}": lookup for i, lookup in enumerate(got.size_modes)},
            **({"visibility": got.visibility} if got.visibility else {}),
            **({"encoding": got.encoding} if got.encoding else {}),
            **({f"wide_{i}": lookup for i, lookup in enumerate(got.block.lookups)} if got.block else {}),
        }
        for name, lookup in tables.items():
            lookup.table.write.parquet(f"{path}/{name}")
        return {
            "roles": self.roles.as_dict(),
            "tables": {name: list(lookup.keys) for name, lookup in tables.items()},
            "target_scale": asdict(got.target_scale),
            "block": [list(got.block.features), got.block.size] if got.block else None,
            **{k: getattr(got, k) for k in (
                "overall_means", "overall_size", "bounds", "edges", "overall_target", "labels", "scale", "features",
            )},
        }

    @classmethod
    def _load_state(cls, path: str, state: dict, spark: SparkSession) -> "TablePreparerModel":
        found = {
            name: store_lookup(spark.read.parquet(f"{path}/{name}"), keys, stored=True)
            for name, keys in state["tables"].items()
        }

        def numbered(prefix: str) -> Sequence[Lookup]:
            return [found[f"{prefix}_{i}"] for i in range(sum(n.startswith(f"{prefix}_") for n in found))]

        wide = state.get("block")  # models saved before there were sparse blocks have none
        return cls(
            Roles.of_dict(state["roles"]),
            Fitted(
                means=list(numbered("mean")),
                overall_means=state["overall_means"],
                size_modes=list(numbered("mode")),
                overall_size=state["overall_size"],
                visibility=found.get("visibility"),
                bounds={c: tuple(b) for c, b in state["bounds"].items()},
                edges=state["edges"],
                encoding=found.get("encoding"),
                overall_target=state["overall_target"],
                labels=state["labels"],
                block=steps.SparseBlock(tuple(wide[0]), tuple(numbered("wide")), wide[1]) if wide else None,
                scale={c: tuple(s) for c, s in state["scale"].items()},
                target_scale=TargetScale(**state["target_scale"]),
                features=state["features"],
            ),
        )


def preparer(
    *, outlierMethod: str = "iqr", scaleFeatures: bool = True, scaleTarget: bool = False, logTarget: bool = False,
    roles: Roles = RETAIL,
) -> TablePreparer:
    """A preparer with the short-hand defaults: features scaled, target left in real units."""
    return TablePreparer(
        roles=roles, outlierMethod=outlierMethod, scaleFeatures=scaleFeatures, scaleTarget=scaleTarget, logTarget=logTarget
    )
