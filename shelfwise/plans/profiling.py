"""The whole profile of a table as named sections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import RETAIL, Roles
from shelfwise.operators import categories as cat
from shelfwise.operators import plots
from shelfwise.operators import profile as prof
from shelfwise.operators.prepare import standardize_labels
from shelfwise.operators.quantiles import exact_boxes
from shelfwise.session import materialize


def profiled_frame(df: DataFrame, roles: Roles = RETAIL) -> DataFrame:
    """The frame a profile is taken of: raw, but for the spelling of the fat content."""
    return standardize_labels(df, {roles.fat_content: roles.label_fixes.get(roles.fat_content, {})})


def profile(
    df: DataFrame, roles: Roles = RETAIL, *, digits: int | None = None, stage: bool = True
) -> dict[str, DataFrame]:
    """All profile sections in report order. ``digits=2`` rounds the outlet and item tables for display.

    The sections scan the frame some forty times, so it is stored first; ``stage=False`` is for a frame that is a plain
    columnar table already.
    """
    df = profiled_frame(df, roles)
    if stage:
        df = materialize(df)
    target, features = roles.target, roles.category_features
    # Passes that several sections read: moments and quartiles of all numbers, and the target's box.
    numbers = prof.describe(df, roles.numeric)
    boxes = materialize(exact_boxes(df, [], target))
    sections = {
        "dataset_shape": prof.dataset_shape(df),
        "column_types": prof.column_types(df),
        "describe_numeric": numbers,
        "missing_values": prof.missing_values(df),
        "describe_target": prof.describe(df, [target], found=numbers),
        "iqr_outliers": prof.iqr_outliers(df, target, boxes=boxes),
        "histogram_target": plots.histogram(df, [target], 50),
        "box_stats": plots.box_stats(df, target, boxes=boxes),
        "histogram_log_target": plots.histogram(df, [target], 50, log=True),
        "distribution_shape": prof.distribution_shape(df, target),
        "correlation_matrix": prof.correlation_matrix(df, roles.numeric),
        "histogram_features": plots.histogram(df, roles.numeric_features, 30),
        "corr_with_target": prof.corr_with_target(df, roles.numeric_features, target),
        "value_counts": cat.value_counts(df, features),
        "cardinality": cat.cardinality(df, features),
        "target_by_category": cat.target_by_category(df, features, target),
        "box_stats_by_category": plots.box_stats_by_category(df, features, target),
        "outlet_performance": cat.outlet_performance(df, roles.outlet, target, digits=digits),
        "sales_by_year": cat.group_stats(df, roles.opened_year, target, ["mean", "count"], digits=digits),
        "pivot_type_size": cat.pivot_mean(df, roles.outlet_type, roles.outlet_size, target),
        "sales_by_location": cat.group_stats(df, roles.outlet_location, target, ["mean"]),
        "item_type_stats": cat.group_stats(
            df, roles.item_type, target, ["mean", "median", "count", "std"], digits=digits
        ).orderBy(F.desc("mean"), roles.item_type),
        "fat_content_stats": cat.group_stats(
            df, roles.fat_content, target, ["mean", "median", "count"], digits=digits
        ),
        "mrp_equal_width": cat.price_band_stats(df, roles.price, target, roles.price_labels),
    }
    for rows, columns in roles.interactions:
        sections[f"pivot_{rows}_by_{columns}".lower()] = cat.pivot_mean(df, rows, columns, target)
    sections |= {
        "anova": cat.with_p_values(cat.anova_f(df, roles.categorical, target)),
        "duplicate_rows": prof.duplicate_rows(df),
        "target_sign_checks": prof.target_sign_checks(df, target),
        "distinct_labels": cat.distinct_labels(df, roles.fat_content),
        "id_prefix_counts": cat.prefix_counts(df, roles.outlet),
        "insights": prof.insights(df, roles),
    }
    return sections


def stacked(sections: dict[str, DataFrame]) -> DataFrame:
    """All sections as one table (section, content), each row as JSON."""
    parts = [
        section.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("content"))
        for name, section in sections.items()
    ]
    return reduce(DataFrame.unionByName, parts)
