"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores. Every query runs in full: results go to a sink that
takes all rows. One untimed query warms the session up.
"""

from __future__ import annotations

import json
import os
import time

from shelfwise.catalog.queries import CATALOG
from shelfwise.session import local_session

HEADLINE = [
    "outlet_performance",
    "describe_numeric",
    "missing_values",
    "correlation_matrix",
    "value_counts",
    "target_by_category",
    "pivot_itemtype_outlettype",
    "anova_f",
    "duplicate_rows",
    "histogram_features",
    "box_stats_by_category",
    "qq_points",
    "insights",
    "impute_weight",
    "impute_outlet_size",
    "zero_visibility_impute",
    "feature_engineering",
    "scale_features",
    "prepare_transform",
    "regression_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("shelfwise-bench", os.environ.get("BENCH_CPUS", "8"))

    def run(name: str) -> float:
        began = time.perf_counter()
        CATALOG[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run("target_by_category")
    times = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
