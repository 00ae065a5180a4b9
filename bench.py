"""Times the headline queries; prints one JSON line.

Every query runs in full: each result is reduced to a count over all its columns' hash, so
that no column can be pruned away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from dayloom.catalog import QUERIES
from dayloom.session import local_session

HEADLINE = [
    "daily_features",
    "daily_rollup",
    "gap_filled_panel",
    "hierarchy_rollup",
    "silver_merge",
    "two_feed_history",
    "describe_by_group",
    "distinct_counts",
    "correlation_matrix",
    "seasonal_decomposition",
    "autocorrelation",
    "linear_fit",
    "linear_backtest",
    "linear_recursion",
    "backtest_scores",
    "block_bootstrap",
    "psi_by_feature",
    "live_errors",
    "monitoring_report",
    "served_forecast",
    "stream_daily_totals",
    "tree_backtest",
    "holdout_predictions",
    "tree_cv_scores",
    "tree_importance",
    "served_ensemble",
]


def run(df) -> int:
    row = df.select(F.xxhash64(*df.columns).alias("h")).agg(F.count("h"), F.bit_xor("h")).first()
    return row[0]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "dayloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["daily_rollup"](spark, sf))  # class loading, file listing
    took = {}
    for name in names:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf))
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
