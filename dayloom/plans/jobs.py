"""The scheduled jobs as recorded runs: each publishes dated snapshots and one run record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.operators.features import SERIES
from dayloom.operators.monitor import retrain_flag
from dayloom.operators.panel import require_columns
from dayloom.plans import gold, monitoring, training
from dayloom.sources.lake import run_job


def build_gold(spark: SparkSession, root: str, run_date: str, silver: DataFrame) -> str:
    """Silver to the daily panel and its feature table; nothing to do without silver rows."""

    def make():
        if silver.isEmpty():
            return None
        panel = gold.daily_panel(silver)
        return {"gold_daily": panel, "gold_features": gold.feature_table(panel)}

    return run_job(spark, root, "gold", run_date, make)


def train(
    spark: SparkSession, root: str, run_date: str, daily: DataFrame, cached: DataFrame | None = None,
    n_trees: int = S.TREES, keys: list[str] = SERIES,
) -> str:
    """Both families on all days: linear fits on their searched or cached lags (the next run's
    cache), tree models with the number of trees chosen before the holdout."""

    def make():
        require_columns(daily, {*keys, "ds", "y", *S.EXOG})
        as_of = F.lit(run_date).cast("date")
        return {
            "linear_models": training.fit_ordered_models(daily, cached, as_of, held_back=0, keys=keys),
            "tree_models": training.production_trees(gold.feature_table(daily, keys), n_trees, keys),
        }

    return run_job(spark, root, "training", run_date, make)


def monitor(
    spark: SparkSession, root: str, run_date: str, daily: DataFrame, forecasts: DataFrame, baseline: DataFrame,
    triggers: DataFrame, keys: list[str] = SERIES,
) -> str:
    """The report of the day, and the retrain flag as the decision leaves it."""
    as_of: Column = F.lit(run_date).cast("date")

    def make():
        report = monitoring.report(daily, forecasts, baseline, triggers, as_of, keys)
        return {"drift_report": report, "retrain_flag": retrain_flag(report, keys)}

    return run_job(spark, root, "monitoring", run_date, make)
