"""The daily monitoring report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from dayloom.operators import monitor
from dayloom.operators.features import SERIES
from dayloom.plans.gold import WEATHER


def report(
    daily: DataFrame, forecasts: DataFrame, baseline: DataFrame, triggers: DataFrame, as_of: Column,
    keys=SERIES,
) -> DataFrame:
    """One row per series: live error, drift (``psi_scores`` by feature), decision and its reasons. Columns of ``baseline``: keys,
    training_mae; of ``triggers``: keys, trigger_date."""
    live = monitor.live_metrics(monitor.live_errors(forecasts, daily, as_of, keys=keys), keys)
    psi = monitor.psi_summary(monitor.psi_scores(daily, WEATHER, keys), keys)
    return monitor.retrain_decision(live, baseline, psi, triggers, as_of, keys)
