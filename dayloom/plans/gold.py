"""Silver → gold: the daily panel and the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dayloom.operators import features, panel

WEATHER = ["temp", "precip", "snow"]


def daily_panel(silver: DataFrame, keys: list[str] = ("series_id",), digits: int = 6) -> DataFrame:
    """Daily rollup, missing days, interpolation, holiday flag, yesterday's snow."""
    keys = list(keys)
    daily = panel.rollup_daily(silver, keys, ["y"], WEATHER, digits=digits)
    filled = panel.fill_gaps(daily, keys, interpolate=["y", "temp"], zero_fill=["precip", "snow"])
    return features.holiday_and_snow(filled, keys)


def feature_table(daily: DataFrame, keys: list[str] = ("series_id",)) -> DataFrame:
    return features.feature_panel(daily, list(keys))
