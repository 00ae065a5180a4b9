"""The tables a dashboard would draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.operators.backtest import skill_pct
from dayloom.operators.features import SERIES, last_days


def forecast_chart(panel: DataFrame, forecast: DataFrame, models: list[str], days: int = 90,
                   keys: list[str] = SERIES, unit: float = 1.0) -> DataFrame:
    """Last actuals, then each model's path starting at the last actual point."""
    recent = last_days(panel, days, keys).select(
        *keys, "ds", F.lit("actual").alias("line"), (F.col("y") / unit).alias("value")
    )
    lines = F.array(*[F.lit(m) for m in models])
    anchor = (
        recent.groupBy(*keys)
        .agg(F.max("ds").alias("ds"), F.max_by("value", "ds").alias("value"))
        .select(*keys, "ds", F.explode(lines).alias("line"), "value")
    )
    entries = F.array(*[F.struct(F.lit(m).alias("line"), F.col(m).alias("value")) for m in models])
    paths = forecast.select(*keys, "ds", F.explode(entries).alias("_e")).select(*keys, "ds", "_e.*")
    return recent.unionByName(anchor).unionByName(paths)


def data_lag(panel: DataFrame, as_of: Column, keys: list[str] = SERIES) -> DataFrame:
    last = panel.groupBy(*keys).agg(F.max("ds").alias("last_actual"))
    lag = F.datediff(as_of, "last_actual")
    return last.select(
        *keys,
        "last_actual",
        as_of.alias("today"),
        lag.alias("lag_days"),
        F.when(lag > 0, F.date_add("last_actual", F.floor(lag / 2).cast("int"))).alias("midpoint"),
    )


def forward_total(forecast: DataFrame, value: str, days: int = 7, keys: list[str] = SERIES):
    """Total of the last ``days`` forecast days with its date range."""
    w = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    tail = forecast.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= days)
    return tail.groupBy(*keys).agg(
        F.sum(value).alias("total"), F.min("ds").alias("from_ds"), F.max("ds").alias("to_ds")
    )


def accuracy_view(backtest: DataFrame, holdout: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Backtest metrics where they exist, else the holdout's. Both sides: keys,
    ensemble_mae, seasonal_naive_mae."""
    h = holdout.select(
        *keys,
        F.col("ensemble_mae").alias("_h_ens"),
        F.col("seasonal_naive_mae").alias("_h_naive"),
    )
    df = backtest.join(h, keys, "full_outer")
    has = F.col("ensemble_mae").isNotNull()
    ens = F.coalesce("ensemble_mae", "_h_ens")
    naive = F.when(has, F.col("seasonal_naive_mae")).otherwise(F.col("_h_naive"))
    return df.select(
        *keys,
        F.when(has, "walk-forward").otherwise("holdout").alias("source"),
        ens.alias("ensemble_mae"),
        naive.alias("seasonal_naive_mae"),
        skill_pct(ens, naive).alias("skill_pct"),
    )


def axis_range(errors: DataFrame, first: str, second: str, keys: list[str] = SERIES) -> DataFrame:
    return errors.groupBy(*keys).agg(
        (F.least(F.min(first), F.min(second)) * 0.98).alias("axis_min"),
        (F.greatest(F.max(first), F.max(second)) * 1.02).alias("axis_max"),
    )
