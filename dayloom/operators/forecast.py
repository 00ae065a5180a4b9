"""Forecast origins, naive baselines, ensembles and forecast tables.

A forecast case is one row: a series at an origin, with its recent history and the known
future covariates as short arrays (their length is the lag depth and the horizon). Every
model adds one array of ``horizon`` values to the row, so models, ensembles and errors of a
case meet without any join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.functions import calendar as C
from dayloom.functions.errors import blend
from dayloom.operators.features import SERIES, by_day, whole


# Weather whose previous-day value is a feature.
CHAINED = ["snow", "temp", "precip"]


def _arrays(panel: DataFrame, covariates: list[str], depth: int, horizon: int, keys, unit):
    """History and future of every row as arrays over one shared window."""
    back = by_day(keys).rowsBetween(-(depth - 1), 0)
    ahead = by_day(keys).rowsBetween(1, horizon)
    row = F.struct(*[F.col(c).cast("double").alias(c) for c in covariates])
    value = F.col("y") / unit
    return panel.withColumns(
        {
            "hist": F.collect_list(value).over(back),
            "actual": F.collect_list(value).over(ahead),
            "future": F.collect_list(row).over(ahead) if covariates else F.array(),
        }
    )


def rolling_origins(
    panel: DataFrame,
    covariates: list[str] = (),
    eval_days: int = S.EVAL_DAYS,
    step: int = S.STEP,
    horizon: int = S.HORIZON,
    depth: int = max(S.LAGS),
    keys: list[str] = SERIES,
    unit: float = S.UNIT_SCALE,
) -> DataFrame:
    """Backtest cases: positions n − eval_days − 1, then every ``step`` days, while a full
    horizon of actuals remains. Days that no case can touch are dropped before the arrays
    are built."""
    back = F.datediff(F.max("ds").over(whole(keys)), "ds")
    df = panel.withColumn("_back", back)
    df = df.where(F.col("_back") <= eval_days + depth)
    df = _arrays(df, list(covariates), depth, horizon, keys, unit)
    since = F.lit(eval_days) - F.col("_back")
    return df.where(
        (F.col("_back") >= horizon)
        & (F.col("_back") <= eval_days)
        & (since % step == 0)
        & (F.size("hist") == depth)
        & (F.size("actual") == horizon)
    ).select(*keys, F.col("ds").alias("origin"), "hist", "actual", "future")


def origin_count(eval_days: int = S.EVAL_DAYS, step: int = S.STEP, horizon: int = S.HORIZON) -> int:
    """How many rolling origins a series has at most."""
    return (eval_days - horizon) // step + 1


def newest_origins(
    panel: DataFrame, n: int, weekday: int = 2, depth: int = max(S.LAGS), keys: list[str] = SERIES
) -> list[dt.date]:
    """The newest n origin days of weekly runs, newest first (n values come to the driver)."""
    first = panel.withColumn("_first", F.min("ds").over(whole(keys)))
    due = first.where((F.weekday("ds") == weekday) & (F.datediff("ds", "_first") >= depth - 1))
    return [r.ds for r in due.select("ds").distinct().orderBy(F.desc("ds")).limit(n).collect()]


def snapshot_origins(
    panel: DataFrame,
    covariates: list[str] = (),
    weekday: int = 2,
    horizon: int = S.HORIZON,
    depth: int = max(S.LAGS),
    keys: list[str] = SERIES,
    unit: float = S.UNIT_SCALE,
    since: dt.date | None = None,
) -> DataFrame:
    """One case per week over the whole history, as a weekly scheduled run would make, or from an
    origin on; days that no such case touches are dropped before the arrays are built."""
    if since is not None:
        panel = panel.where(F.col("ds") > F.date_sub(F.lit(since), depth))
    df = _arrays(panel, list(covariates), depth, horizon, keys, unit)
    return df.where((F.size("hist") == depth) & (F.weekday("ds") == weekday)).select(
        *keys, F.col("ds").alias("origin"), "hist", "actual", "future"
    )


def seasonal_naive(hist: Column, season: int = S.SEASON, horizon: int = S.HORIZON) -> Column:
    """Step h repeats the value one season back, from what is known at the origin."""
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    return F.transform(steps, lambda h: F.get(hist, F.size(hist) - season + h % season))


def persistence(hist: Column, horizon: int = S.HORIZON) -> Column:
    return F.array_repeat(F.get(hist, F.size(hist) - 1), horizon)


def blend_arrays(a: Column, b: Column, weight: float = S.BLEND_WEIGHT) -> Column:
    return F.zip_with(a, b, lambda x, z: blend(x, z, weight))


def to_long(cases: DataFrame, models: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One row per case, model and horizon step."""
    entries = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("path")) for m in models])
    rows = cases.select(*keys, "origin", "actual", F.explode(entries).alias("_m")).select(
        *keys,
        "origin",
        F.col("_m.model").alias("model"),
        "actual",
        F.posexplode("_m.path").alias("_i", "yhat"),
    )
    return rows.select(
        *keys,
        "origin",
        (F.col("_i") + 1).alias("h"),
        F.date_add("origin", F.col("_i") + 1).alias("ds"),
        "model",
        "yhat",
        F.get("actual", F.col("_i")).alias("y"),
    )


def to_wide(cases: DataFrame, models: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One row per case and horizon step with a column per model."""
    zipped = F.arrays_zip(*[F.col(m) for m in models])
    rows = cases.select(*keys, "origin", "actual", F.posexplode(zipped).alias("_i", "_z"))
    return rows.select(
        *keys,
        "origin",
        (F.col("_i") + 1).alias("h"),
        F.date_add("origin", F.col("_i") + 1).alias("ds"),
        *[F.col(f"_z.{m}").alias(m) for m in models],
        F.get("actual", F.col("_i")).alias("y"),
    )


def last_known(panel: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """What serving needs of each series: last day and its weather, mean temperature."""
    return panel.groupBy(*keys).agg(
        F.max("ds").alias("last_ds"),
        *[F.max_by(c, "ds").alias(f"last_{c}") for c in CHAINED],
        F.avg("temp").alias("mean_temp"),
    )


def future_covariates(
    panel: DataFrame,
    outlook: DataFrame,
    horizon: int = S.HORIZON,
    keys: list[str] = SERIES,
    is_holiday=C.is_federal_holiday,
) -> DataFrame:
    """Covariates of the next ``horizon`` days: the outlook where it has the day, else mean
    temperature and no precipitation. Lagged weather is chained: day 1 looks at the last
    observed day, later days at the day before in this same table."""
    days = last_known(panel, keys).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    days = days.withColumn("ds", F.date_add("last_ds", F.col("h")))
    joined = days.join(outlook.select("ds", "temp", "precip", "snow"), "ds", "left")
    df = joined.select(
        *keys,
        "ds",
        "h",
        F.coalesce("temp", "mean_temp").alias("temp"),
        F.coalesce("precip", F.lit(0.0)).alias("precip"),
        F.coalesce("snow", F.lit(0.0)).alias("snow"),
        is_holiday(F.col("ds")).alias("is_holiday"),
        *[f"last_{c}" for c in CHAINED],
    )
    before = {
        f"{c}_lag1": F.coalesce(F.lag(c, 1).over(by_day(keys)), F.col(f"last_{c}"))
        for c in CHAINED
    }
    return df.withColumns(before).drop(*[f"last_{c}" for c in CHAINED])


def serving_cases(
    panel: DataFrame,
    future: DataFrame,
    covariates: list[str],
    depth: int = max(S.LAGS),
    keys: list[str] = SERIES,
    unit: float = S.UNIT_SCALE,
) -> DataFrame:
    """The one case per series that starts after its last actual day. New actuals move the
    origin and the history; fitted coefficients stay as they are."""
    recent = panel.withColumn("_back", F.datediff(F.max("ds").over(whole(keys)), "ds")).where(
        F.col("_back") < depth
    )
    hist = recent.groupBy(*keys).agg(
        F.max("ds").alias("origin"),
        F.sort_array(F.collect_list(F.struct("ds", (F.col("y") / unit).alias("v")))).alias("_h"),
    )
    row = F.struct("h", *[F.col(c).cast("double").alias(c) for c in covariates])
    ahead = future.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("future"))
    return hist.join(ahead, keys).select(
        *keys, "origin", F.col("_h.v").alias("hist"), F.array().cast("array<double>").alias("actual"), "future"
    )


def with_interval(rows: DataFrame, spread: DataFrame, value: str, keys: list[str], z: float = 1.959963984540054):
    """Interval from the backtest's error deviation at the same step. ``spread`` has one
    row per key and step (columns h, sigma)."""
    return (
        rows.join(spread, [*keys, "h"], "left")
        .withColumns(
            {
                "ci_lower": F.col(value) - z * F.col("sigma"),
                "ci_upper": F.col(value) + z * F.col("sigma"),
            }
        )
        .drop("sigma")
    )


def one_step_baselines(panel: DataFrame, days: int = S.HOLDOUT_DAYS, keys: list[str] = SERIES,
                       unit: float = S.UNIT_SCALE) -> DataFrame:
    """Holdout rows with the value of the day before and of the week before."""
    w = by_day(keys)
    df = panel.select(
        *keys,
        "ds",
        (F.col("y") / unit).alias("y"),
        (F.lag("y", 1).over(w) / unit).alias("persistence"),
        (F.lag("y", S.SEASON).over(w) / unit).alias("seasonal_naive"),
        F.datediff(F.max("ds").over(whole(keys)), "ds").alias("_back"),
    )
    return df.where(F.col("_back") < days).drop("_back")
