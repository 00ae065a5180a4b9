"""Feature columns on a gap-free daily panel.

All functions share one window (series, ordered by day), so Spark keeps one exchange by
series under the whole chain. Because the panel has no gaps, row offsets are day offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.functions import calendar as C

SERIES = ["series_id"]


def by_day(keys: list[str] = SERIES):
    return Window.partitionBy(*keys).orderBy("ds")


def whole(keys: list[str] = SERIES):
    return Window.partitionBy(*keys)


def trailing(col: Column, agg, size: int, keys: list[str] = SERIES, current: bool = False) -> Column:
    """Aggregate of the last ``size`` rows, missing until that many values exist. Without
    ``current`` the row itself is left out, so a feature never sees its own target."""
    last = 0 if current else -1
    frame = by_day(keys).rowsBetween(last - size + 1, last)
    return F.when(F.count(col).over(frame) == size, agg(col).over(frame))


def holiday_and_snow(panel: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    return panel.withColumns(
        {
            "is_holiday": C.is_federal_holiday(F.col("ds")),
            "snow_lag1": F.coalesce(F.lag("snow", 1).over(by_day(keys)), F.lit(0.0)),
        }
    )


def calendar_features(panel: DataFrame) -> DataFrame:
    ds = F.col("ds")
    return panel.withColumns(
        {
            "day_of_week": C.day_of_week(ds),
            "month": F.month(ds),
            "is_weekend": C.is_weekend(ds),
        }
    )


def lag_name(k: int) -> str:
    return f"y_lag{k}"


def history_features(
    panel: DataFrame,
    keys: list[str] = SERIES,
    lags: tuple[int, ...] = S.LAGS,
    unit: float = S.UNIT_SCALE,
    ddof: int = 1,
) -> DataFrame:
    std = F.stddev_samp if ddof else F.stddev_pop
    w = by_day(keys)
    cols = {lag_name(k): F.lag("y", k).over(w) / unit for k in lags}
    cols["y_mean14"] = trailing(F.col("y"), F.avg, S.MEAN_WINDOW, keys) / unit
    cols["y_std7"] = trailing(F.col("y"), std, S.STD_WINDOW, keys) / unit
    cols["precip_lag1"] = F.lag("precip", 1).over(w)
    cols["temp_lag1"] = F.lag("temp", 1).over(w)
    return panel.withColumns(cols)


def feature_panel(daily: DataFrame, keys: list[str] = SERIES, **kw) -> DataFrame:
    """The training table: calendar, lags and rolling statistics, complete rows only."""
    return history_features(calendar_features(daily), keys, **kw).na.drop("any")


def deviation_from_week(value: str = "y", keys: list[str] = SERIES) -> Column:
    return F.col(value) - trailing(F.col(value), F.avg, S.SEASON, keys)


def position(keys: list[str] = SERIES) -> Column:
    """0-based day position; a window function only over the first date."""
    return F.datediff("ds", F.min("ds").over(whole(keys)))


def days_from_end(keys: list[str] = SERIES) -> Column:
    return F.datediff(F.max("ds").over(whole(keys)), "ds")


def last_days(panel: DataFrame, n: int, keys: list[str] = SERIES) -> DataFrame:
    """The last n rows of each gap-free series."""
    return panel.withColumn("_back", days_from_end(keys)).where(F.col("_back") < n).drop("_back")


def holdout_split(panel: DataFrame, days: int = S.HOLDOUT_DAYS, keys: list[str] = SERIES) -> DataFrame:
    back = days_from_end(keys)
    return panel.withColumn("split", F.when(back < days, "test").otherwise("train"))


def scale_columns(
    panel: DataFrame, columns: list[str], is_train: Column, keys: list[str] = SERIES
) -> DataFrame:
    """Min–max scaling fitted on the training rows; a constant column becomes 0 there."""
    w = whole(keys)
    bounds = {}
    for c in columns:
        seen = F.when(is_train, F.col(c))
        bounds[f"_lo_{c}"] = F.min(seen).over(w)
        bounds[f"_hi_{c}"] = F.max(seen).over(w)
    df = panel.withColumns(bounds)
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        scaled[c] = (F.col(c) - lo) / F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    return df.withColumns(scaled).drop(*bounds)


def scale_bounds(panel: DataFrame, columns: list[str], is_train: Column, keys: list[str] = SERIES):
    """The scaler itself, as a table: one row per series."""
    aggs = []
    for c in columns:
        seen = F.when(is_train, F.col(c))
        aggs += [F.min(seen).alias(f"{c}_min"), F.max(seen).alias(f"{c}_max")]
    return panel.groupBy(*keys).agg(*aggs)


def cv_folds(rows: DataFrame, splits: int = S.CV_SPLITS, keys: list[str] = SERIES) -> DataFrame:
    """Expanding-window folds as positions: train [0, train_end), test [train_end, test_end).
    Only the fold table is made; rows are matched to it by position."""
    n = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    size = F.floor(F.col("n_rows") / (splits + 1))
    folds = n.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(splits))))
    start = F.col("n_rows") - (F.lit(splits + 1) - F.col("fold")) * size
    return folds.select(
        *keys,
        "fold",
        start.cast("long").alias("train_end"),
        (start + size).cast("long").alias("test_end"),
    )


def test_fold(splits: int = S.CV_SPLITS, keys: list[str] = SERIES) -> Column:
    """Fold in which a row is tested (0: only ever trained on). A row belongs to the
    training part of every later fold, so no row is copied."""
    w = Window.partitionBy(*keys)
    n = F.count("*").over(w)
    size = F.floor(n / (splits + 1))
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy("ds")) - 1
    first = n - size * splits
    return F.when(pos < first, 0).otherwise(F.floor((pos - first) / size) + 1).cast("int")
