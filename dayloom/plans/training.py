"""Training and evaluation of both model families for every series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.operators import forecast, linear, trees
from dayloom.operators.features import (
    SERIES,
    days_from_end,
    feature_panel,
    lag_name,
    scale_columns,
)
from dayloom.session import stage

EXOG = list(S.EXOG)
CASE_COVARIATES = sorted({*EXOG, *trees.WEATHER, "is_holiday"})


def scaled_training_rows(daily: DataFrame, held_back: int, keys=SERIES) -> DataFrame:
    """Feature rows with the target in units and scaled covariates. The scaler sees every
    day before the held-back part, as it does when the forecast cases are scaled."""
    scaled = scale_columns(daily, EXOG, days_from_end(keys) >= held_back, keys)
    rows = feature_panel(scaled, keys).withColumn("_back", days_from_end(keys))
    return rows.withColumn("target", F.col("y") / S.UNIT_SCALE)


def fit_linear_models(daily: DataFrame, held_back: int = S.EVAL_DAYS, lags=S.LAGS, keys=SERIES) -> DataFrame:
    """Coefficients per series, fitted on all but the last ``held_back`` days."""
    rows = scaled_training_rows(daily, held_back, keys).where(F.col("_back") >= held_back)
    return linear.fit_linear(rows, [lag_name(k) for k in lags] + EXOG, "target", keys)


def fit_ordered_models(
    daily: DataFrame,
    cached: DataFrame | None = None,
    as_of: Column | None = None,
    held_back: int = S.EVAL_DAYS,
    keys=SERIES,
) -> DataFrame:
    """Search, cache, fit: every series on its own lag set, all from one cross-product table.

    A cached set (keys, lags, search_date) younger than 90 days at ``as_of`` is kept, else the best
    set by AIC is taken and dated ``as_of``. Returns the fit with ``source`` and ``search_date``;
    these and the lags are the next run's cache.
    """
    lags = sorted(S.LAGS)
    names = [lag_name(k) for k in lags] + EXOG
    rows = scaled_training_rows(daily, held_back, keys).where(F.col("_back") >= held_back)
    sums = stage(linear.cross_products(rows, names, "target", keys), "products")
    order = linear.search_lags(sums, linear.lag_subsets(), lags, len(EXOG), keys)
    if cached is None:
        order = order.select(*keys, "lags", F.lit("searched").alias("source"))
    else:
        order = linear.resolve_order(sums.select(*keys), cached, order, as_of, keys=keys)
    fit = linear.fit_chosen(sums, order, lags, len(EXOG), keys)
    return fit.join(order.drop("lags"), keys)


def linear_backtest(
    daily: DataFrame, eval_days: int = S.EVAL_DAYS, lags=S.LAGS, keys=SERIES, coef: DataFrame | None = None
) -> DataFrame:
    """Backtest cases with the linear path and both baselines. Parameters are fitted once
    before the window; every origin only brings a newer history."""
    scaled = scale_columns(daily, EXOG, days_from_end(keys) >= eval_days, keys)
    cases = forecast.rolling_origins(scaled, EXOG, eval_days=eval_days, keys=keys)
    fit = coef if coef is not None else fit_linear_models(daily, eval_days, lags, keys)
    joined = cases.join(fit.select(*keys, "coef"), keys)
    path = linear.recurse_linear(F.col("hist"), F.col("future"), F.col("coef"), list(lags), EXOG)
    return add_baselines(joined.withColumn("linear", path))


def add_baselines(cases: DataFrame) -> DataFrame:
    return cases.withColumns(
        {
            "seasonal_naive": forecast.seasonal_naive(F.col("hist")),
            "persistence": forecast.persistence(F.col("hist")),
        }
    )


def tree_covariates(daily: DataFrame, keys=SERIES) -> DataFrame:
    """Weather of the day and of the day before, as the tree features need it."""
    from dayloom.operators.features import by_day

    w = by_day(keys)
    return daily.withColumns(
        {f"{c}_lag1": F.coalesce(F.lag(c, 1).over(w), F.col(c)) for c in ("temp", "precip")}
    )


def full_backtest(
    daily: DataFrame, n_trees: int = S.TREES, eval_days: int = S.EVAL_DAYS, keys=SERIES
) -> DataFrame:
    """Both families, both baselines and the equal-weight ensemble on the same cases."""
    fit = fit_linear_models(daily, eval_days, keys=keys)
    raw = tree_covariates(daily, keys)
    train = feature_panel(daily, keys).withColumn("_back", days_from_end(keys))
    train = train.where(F.col("_back") >= eval_days)
    model = trees.fit_trees(train, n_trees, stop_days=S.HOLDOUT_DAYS, keys=keys)

    # The linear model sees scaled covariates, the trees the plain ones: both in one struct.
    plain = {f"raw_{c}": F.col(c) for c in CASE_COVARIATES}
    both = scale_columns(raw.withColumns(plain), EXOG, days_from_end(keys) >= eval_days, keys)
    cases = forecast.rolling_origins(both, EXOG + list(plain), eval_days=eval_days, keys=keys)
    cases = cases.join(fit.select(*keys, "coef"), keys)
    path = linear.recurse_linear(F.col("hist"), F.col("future"), F.col("coef"), list(S.LAGS), EXOG)
    cases = add_baselines(cases.withColumn("linear", path)).withColumn(
        "future",
        F.transform(
            "future", lambda r: F.struct(*[r[f"raw_{c}"].alias(c) for c in CASE_COVARIATES])
        ),
    )
    scored = trees.forecast_trees(model, cases, keys=keys)
    return scored.withColumn("ensemble", forecast.blend_arrays(F.col("linear"), F.col("trees")))


def holdout_paths(daily: DataFrame, days: int = S.HOLDOUT_DAYS, n_trees: int = S.TREES, keys=SERIES):
    """Recursive forecasts of the last ``days`` days by both families, fitted before them."""
    case = forecast.rolling_origins
    fit = fit_linear_models(daily, days, keys=keys)
    train = feature_panel(daily, keys).withColumn("_back", days_from_end(keys)).where(F.col("_back") >= days)
    # scored is the model that was stopped before the holdout, on days it was not fitted to
    model = trees.fit_trees(train, n_trees, stop_days=days, refit=False, keys=keys)
    plain = {f"raw_{c}": F.col(c) for c in CASE_COVARIATES}
    both = scale_columns(
        tree_covariates(daily, keys).withColumns(plain), EXOG, days_from_end(keys) >= days, keys
    )
    cases = case(both, EXOG + list(plain), eval_days=days, step=days, horizon=days, keys=keys)
    cases = cases.join(fit.select(*keys, "coef"), keys)
    path = linear.recurse_linear(
        F.col("hist"), F.col("future"), F.col("coef"), list(S.LAGS), EXOG, horizon=days
    )
    cases = cases.withColumn("linear", path).withColumn(
        "future",
        F.transform(
            "future", lambda r: F.struct(*[r[f"raw_{c}"].alias(c) for c in CASE_COVARIATES])
        ),
    )
    return trees.forecast_trees(model, cases, horizon=days, keys=keys)


def production_trees(rows: DataFrame, n_trees: int = S.TREES, keys=SERIES) -> DataFrame:
    """The served model: as many trees as the fit before the holdout chose, refitted on all rows."""
    return trees.fit_trees(rows, n_trees, stop_days=S.HOLDOUT_DAYS, held_out=S.HOLDOUT_DAYS, keys=keys)
