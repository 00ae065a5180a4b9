"""Serving: the next two weeks of every series from both families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.operators import forecast, linear, trees
from dayloom.operators.features import SERIES
from dayloom.plans.training import CASE_COVARIATES, EXOG
from dayloom.sources.lake import fingerprint


def scale_with(bounds: DataFrame, rows: DataFrame, columns: list[str], keys=SERIES) -> DataFrame:
    """Applies a stored scaler (one row per series) and keeps the plain values as raw_*."""
    df = rows.join(bounds, keys)
    out = {f"raw_{c}": F.col(c) for c in CASE_COVARIATES}
    for c in columns:
        lo, hi = F.col(f"{c}_min"), F.col(f"{c}_max")
        out[c] = (F.col(c) - lo) / F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    return df.withColumns(out)


def serve(
    daily: DataFrame,
    outlook: DataFrame,
    coef: DataFrame,
    bounds: DataFrame,
    model: DataFrame,
    spread: DataFrame | None = None,
    weight: float = S.BLEND_WEIGHT,
    keys=SERIES,
) -> DataFrame:
    """Forecast table of the newest day: one row per series and day ahead. The same
    recursions as in the backtest, so serving and evaluation cannot drift apart."""
    future = scale_with(bounds, forecast.future_covariates(daily, outlook, keys=keys), EXOG, keys)
    names = EXOG + [f"raw_{c}" for c in CASE_COVARIATES]
    cases = forecast.serving_cases(daily, future, names, keys=keys).join(coef.select(*keys, "coef"), keys)
    path = linear.recurse_linear(F.col("hist"), F.col("future"), F.col("coef"), list(S.LAGS), EXOG)
    cases = cases.withColumn("linear", path).withColumn(
        "future",
        F.transform(
            "future", lambda r: F.struct(*[r[f"raw_{c}"].alias(c) for c in CASE_COVARIATES])
        ),
    )
    scored = trees.forecast_trees(model, cases, keys=keys)
    scored = scored.withColumn(
        "ensemble", forecast.blend_arrays(F.col("linear"), F.col("trees"), weight)
    )
    rows = forecast.to_wide(scored, ["linear", "trees", "ensemble"], keys).drop("y")
    if spread is not None:
        rows = forecast.with_interval(rows, spread, "ensemble", keys)
    return rows


def serving_versions(gate: DataFrame) -> dict[str, str]:
    """The version that serves of each model family, as the promotion gate decided (a row a family)."""
    return {r.model: str(r.serving_version) for r in gate.select("model", "serving_version").collect()}


def stamp(rows: DataFrame, daily: DataFrame, run_date, versions: dict[str, str], image: str | None = None):
    """Lineage columns: run date, weights, model versions, data print, code image."""
    print_ = fingerprint(daily, ["series_id", "ds", "y"]).select("digest").scalar()
    return rows.withColumns(
        {
            "run_date": run_date,
            "data_digest": print_,
            "image": F.lit(image).cast("string"),
            **{f"{m}_version": F.lit(v) for m, v in versions.items()},
        }
    )
