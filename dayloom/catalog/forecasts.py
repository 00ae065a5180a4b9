"""Forecasts: baselines, linear and tree recursions, serving tables, order search."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.operators import features as FT
from dayloom.operators import forecast as FC
from dayloom.operators import linear as L
from dayloom.operators import registry as RG
from dayloom.operators import reports as R
from dayloom.operators import trees as T
from dayloom.plans import prediction, training
from dayloom.plans.gold import feature_table
from dayloom.session import stage

# A linear model with given coefficients: constant, lags 1 2 3 7 14, then the covariates.
FIXED_COEF = [0.01, 0.2, 0.1, 0.05, 0.4, 0.2, 0.002, -0.001, -0.0005, -0.01]

# Backtest origins as SQL: o(series_id, origin).
ORIGINS = f"""{B.GOLD},
    ends AS (SELECT series_id, MAX(ds) AS last_ds FROM gold GROUP BY 1),
    o AS (SELECT e.series_id, CAST(e.last_ds - 90 + 7 * i AS DATE) AS origin
      FROM ends e, (SELECT CAST(UNNEST(range(0, 11)) AS INTEGER) AS i))"""

STEPS = "(SELECT CAST(UNNEST(range(1, 15)) AS INTEGER) AS h)"

# Multi-step baselines on those origins: base(series_id, origin, h, ds, y, seasonal_naive, persistence).
BASE = f"""{ORIGINS},
    base AS (SELECT o.series_id, o.origin, s.h, CAST(o.origin + s.h AS DATE) AS ds, a.y / 1e6 AS y,
      n.y / 1e6 AS seasonal_naive, p.y / 1e6 AS persistence
      FROM o CROSS JOIN {STEPS} s
      JOIN gold a ON a.series_id = o.series_id AND a.ds = o.origin + s.h
      JOIN gold p ON p.series_id = o.series_id AND p.ds = o.origin
      JOIN gold n ON n.series_id = o.series_id
        AND n.ds = o.origin + s.h - CASE WHEN s.h <= 7 THEN 7 ELSE 14 END)"""


def _cov(row: str) -> str:
    c = FIXED_COEF
    return (
        f"+ {c[6]}::DOUBLE * {row}.temp + ({c[7]})::DOUBLE * {row}.precip + ({c[8]})::DOUBLE * {row}.snow_lag1"
        f" + ({c[9]})::DOUBLE * {row}.is_holiday"
    )


def _lagged(path: str) -> str:
    c = FIXED_COEF
    return f"{c[0]}::DOUBLE" + "".join(
        f" + {w}::DOUBLE * {path}[len({path}) - {k} + 1]" for w, k in zip(c[1:6], S.LAGS)
    )


# Recursion of the fixed model on the backtest origins: lin(series_id, origin, h, linear).
LINEAR = f"""{BASE},
    hist AS (SELECT o.series_id, o.origin, list(g.y / 1e6 ORDER BY g.ds) AS path
      FROM o JOIN gold g ON g.series_id = o.series_id AND g.ds BETWEEN o.origin - 13 AND o.origin GROUP BY 1, 2),
    rec AS (
      SELECT series_id, origin, 0 AS h, path FROM hist
      UNION ALL
      SELECT r.series_id, r.origin, r.h + 1, list_append(r.path, {_lagged('r.path')} {_cov('g')})
      FROM rec r JOIN gold g ON g.series_id = r.series_id AND g.ds = r.origin + r.h + 1 WHERE r.h < 14),
    lin AS (SELECT series_id, origin, h, path[len(path)] AS linear FROM rec WHERE h > 0),
    wide AS (SELECT b.*, l.linear FROM base b JOIN lin l
      ON l.series_id = b.series_id AND l.origin = b.origin AND l.h = b.h)"""


def fixed_cases(panel):
    """Backtest cases with the fixed linear model and both baselines."""
    cases = FC.rolling_origins(panel, list(S.EXOG))
    coef = F.array(*[F.lit(c) for c in FIXED_COEF])
    path = L.recurse_linear(F.col("hist"), F.col("future"), coef, list(S.LAGS), list(S.EXOG))
    return training.add_baselines(cases.withColumn("linear", path))


@entry(
    "rolling_origins",
    f"""WITH {ORIGINS} SELECT o.series_id, o.origin, COUNT(*) AS n_history, ROUND(SUM(g.y), 4) AS history_total
    FROM o JOIN gold g ON g.series_id = o.series_id AND g.ds BETWEEN o.origin - 13 AND o.origin GROUP BY 1, 2""",
)
def rolling_origins(spark, sf):
    """Eleven weekly origins per series."""
    cases = FC.rolling_origins(B.panel(spark, sf), unit=1.0)
    total = F.aggregate("hist", F.lit(0.0), lambda a, v: a + v)
    return cases.select(
        "series_id", "origin", F.size("hist").cast("long").alias("n_history"),
        F.round(total, 4).alias("history_total"),
    )


@entry(
    "baseline_paths",
    f"WITH {BASE} SELECT series_id, origin, h, ds, seasonal_naive, persistence, y FROM base",
)
def baseline_paths(spark, sf):
    """Seasonal-naive and persistence from every origin."""
    cases = training.add_baselines(FC.rolling_origins(B.panel(spark, sf)))
    return FC.to_wide(cases, ["seasonal_naive", "persistence"])


@entry(
    "linear_recursion",
    f"WITH RECURSIVE {LINEAR} SELECT series_id, origin, h, ds, ROUND(linear, 10) AS linear, y FROM wide",
)
def linear_recursion(spark, sf):
    """Recursive forecast of a given linear model from every origin."""
    rows = FC.to_wide(fixed_cases(B.panel(spark, sf)), ["linear"])
    return rows.withColumn("linear", F.round("linear", 10))


@entry(
    "one_step_baselines",
    f"""WITH {B.GOLD}, l AS (SELECT series_id, ds, y / 1e6 AS y, LAG(y, 1) {B.W} / 1e6 AS persistence,
      LAG(y, 7) {B.W} / 1e6 AS seasonal_naive, MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM gold),
    r AS (SELECT * FROM l WHERE back < 30),
    u AS (SELECT series_id, 'persistence' AS model, y, persistence AS yhat FROM r
      UNION ALL SELECT series_id, 'seasonal_naive', y, seasonal_naive FROM r)
    SELECT series_id, model, COUNT(*) AS n_points, ROUND(AVG(ABS(yhat - y)), 9) AS mae,
      ROUND(AVG(ABS(yhat - y) / GREATEST(ABS(y), 2.220446049250313e-16)) * 100, 7) AS mape_pct
    FROM u WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2""",
)
def one_step_baselines(spark, sf):
    """Naive forecasts of the holdout, one day ahead."""
    from dayloom.operators.backtest import score

    wide = FC.one_step_baselines(B.panel(spark, sf))
    models = ["persistence", "seasonal_naive"]
    entries = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("yhat")) for m in models])
    long = wide.select("series_id", "ds", "y", F.explode(entries).alias("_e")).select(
        "series_id", "ds", "y", "_e.*"
    )
    return B.rounded(
        score(long).select("series_id", "model", "n_points", "mae", "mape_pct"), 9, mape_pct=7
    )


# With ``working`` the outlook covers working days only, so that the fallbacks show on weekends.
def future_sql(working: bool) -> str:
    days = "WHERE isodow(ds) <= 5" if working else ""
    return f"""{B.GOLD},
    ends AS (SELECT series_id, MAX(ds) AS last_ds, AVG(temp) AS mean_temp, arg_max(snow, ds) AS last_snow,
      arg_max(temp, ds) AS last_temp, arg_max(precip, ds) AS last_precip FROM gold GROUP BY 1),
    outlook AS (SELECT * FROM weather {days}),
    f0 AS (SELECT e.series_id, CAST(e.last_ds + s.h AS DATE) AS ds, s.h, COALESCE(w.temp, e.mean_temp) AS temp,
      COALESCE(w.precip, 0) AS precip, COALESCE(w.snow, 0) AS snow, e.last_snow, e.last_temp, e.last_precip
      FROM ends e CROSS JOIN {STEPS} s LEFT JOIN outlook w ON w.ds = e.last_ds + s.h),
    fut AS (SELECT series_id, ds, h, temp, precip, snow, {B.holiday_sql('ds')} AS is_holiday,
      COALESCE(LAG(snow) {B.W}, last_snow) AS snow_lag1, COALESCE(LAG(temp) {B.W}, last_temp) AS temp_lag1,
      COALESCE(LAG(precip) {B.W}, last_precip) AS precip_lag1 FROM f0)"""


FUTURE = future_sql(working=False)


@entry(
    "future_covariates",
    f"""WITH {future_sql(working=True)} SELECT series_id, ds, h, ROUND(temp, 9) AS temp, precip, snow, is_holiday, snow_lag1,
      ROUND(temp_lag1, 9) AS temp_lag1, precip_lag1 FROM fut""",
)
def future_covariates(spark, sf):
    """Covariates of the next 14 days with fallbacks and chained lags (TS10, J5, J6, J7, S17, T11, T12)."""
    out = FC.future_covariates(B.panel(spark, sf), B.weather(spark, sf).where(F.weekday("ds") < 5))
    return out.withColumn("temp", F.round("temp", 9)).withColumn("temp_lag1", F.round("temp_lag1", 9))


SERVED = f"""{FUTURE},
    hist AS (SELECT g.series_id, e.last_ds AS origin, list(g.y / 1e6 ORDER BY g.ds) AS path
      FROM gold g JOIN ends e ON e.series_id = g.series_id AND g.ds > e.last_ds - 14 GROUP BY 1, 2),
    rec AS (SELECT series_id, origin, 0 AS h, path FROM hist
      UNION ALL
      SELECT r.series_id, r.origin, r.h + 1, list_append(r.path, {_lagged('r.path')} {_cov('f')})
      FROM rec r JOIN fut f ON f.series_id = r.series_id AND f.h = r.h + 1 WHERE r.h < 14),
    served AS (SELECT series_id, origin, h, CAST(origin + h AS DATE) AS ds, path[len(path)] AS linear,
      path[CASE WHEN h <= 7 THEN 7 + h ELSE h END] AS seasonal_naive FROM rec WHERE h > 0)"""


def served(spark, sf, panel):
    """Next two weeks: fixed linear model, seasonal naive, equal-weight blend."""
    cases = FC.serving_cases(panel, FC.future_covariates(panel, B.weather(spark, sf)), list(S.EXOG))
    coef = F.array(*[F.lit(c) for c in FIXED_COEF])
    path = L.recurse_linear(F.col("hist"), F.col("future"), coef, list(S.LAGS), list(S.EXOG))
    cases = cases.withColumn("linear", path).withColumn("seasonal_naive", FC.seasonal_naive(F.col("hist")))
    cases = cases.withColumn("ensemble", FC.blend_arrays(F.col("linear"), F.col("seasonal_naive")))
    return FC.to_wide(cases, ["linear", "seasonal_naive", "ensemble"]).drop("y")


@entry(
    "served_forecast",
    f"""WITH RECURSIVE {SERVED} SELECT series_id, origin, h, ds, ROUND(linear, 9) AS linear,
      ROUND(seasonal_naive, 9) AS seasonal_naive, ROUND(0.5 * linear + 0.5 * seasonal_naive, 9) AS ensemble FROM served""",
)
def served_forecast(spark, sf):
    """Forecast table after the last actual day."""
    return B.rounded(served(spark, sf, B.gold(spark, sf)))


@entry(
    "forecast_interval",
    f"""WITH RECURSIVE {LINEAR}, sp AS (SELECT series_id, h, STDDEV_SAMP(linear - y) AS sigma FROM wide GROUP BY 1, 2)
    SELECT w.series_id, w.origin, w.h, ROUND(w.linear, 9) AS linear,
      ROUND(w.linear - 1.959963984540054 * sp.sigma, 9) + 0.0 AS ci_lower, ROUND(w.linear + 1.959963984540054 * sp.sigma, 9) AS ci_upper
    FROM wide w JOIN sp ON sp.series_id = w.series_id AND sp.h = w.h""",
)
def forecast_interval(spark, sf):
    """Interval from the backtest's error deviation at the same step."""
    from dayloom.operators.backtest import mae_by_step

    cases = fixed_cases(B.gold(spark, sf))
    spread = mae_by_step(FC.to_long(cases, ["linear"])).select("series_id", "h", "sigma")
    rows = FC.to_wide(cases, ["linear"]).select("series_id", "origin", "h", "linear")
    return B.rounded(FC.with_interval(rows, spread, "linear", ["series_id"]))


@entry(
    "forecast_chart",
    f"""WITH RECURSIVE {SERVED}, rec90 AS (SELECT g.series_id, g.ds, g.y / 1e6 AS v FROM gold g
      JOIN ends e ON e.series_id = g.series_id WHERE e.last_ds - g.ds < 90),
    anchor AS (SELECT r.* FROM rec90 r JOIN ends e ON e.series_id = r.series_id AND e.last_ds = r.ds),
    l AS (SELECT series_id, ds, 'actual' AS line, v AS value FROM rec90
      UNION ALL SELECT series_id, ds, 'linear', v FROM anchor UNION ALL SELECT series_id, ds, 'ensemble', v FROM anchor
      UNION ALL SELECT series_id, ds, 'linear', linear FROM served
      UNION ALL SELECT series_id, ds, 'ensemble', 0.5 * linear + 0.5 * seasonal_naive FROM served)
    SELECT series_id, ds, line, ROUND(value, 10) AS value FROM l""",
)
def forecast_chart(spark, sf):
    """Last 90 actuals and the forecasts anchored on the last one."""
    panel = B.gold(spark, sf)
    out = R.forecast_chart(panel, served(spark, sf, panel), ["linear", "ensemble"], unit=S.UNIT_SCALE)
    return out.withColumn("value", F.round("value", 10))


@entry(
    "forward_total",
    f"""WITH RECURSIVE {SERVED} SELECT series_id, ROUND(SUM(0.5 * linear + 0.5 * seasonal_naive), 9) AS total,
      MIN(ds) AS from_ds, MAX(ds) AS to_ds FROM served WHERE h > 7 GROUP BY 1""",
)
def forward_total(spark, sf):
    """Total of the last seven forecast days with its range."""
    return B.rounded(R.forward_total(served(spark, sf, B.gold(spark, sf)), "ensemble"))


# --- fitted models ---


def _simple_rows(spark, sf):
    return feature_table(B.panel(spark, sf)).withColumn("target", F.col("y") / S.UNIT_SCALE)


@entry(
    "linear_fit",
    f"""WITH {B.FEATURES}, t AS (SELECT series_id, y / 1e6 AS v, y_lag7 AS x FROM features),
    g AS (SELECT series_id, COUNT(*) AS n, REGR_SLOPE(v, x) AS b, REGR_INTERCEPT(v, x) AS a,
      REGR_SYY(v, x) AS syy, REGR_SXX(v, x) AS sxx, REGR_SXY(v, x) AS sxy FROM t GROUP BY 1),
    r AS (SELECT *, syy - sxy * sxy / sxx AS rss FROM g)
    SELECT series_id, n AS n_rows, ROUND(a, 8) AS intercept, ROUND(b, 8) + 0.0 AS slope,
      ROUND(SQRT(rss / (n - 2) / sxx), 8) AS slope_err, ROUND(rss, 6) AS rss, ROUND(n * LN(rss / n) + 4, 4) AS aic FROM r""",
)
def linear_fit(spark, sf):
    """Least squares per series from cross products, checked on one regressor (M4)."""
    fit = L.fit_linear(_simple_rows(spark, sf), ["y_lag7"], "target")
    out = fit.select(
        "series_id", "n_rows", F.col("coef")[0].alias("intercept"), F.col("coef")[1].alias("slope"),
        F.col("std_err")[1].alias("slope_err"), "rss", "aic",
    )
    return B.rounded(out, 8, rss=6, aic=4)


# Least squares in SQL: scaled covariates, normal equations, Gauss–Jordan elimination on
# [X'X | X'y | I]. fit(series_id, n, yy, m): m[i][11] is a coefficient, m[i][11 + i] the
# inverse's diagonal.
_SCALED = ", ".join(
    f"(g.{c} - b.{c}0) / CASE WHEN b.{c}1 > b.{c}0 THEN b.{c}1 - b.{c}0 ELSE 1 END AS {c}" for c in S.EXOG
)
_BOUNDS = ", ".join(f"MIN({c}) AS {c}0, MAX({c}) AS {c}1" for c in S.EXOG)
_VECTOR = "[1.0::DOUBLE, " + ", ".join(f"LAG(v, {k}) {B.W}" for k in S.LAGS) + ", temp, precip, snow_lag1, is_holiday]"

FIT = f"""{BASE},
    bk AS (SELECT *, MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM gold),
    bd AS (SELECT series_id, {_BOUNDS} FROM bk WHERE back >= 90 GROUP BY 1),
    sc AS (SELECT g.series_id, g.ds, g.back, g.y / 1e6 AS v, {_SCALED} FROM bk g JOIN bd b ON b.series_id = g.series_id),
    vec AS (SELECT series_id, back, v, LAG(v, 14) {B.W} AS deepest, {_VECTOR} AS f FROM sc),
    obs AS (SELECT series_id, v, f FROM vec WHERE back >= 90 AND deepest IS NOT NULL),
    ix AS (SELECT CAST(UNNEST(range(1, 11)) AS INTEGER) AS i),
    gram AS (SELECT o.series_id, a.i, b.i AS j, SUM(o.f[a.i] * o.f[b.i]) AS s FROM obs o CROSS JOIN ix a CROSS JOIN ix b GROUP BY 1, 2, 3),
    rhs AS (SELECT o.series_id, a.i, SUM(o.f[a.i] * o.v) AS s FROM obs o CROSS JOIN ix a GROUP BY 1, 2),
    tot AS (SELECT series_id, COUNT(*) AS n, SUM(v * v) AS yy FROM obs GROUP BY 1),
    lines AS (SELECT g.series_id, g.i, list_concat(list(g.s ORDER BY g.j), [ANY_VALUE(r.s)],
        list_transform(range(1, 11), lambda c: CASE WHEN c = g.i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS line
      FROM gram g JOIN rhs r ON r.series_id = g.series_id AND r.i = g.i GROUP BY 1, 2),
    gj AS (SELECT series_id, 1 AS k, list(line ORDER BY i) AS m FROM lines GROUP BY 1
      UNION ALL
      SELECT series_id, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
        ELSE list_transform(r, lambda x, c: x - r[k] * m[k][c] / m[k][k]) END) FROM gj WHERE k <= 10),
    fit AS (SELECT g.series_id, t.n, t.yy, g.m FROM gj g JOIN tot t ON t.series_id = g.series_id WHERE g.k = 11),
    rs AS (SELECT r.series_id, SUM(r.s * f.m[r.i][11]) AS explained FROM rhs r JOIN fit f ON f.series_id = r.series_id GROUP BY 1)"""

_FITTED = "f.m[1][11]" + "".join(
    f" + f.m[{i}][11] * r.path[len(r.path) - {k} + 1]" for i, k in enumerate(S.LAGS, start=2)
) + "".join(f" + f.m[{i}][11] * s.{c}" for i, c in enumerate(S.EXOG, start=7))


# The rolling origins with the fitted model's recursive path.
FITTED = f"""{FIT},
    hist AS (SELECT o.series_id, o.origin, list(g.y / 1e6 ORDER BY g.ds) AS path
      FROM o JOIN gold g ON g.series_id = o.series_id AND g.ds BETWEEN o.origin - 13 AND o.origin GROUP BY 1, 2),
    rec AS (SELECT series_id, origin, 0 AS h, path FROM hist
      UNION ALL
      SELECT r.series_id, r.origin, r.h + 1, list_append(r.path, {_FITTED})
      FROM rec r JOIN fit f ON f.series_id = r.series_id
        JOIN sc s ON s.series_id = r.series_id AND s.ds = r.origin + r.h + 1 WHERE r.h < 14),
    wide AS (SELECT b.series_id, b.origin, b.h, b.ds, r.path[len(r.path)] AS linear, b.seasonal_naive, b.persistence, b.y
      FROM base b JOIN rec r ON r.series_id = b.series_id AND r.origin = b.origin AND r.h = b.h)"""


# Every non-empty lag set with the covariates: a system of its own columns of the same matrices.
# order_fit(series_id, keep, m, rss, aic): m[i] ends in the i-th coefficient of the columns in keep.
_SETS = ", ".join(
    str(([1, *[2 + sorted(S.LAGS).index(k) for k in c], 7, 8, 9, 10], ",".join(map(str, c)))) for c in L.lag_subsets()
)

SEARCH = f"""{FIT},
    mats AS (SELECT g.series_id, list(g.line ORDER BY g.i) AS m FROM lines g GROUP BY 1),
    sets(keep, lags) AS (VALUES {_SETS}),
    sys0 AS (SELECT a.series_id, s.lags, s.keep,
      list_transform(s.keep, lambda i: list_append(list_transform(s.keep, lambda j: a.m[i][j]), a.m[i][11])) AS m
      FROM mats a CROSS JOIN sets s),
    sys AS (SELECT series_id, lags, keep, m AS m0, 1 AS k, m FROM sys0
      UNION ALL
      SELECT series_id, lags, keep, m0, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
        THEN list_transform(r, lambda x: x / m[k][k])
        ELSE list_transform(r, lambda x, c: x - r[k] * m[k][c] / m[k][k]) END) FROM sys WHERE k <= len(m)),
    solved AS (SELECT y.series_id, y.lags, y.keep, y.m, t.n, len(y.keep) AS p,
      t.yy - list_sum(list_transform(range(1, len(y.keep) + 1), lambda i: y.m[i][len(y.keep) + 1] * y.m0[i][len(y.keep) + 1])) AS rss
      FROM sys y JOIN tot t ON t.series_id = y.series_id WHERE y.k = len(y.m) + 1),
    scored AS (SELECT *, n * LN(rss / n) + 2 * p AS aic FROM solved),
    best AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY aic) = 1)"""


def _joined(lags):
    return F.array_join(lags.cast("array<string>"), ",").alias("lags")


@entry(
    "lag_search",
    f"""WITH RECURSIVE {SEARCH} SELECT b.series_id, b.lags, ROUND(b.aic, 4) AS aic, ROUND(MAX(s.aic), 4) AS worst_aic,
      COUNT(*) AS n_sets FROM best b JOIN scored s ON s.series_id = b.series_id GROUP BY ALL""",
)
def lag_search(spark, sf):
    """Best of all 31 lag sets by AIC, with the covariates, swept out of one matrix (M5)."""
    rows = training.scaled_training_rows(B.gold(spark, sf), S.EVAL_DAYS).where(F.col("_back") >= S.EVAL_DAYS)
    out = L.choose_lags(rows, None, list(S.EXOG), "target")
    return B.rounded(
        out.select(
            "series_id", _joined(F.col("lags")), "aic", F.array_max("scores").alias("worst_aic"),
            F.size("scores").cast("long").alias("n_sets"),
        ), 4,
    )


# Orders found 30, 60, … days before the newest day, as an earlier run left them.
CACHED = """cache AS (SELECT f.series_id, CAST(n.today - 30 * CAST(substr(f.series_id, 1, 1) AS INTEGER) AS DATE) AS w, n.today
      FROM (SELECT DISTINCT series_id FROM facts) f, (SELECT MAX(ds) AS today FROM facts) n)"""


def _cached_orders(panel, today):
    age = F.substring("series_id", 1, 1).cast("int") * 30
    return panel.select("series_id").distinct().select(
        "series_id", F.array(F.lit(1), F.lit(7)).alias("lags"), F.date_sub(today, age).alias("search_date")
    )


@entry(
    "resolved_order",
    f"""WITH RECURSIVE {SEARCH}, {CACHED}
    SELECT series_id, CASE WHEN today - w < 90 THEN '1,7' ELSE best.lags END AS lags,
      CASE WHEN today - w < 90 THEN 'cached' ELSE 'searched' END AS source,
      CASE WHEN today - w < 90 THEN w ELSE today END AS search_date FROM cache JOIN best USING (series_id)""",
)
def resolved_order(spark, sf):
    """Cached lag set while younger than 90 days, else the search's (M6)."""
    panel = B.gold(spark, sf)
    today = panel.agg(F.max("ds").alias("m")).scalar()
    fit = training.fit_ordered_models(panel, _cached_orders(panel, today), today)
    return fit.select("series_id", _joined(F.col("lags")), "source", "search_date")


@entry(
    "ordered_fit",
    f"""WITH RECURSIVE {SEARCH}, {CACHED},
    won AS (SELECT s.* FROM scored s JOIN cache c ON c.series_id = s.series_id JOIN best b ON b.series_id = s.series_id
      WHERE s.lags = CASE WHEN c.today - c.w < 90 THEN '1,7' ELSE b.lags END),
    cols AS (SELECT series_id, lags, n, rss, aic, keep, m, UNNEST(range(1, 11)) AS i FROM won)
    SELECT series_id, lags, n AS n_rows, ROUND(rss, 6) AS rss, ROUND(aic, 4) AS aic,
      ['constant', 'y_lag1', 'y_lag2', 'y_lag3', 'y_lag7', 'y_lag14', 'temp', 'precip', 'snow_lag1', 'is_holiday'][i] AS feature,
      COALESCE(ROUND(m[list_position(keep, i)][len(keep) + 1], 7), 0) + 0.0 AS coefficient FROM cols""",
)
def ordered_fit(spark, sf):
    """Search through the cache into the fit: every series on its own lags (M4, M5, M6)."""
    panel = B.gold(spark, sf)
    today = panel.agg(F.max("ds").alias("m")).scalar()
    fit = training.fit_ordered_models(panel, _cached_orders(panel, today), today)
    names = ["constant", *[FT.lag_name(k) for k in sorted(S.LAGS)], *S.EXOG]
    values = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("coef").alias("coefficient"))
    out = fit.select("series_id", _joined(F.col("lags")), "n_rows", "rss", "aic", F.explode(values).alias("_c"))
    return B.rounded(
        out.select("series_id", "lags", "n_rows", "rss", "aic", "_c.feature", "_c.coefficient"), 7, rss=6, aic=4
    )


# The production fit: all days, nothing held back.
FIT_ALL = FIT.replace("back >= 90", "back >= 0")

# Two-sided normal tail by Simpson's rule.
_TAIL = """1 - 2 / SQRT(2 * PI()) * z / 6000 * list_sum(list_transform(range(0, 2001), lambda k:
      CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * EXP(-(z * k / 2000) * (z * k / 2000) / 2)))"""


@entry(
    "linear_coefficients",
    f"""WITH RECURSIVE {FIT_ALL}, e AS (SELECT f.series_id, x.i, f.m[x.i][11] AS b,
      SQRT(f.m[x.i][11 + x.i] * (f.yy - rs.explained) / (f.n - 10)) AS se
      FROM fit f JOIN rs ON rs.series_id = f.series_id, ix x WHERE x.i > 6),
    t AS (SELECT *, ABS(b / se) AS z FROM e)
    SELECT series_id, ['temp', 'precip', 'snow_lag1', 'is_holiday'][i - 6] AS feature, ROUND(b, 7) + 0.0 AS coefficient,
      ROUND(se, 7) AS std_err, ROUND({_TAIL}, 6) + 0.0 AS p_value, CASE WHEN z > 1.959963984540054 THEN 1 ELSE 0 END AS is_significant,
      CASE WHEN b >= 0 THEN 'raises' ELSE 'lowers' END AS direction FROM t""",
)
def linear_coefficients(spark, sf):
    """Covariate effects of the fit on all days, with p-values, per series."""
    fit = training.fit_linear_models(B.gold(spark, sf), held_back=0)
    names = [FT.lag_name(k) for k in S.LAGS] + list(S.EXOG)
    table = L.coefficient_table(fit, names).where(F.col("feature").isin(list(S.EXOG)))
    return B.rounded(table, 7, p_value=6)


@entry(
    "linear_backtest",
    f"""WITH RECURSIVE {FITTED} SELECT series_id, origin, h, ds, ROUND(linear, 7) AS linear, ROUND(seasonal_naive, 12) AS seasonal_naive,
      ROUND(persistence, 12) AS persistence, ROUND(y, 12) AS y FROM wide""",
)
def linear_backtest(spark, sf):
    """Linear model fitted per series before the window, on the rolling origins."""
    cases = training.linear_backtest(B.gold(spark, sf))
    return B.rounded(FC.to_wide(cases, ["linear", "seasonal_naive", "persistence"]), 12, linear=7)


@entry("holdout_predictions")
def holdout_predictions(spark, sf):
    """Both families' recursive forecasts of the last 30 days."""
    paths = training.holdout_paths(B.gold(spark, sf))
    return B.rounded(FC.to_long(paths, ["linear", "trees"]))


@entry("tree_backtest")
def tree_backtest(spark, sf):
    """Both families and the ensemble on the rolling origins."""
    cases = training.full_backtest(B.gold(spark, sf))
    return B.rounded(FC.to_wide(cases, ["linear", "trees", "ensemble", "seasonal_naive", "persistence"]))


@entry("tree_cv_scores")
def tree_cv_scores(spark, sf):
    """Boosted trees on five expanding folds, stopped early on each."""
    rows = stage(feature_table(B.panel(spark, sf)), "features")
    return B.rounded(T.cross_validate_trees(rows))


@entry("tree_importance")
def tree_importance(spark, sf):
    """Permutation importance on the last 30 days."""
    rows = stage(feature_table(B.panel(spark, sf)), "features").withColumn("_back", FT.days_from_end())
    model = T.fit_trees(rows.where("_back >= 30"), stop_days=S.HOLDOUT_DAYS)
    return B.rounded(T.permutation_importance(model, rows.where("_back < 30")))


@entry(
    "tree_blend_identity",
    f"""WITH RECURSIVE {FITTED} SELECT series_id, origin, h, ds, ROUND(linear, 7) AS linear, ROUND(seasonal_naive, 12) AS seasonal_naive,
      ROUND(persistence, 12) AS persistence, ROUND(y, 12) AS y, TRUE AS blends, TRUE AS in_range FROM wide""",
)
def tree_blend_identity(spark, sf):
    """What SQL can say of the tree backtest: its cases, baselines and linear paths, that the ensemble
    is the mean of both families, and that trees stay within the values they were fitted to (M14, M15, E2)."""
    panel = B.gold(spark, sf)
    rows = FC.to_wide(training.full_backtest(panel), ["linear", "trees", "ensemble", "seasonal_naive", "persistence"])
    seen = panel.groupBy("series_id").agg(
        (F.min("y") / S.UNIT_SCALE).alias("lo"), (F.max("y") / S.UNIT_SCALE).alias("hi")
    )
    blends = F.abs(F.col("ensemble") - (F.col("linear") + F.col("trees")) / 2) < 1e-9
    rows = rows.join(seen, "series_id").withColumns(
        {"blends": blends, "in_range": F.col("trees").between(F.col("lo"), F.col("hi"))}
    )
    return B.rounded(rows.drop("trees", "ensemble", "lo", "hi"), 12, linear=7)


@entry("served_ensemble")
def served_ensemble(spark, sf):
    """Two weeks ahead from both fitted families with interval and lineage."""
    from dayloom.operators.backtest import mae_by_step, score

    panel = B.gold(spark, sf)
    model = training.production_trees(feature_table(panel))
    coef = training.fit_linear_models(panel, held_back=0)
    bounds = FT.scale_bounds(panel, list(S.EXOG), F.lit(True))
    tested = stage(training.full_backtest(panel), "backtest")
    spread = mae_by_step(FC.to_long(tested, ["ensemble"]))
    out = prediction.serve(
        panel, B.weather(spark, sf), coef, bounds, model, spread.select("series_id", "h", "sigma")
    )
    last = panel.agg(F.max("ds").alias("m")).scalar()
    # both families' runs enter the registry with their errors; the gate says which versions serve
    runs = score(FC.to_long(tested, ["linear", "trees"]), keys=[]).select(
        "model", F.lit(1).alias("version"), F.lit("None").alias("stage"), "mae", F.lit("run-1").alias("run_id")
    )
    return B.rounded(prediction.stamp(out, panel, last, prediction.serving_versions(RG.promotion_gate(runs))))
