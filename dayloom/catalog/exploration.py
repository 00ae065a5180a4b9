"""Exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.functions import calendar as C
from dayloom.operators import explore as X
from dayloom.operators import features as FT
from dayloom.operators.panel import rollup_daily

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
NUMERIC = ["y", "temp", "precip", "snow"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@entry(
    "null_counts",
    f"""WITH {B.SILVER}, w AS (SELECT *, LAG(y, 7) {B.W} AS y_lag7 FROM silver) """
    + _union(
        [
            f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n_missing FROM w"
            for c in ["y", "temp", "precip", "snow", "y_lag7"]
        ]
    ),
)
def null_counts(spark, sf):
    """Missing values per column (A4)."""
    df = B.silver(spark, sf).withColumn("y_lag7", F.lag("y", 7).over(FT.by_day()))
    return X.null_counts(df, ["y", "temp", "precip", "snow", "y_lag7"])


@entry(
    "distinct_counts",
    _union(
        [
            f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_distinct, "
            f"CASE WHEN COUNT(DISTINCT {c}) <= 1 THEN 1 ELSE 0 END AS is_constant FROM lineitem"
            for c in LINE_COLUMNS
        ]
    ),
)
def distinct_counts(spark, sf):
    """Distinct values and constant columns of the raw lines (A5)."""
    return X.distinct_counts(B.table(spark, sf, "lineitem"), LINE_COLUMNS)


@entry(
    "top_order_days",
    """SELECT CAST(o_orderdate AS DATE) AS ds, COUNT(*) AS n_rows FROM orders
    GROUP BY 1 ORDER BY n_rows DESC, ds LIMIT 5""",
)
def top_order_days(spark, sf):
    """Most frequent values."""
    return X.top_values(B.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("ds")), "ds")


@entry(
    "describe_by_group",
    """SELECT o_orderpriority AS series_id, COUNT(o_totalprice) AS n, ROUND(AVG(o_totalprice), 4) AS mean,
      ROUND(STDDEV_SAMP(o_totalprice), 4) AS std, MIN(o_totalprice) AS min, MAX(o_totalprice) AS max,
      ROUND(QUANTILE_CONT(o_totalprice, 0.25), 4) AS q25, ROUND(QUANTILE_CONT(o_totalprice, 0.5), 4) AS q50,
      ROUND(QUANTILE_CONT(o_totalprice, 0.75), 4) AS q75 FROM orders GROUP BY 1""",
)
def describe_by_group(spark, sf):
    """Count, mean, deviation, quartiles of raw rows per group."""
    df = B.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("series_id"), "o_totalprice")
    return B.rounded(X.describe_by(df, ["series_id"], "o_totalprice"), 4)


@entry(
    "weekday_means",
    f"""WITH {B.FACTS} SELECT CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, COUNT(*) AS n_rows,
      ROUND(AVG(y), 5) AS y FROM facts GROUP BY 1""",
)
def weekday_means(spark, sf):
    """Mean per weekday."""
    return B.facts(spark, sf).groupBy(C.day_of_week(F.col("ds")).alias("day_of_week")).agg(
        F.count("*").alias("n_rows"), F.round(F.avg("y"), 5).alias("y")
    )


@entry(
    "weekday_group_means",
    f"""WITH {B.FACTS} SELECT CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, series_id,
      ROUND(AVG(y), 5) AS y FROM facts GROUP BY 1, 2""",
)
def weekday_group_means(spark, sf):
    """Mean per weekday and group."""
    return B.facts(spark, sf).groupBy(
        C.day_of_week(F.col("ds")).alias("day_of_week"), "series_id"
    ).agg(F.round(F.avg("y"), 5).alias("y"))


DAILY_TOTAL = f"""WITH {B.SILVER}, t AS (SELECT ds, ROUND(SUM(y), 6) AS y, ROUND(AVG(temp), 6) AS temp,
    ROUND(AVG(precip), 6) AS precip, ROUND(AVG(snow), 6) AS snow FROM silver GROUP BY ds)"""


def _total(spark, sf):
    return rollup_daily(B.silver(spark, sf), [], ["y"], ["temp", "precip", "snow"])


@entry(
    "condition_means",
    f"""{DAILY_TOTAL} SELECT CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END AS is_weekend,
      CASE WHEN precip > 4 THEN 1 ELSE 0 END AS is_wet, CASE WHEN snow > 0 THEN 1 ELSE 0 END AS is_snowy,
      COUNT(*) AS n_days, ROUND(AVG(y), 5) AS y FROM t WHERE precip IS NOT NULL GROUP BY 1, 2, 3""",
)
def condition_means(spark, sf):
    """Mean of daily totals by weekend, rain and snow (A10, P20)."""
    t = _total(spark, sf).where(F.col("precip").isNotNull())
    return t.groupBy(
        C.is_weekend(F.col("ds")).alias("is_weekend"),
        (F.col("precip") > 4).cast("int").alias("is_wet"),
        (F.col("snow") > 0).cast("int").alias("is_snowy"),
    ).agg(F.count("*").alias("n_days"), F.round(F.avg("y"), 5).alias("y"))


@entry(
    "condition_day_counts",
    f"""{DAILY_TOTAL} SELECT COUNT(*) FILTER (WHERE precip > 4) AS wet_days,
      COUNT(*) FILTER (WHERE snow > 0) AS snow_days, COUNT(*) AS n_days FROM t""",
)
def condition_day_counts(spark, sf):
    """Days on which a condition holds."""
    return _total(spark, sf).agg(
        F.count_if(F.col("precip") > 4).alias("wet_days"),
        F.count_if(F.col("snow") > 0).alias("snow_days"),
        F.count("*").alias("n_days"),
    )


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]]


@entry(
    "correlation_matrix",
    f"WITH {B.GOLD} "
    + _union(
        [
            f"SELECT series_id, '{a}' AS left_column, '{b}' AS right_column, "
            f"ROUND(CORR({a}, {b}), 9) + 0.0 AS r FROM gold GROUP BY 1"
            for a, b in _PAIRS
        ]
    ),
)
def correlation_matrix(spark, sf):
    """All pairs of columns."""
    return B.rounded(X.correlation_matrix(B.panel(spark, sf), NUMERIC, ["series_id"]))


@entry(
    "target_correlation",
    f"WITH {B.FEATURES} "
    + _union(
        [
            f"SELECT '{c}' AS \"column\", ROUND(CORR({c}, y), 9) + 0.0 AS r FROM features"
            for c in ["y_lag1", "y_lag7", "y_mean14", "temp", "precip", "snow_lag1"]
        ]
    ),
)
def target_correlation(spark, sf):
    """Every candidate against the target, strongest last."""
    from dayloom.plans.gold import feature_table

    df = feature_table(B.panel(spark, sf))
    out = X.target_correlation(df, "y", ["y_lag1", "y_lag7", "y_mean14", "temp", "precip", "snow_lag1"])
    return B.rounded(out).orderBy("r")


@entry(
    "trend_line",
    f"""WITH {B.GOLD}, f AS (SELECT series_id, REGR_SLOPE(y / 1e6, temp) AS slope,
      REGR_INTERCEPT(y / 1e6, temp) AS intercept, CORR(temp, y / 1e6) AS r, MIN(temp) AS lo, MAX(temp) AS hi
      FROM gold WHERE temp IS NOT NULL AND y IS NOT NULL GROUP BY 1),
    p AS (SELECT *, UNNEST(range(0, 100)) AS point FROM f)
    SELECT series_id, CAST(point AS INTEGER) AS point, ROUND(slope, 9) + 0.0 AS slope, ROUND(intercept, 9) AS intercept,
      ROUND(r, 9) + 0.0 AS r, ROUND(lo + (hi - lo) * (point / 99.0::DOUBLE), 8) AS x,
      ROUND(intercept + slope * (lo + (hi - lo) * (point / 99.0::DOUBLE)), 8) AS line FROM p""",
)
def trend_line(spark, sf):
    """Straight-line fit, Pearson r and 100 points of the line."""
    df = B.panel(spark, sf).na.drop(subset=["temp", "y"]).withColumn("y", F.col("y") / 1_000_000)
    return B.rounded(X.trend_line(df, "temp", "y"), 9, x=8, line=8)


@entry(
    "weekday_boxplot",
    f"""WITH {B.GOLD}, q AS (SELECT series_id, CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, MIN(y) AS low,
      QUANTILE_CONT(y, 0.25) AS q1, QUANTILE_CONT(y, 0.5) AS median, QUANTILE_CONT(y, 0.75) AS q3, MAX(y) AS high
      FROM gold GROUP BY 1, 2)
    SELECT series_id, day_of_week, ROUND(low, 5) AS low, ROUND(q1, 5) AS q1, ROUND(median, 5) AS median,
      ROUND(q3, 5) AS q3, ROUND(high, 5) AS high, ROUND(q1 - 1.5 * (q3 - q1), 5) AS lower_fence,
      ROUND(q3 + 1.5 * (q3 - q1), 5) AS upper_fence FROM q""",
)
def weekday_boxplot(spark, sf):
    """Five numbers and fences per weekday."""
    df = B.panel(spark, sf).withColumn("day_of_week", C.day_of_week(F.col("ds")))
    return B.rounded(X.boxplot(df, ["series_id", "day_of_week"]), 5)


DECOMPOSED = f"""WITH {B.GOLD},
    d AS (SELECT *, {B.trailing_sql('AVG', 'y', -3, 3)} AS trend,
      (ds - MIN(ds) OVER (PARTITION BY series_id)) % 7 AS phase FROM gold),
    m AS (SELECT series_id, phase, AVG(y - trend) AS pm FROM d GROUP BY 1, 2),
    s AS (SELECT series_id, phase, pm - AVG(pm) OVER (PARTITION BY series_id) AS seasonal FROM m),
    dec AS (SELECT d.series_id, d.ds, d.y, d.snow, d.precip, d.trend, s.seasonal, d.y - d.trend - s.seasonal AS resid
      FROM d JOIN s ON s.series_id = d.series_id AND s.phase = d.phase)"""


@entry(
    "seasonal_decomposition",
    f"""{DECOMPOSED} SELECT series_id, ds, ROUND(trend, 5) AS trend, ROUND(seasonal, 5) + 0.0 AS seasonal,
      ROUND(resid, 5) + 0.0 AS resid FROM dec""",
)
def seasonal_decomposition(spark, sf):
    """Trend, weekly season, residual (TS6)."""
    out = X.decompose(B.panel(spark, sf)).select("series_id", "ds", "trend", "seasonal", "resid")
    return B.rounded(out, 5)


@entry(
    "smallest_residuals",
    f"""{DECOMPOSED} SELECT series_id, ds, ROUND(resid, 5) + 0.0 AS resid FROM dec
    WHERE resid IS NOT NULL ORDER BY dec.resid, series_id, ds LIMIT 10""",
)
def smallest_residuals(spark, sf):
    """The ten days furthest below expectation (O3)."""
    out = X.decompose(B.panel(spark, sf)).select("series_id", "ds", "resid")
    return B.rounded(X.smallest(out, "resid", ["series_id", "ds"]), 5)


@entry(
    "residual_covariate_correlation",
    f"""{DECOMPOSED}, l AS (SELECT *, LAG(snow) {B.W} AS snow_before FROM dec)
    SELECT series_id, ROUND(CORR(snow, resid), 8) + 0.0 AS r_same_day, ROUND(CORR(snow_before, resid), 8) + 0.0 AS r_day_before
    FROM l WHERE resid IS NOT NULL GROUP BY 1""",
)
def residual_covariate_correlation(spark, sf):
    """Residuals against today's and yesterday's snow (TS11, J11)."""
    df = X.decompose(B.panel(spark, sf)).withColumn("snow_before", F.lag("snow", 1).over(FT.by_day()))
    out = df.where(F.col("resid").isNotNull()).groupBy("series_id").agg(
        F.corr("snow", "resid").alias("r_same_day"), F.corr("snow_before", "resid").alias("r_day_before")
    )
    return B.rounded(out, 8)


@entry(
    "deviation_by_condition",
    f"""WITH {B.GOLD}, d AS (SELECT *, y - {B.trailing_sql('AVG', 'y', -7, -1)} AS dev FROM gold)
    SELECT series_id, CASE WHEN precip > 4.5 THEN 1 ELSE 0 END AS is_wet, CASE WHEN snow > 0 THEN 1 ELSE 0 END AS is_snowy,
      COUNT(dev) AS n_days, ROUND(AVG(dev), 4) + 0.0 AS deviation FROM d GROUP BY 1, 2, 3""",
)
def deviation_by_condition(spark, sf):
    """Mean deviation from the week before on wet and snowy days."""
    df = B.panel(spark, sf).withColumn("dev", FT.deviation_from_week("y"))
    out = df.groupBy(
        "series_id",
        (F.col("precip") > 4.5).cast("int").alias("is_wet"),
        (F.col("snow") > 0).cast("int").alias("is_snowy"),
    ).agg(F.count("dev").alias("n_days"), F.avg("dev").alias("deviation"))
    return B.rounded(out, 4)


ACF = f"""{B.GOLD},
    dv AS (SELECT series_id, ds, y - AVG(y) OVER (PARTITION BY series_id) AS d FROM gold),
    lags AS (SELECT UNNEST(range(1, 61)) AS lag),
    num AS (SELECT a.series_id, l.lag, SUM(a.d * b.d) AS s FROM dv a CROSS JOIN lags l
      JOIN dv b ON b.series_id = a.series_id AND b.ds = CAST(a.ds + CAST(l.lag AS INTEGER) AS DATE) GROUP BY 1, 2),
    den AS (SELECT series_id, SUM(d * d) AS ss FROM dv GROUP BY 1),
    acf AS (SELECT n.series_id, n.lag, n.s / e.ss AS acf FROM num n JOIN den e ON e.series_id = n.series_id)"""


@entry(
    "autocorrelation",
    f"WITH {ACF} SELECT series_id, CAST(lag AS INTEGER) AS lag, ROUND(acf, 9) + 0.0 AS acf FROM acf",
)
def autocorrelation(spark, sf):
    """Lags 1 to 60 (TS7)."""
    return B.rounded(X.autocorrelation(B.panel(spark, sf), 60))


@entry(
    "partial_autocorrelation",
    f"""WITH RECURSIVE {ACF},
    r AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM acf WHERE lag <= 30 GROUP BY 1),
    dl AS (
      SELECT series_id, 1 AS k, [r[1]] AS phi, r FROM r
      UNION ALL
      SELECT series_id, k + 1,
        list_append(list_transform(range(1, k + 1), lambda j: phi[j] - last * phi[k + 1 - j]), last), r
      FROM (SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j])))
          / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j]))) AS last
        FROM dl WHERE k < 30))
    SELECT series_id, k AS lag, ROUND(phi[k], 8) + 0.0 AS pacf FROM dl""",
)
def partial_autocorrelation(spark, sf):
    """Yule–Walker partial autocorrelation to lag 30 (TS8)."""
    return B.rounded(X.partial_autocorrelation(B.panel(spark, sf), 30), 8)


@entry(
    "unit_root_test",
    f"""WITH {B.GOLD},
    d AS (SELECT series_id, ds, y AS lv, y - LAG(y) {B.W} AS df, LAG(y) {B.W} AS level FROM gold),
    x AS (SELECT *, LAG(df) {B.W} AS dl FROM d),
    u AS (SELECT series_id, df, level, dl FROM x WHERE df IS NOT NULL AND level IS NOT NULL AND dl IS NOT NULL),
    a AS (SELECT series_id, REGR_SLOPE(df, dl) AS b1, REGR_INTERCEPT(df, dl) AS a1,
      REGR_SLOPE(level, dl) AS b2, REGR_INTERCEPT(level, dl) AS a2 FROM u GROUP BY 1),
    e AS (SELECT u.series_id, df - a1 - b1 * dl AS e1, level - a2 - b2 * dl AS e2
      FROM u JOIN a ON a.series_id = u.series_id),
    g AS (SELECT series_id, SUM(e1 * e2) / SUM(e2 * e2) AS b, SUM(e2 * e2) AS see, SUM(e1 * e1) AS syy,
      COUNT(*) AS n FROM e GROUP BY 1)
    SELECT series_id, ROUND(b / SQRT((syy - b * b * see) / (n - 3) / see), 6) AS adf, CAST(-2.86 AS DOUBLE) AS critical_5pct,
      CASE WHEN b / SQRT((syy - b * b * see) / (n - 3) / see) <= -2.86 THEN 1 ELSE 0 END AS is_stationary,
      n AS n_rows FROM g""",
)
def unit_root_test(spark, sf):
    """Augmented Dickey–Fuller statistic with one lagged difference (TS9)."""
    return B.rounded(X.unit_root_test(B.panel(spark, sf), 1), 6)
