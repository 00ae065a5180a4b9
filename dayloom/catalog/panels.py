"""Panel, feature, split and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.functions import calendar as C
from dayloom.operators import features as FT
from dayloom.operators import panel as P
from dayloom.operators.explore import most_common
from dayloom.operators.linear import fold_scores
from dayloom.plans.gold import feature_table
from dayloom.session import stage

FEATURE_OUT = [
    "series_id", "ds", "y", "temp", "precip", "snow", "is_holiday", "snow_lag1", "day_of_week",
    "month", "is_weekend", "y_lag1", "y_lag2", "y_lag3", "y_lag7", "y_lag14", "y_mean14", "y_std7",
    "precip_lag1", "temp_lag1",
]


# Everything but the two rolling statistics is computed by the same operations on both
# engines; those two depend on the order of summation and are rounded.
ROLLING = ("y_mean14", "y_std7")
FEATURE_SQL = ", ".join(f"ROUND({c}, 10) AS {c}" if c in ROLLING else c for c in FEATURE_OUT)


@entry("daily_features", f"WITH {B.FEATURES} SELECT {FEATURE_SQL} FROM features")
def daily_features(spark, sf):
    """Raw facts to the training table: A1, J1, J8, TS1, TS2, TS4, TS5, W1–W4, P6, P7, P9, S3."""
    df = feature_table(B.panel(spark, sf))
    return df.select(*[F.round(c, 10).alias(c) if c in ROLLING else F.col(c) for c in FEATURE_OUT])


@entry(
    "daily_rollup",
    f"""WITH {B.SILVER} SELECT ds, ROUND(SUM(y), 6) AS y, ROUND(AVG(temp), 6) AS temp,
    ROUND(AVG(precip), 6) AS precip, ROUND(AVG(snow), 6) AS snow FROM silver GROUP BY ds""",
)
def daily_rollup(spark, sf):
    """All series to one total per day."""
    return P.rollup_daily(B.silver(spark, sf), [], ["y"], ["temp", "precip", "snow"])


@entry(
    "gap_filled_panel",
    f"""WITH {B.GOLD} SELECT series_id, ds, y, temp, precip, snow, is_holiday, snow_lag1 FROM gold""",
)
def gap_filled_panel(spark, sf):
    """Daily spine, interpolation, zero fill, holiday flag, snow lag (J8, TS1, TS2, P9, J7, W2)."""
    return B.panel(spark, sf).select(
        "series_id", "ds", "y", "temp", "precip", "snow", "is_holiday", "snow_lag1"
    )


@entry(
    "missing_days",
    f"""WITH {B.FACTS}, s AS (SELECT series_id,
      CAST(UNNEST(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS DATE) AS ds
      FROM facts GROUP BY series_id)
    SELECT series_id, ds FROM s EXCEPT SELECT series_id, ds FROM facts""",
)
def missing_days(spark, sf):
    """Days of each series' span without a row (U4, TS3)."""
    return P.missing_days(B.facts(spark, sf), ["series_id"])


@entry(
    "calendar_flags",
    f"""WITH {B.FACTS}, d AS (SELECT DISTINCT ds FROM facts)
    SELECT ds, CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, CAST(month(ds) AS INTEGER) AS month,
      CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END AS is_weekend, dayname(ds) AS day_name,
      CAST(date_trunc('week', ds) AS DATE) AS week_start, {B.holiday_sql('ds')} AS is_holiday FROM d""",
)
def calendar_flags(spark, sf):
    """Weekday, month, weekend, day name, week and holiday of every fact day (TS4, TS5, §2.8)."""
    ds = F.col("ds")
    days = B.facts(spark, sf).select("ds").distinct()
    return days.select(
        "ds",
        C.in_domain(C.day_of_week(ds), 0, 6).alias("day_of_week"),
        C.in_domain(F.month(ds), 1, 12).alias("month"),
        C.is_weekend(ds).alias("is_weekend"),
        F.date_format(ds, "EEEE").alias("day_name"),
        C.week_start(ds).alias("week_start"),
        C.is_federal_holiday(ds).alias("is_holiday"),
    )


@entry(
    "holiday_lookup",
    f"""WITH {B.FACTS}, span AS (SELECT CAST(UNNEST(generate_series((SELECT MIN(ds) FROM facts),
      (SELECT MAX(ds) FROM facts), INTERVAL 1 DAY)) AS DATE) AS ds), cal AS (SELECT ds FROM span WHERE {B.holiday_sql('ds')} = 1)
    SELECT f.series_id, COUNT(*) AS n_days, COUNT(c.ds) AS n_holidays,
      ROUND(SUM(CASE WHEN c.ds IS NOT NULL THEN y ELSE 0 END), 2) AS holiday_total
    FROM facts f LEFT JOIN cal c ON c.ds = f.ds GROUP BY 1""",
)
def holiday_lookup(spark, sf):
    """Facts against a holiday table (J7 with a caller's calendar)."""
    facts = B.facts(spark, sf)
    span = facts.agg(F.min("ds").cast("string"), F.max("ds").cast("string")).first()
    flagged = C.flag_calendar(facts, C.holiday_table(spark, *span), "is_holiday")
    return flagged.groupBy("series_id").agg(
        F.count("*").alias("n_days"),
        F.sum("is_holiday").alias("n_holidays"),
        F.round(F.sum(F.when(F.col("is_holiday") == 1, F.col("y")).otherwise(0.0)), 2).alias("holiday_total"),
    )


@entry(
    "hierarchy_rollup",
    """WITH f AS (
      SELECT r_name AS region, n_name AS nation, CAST(o_orderdate AS DATE) AS ds,
        CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS y
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)
    SELECT region, nation, CASE WHEN nation IS NOT NULL THEN 2 WHEN region IS NOT NULL THEN 1 ELSE 0 END AS level,
      ds, ROUND(SUM(y), 2) AS y
    FROM f GROUP BY GROUPING SETS ((ds), (region, ds), (region, nation, ds))""",
)
def hierarchy_rollup(spark, sf):
    """Total, regions and nations per day (the panel with its totals)."""
    orders = B.table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("ds"), B.hundredths("o_totalprice").alias("c")
    )
    # A customer with very many orders becomes one row per day before the join.
    daily = orders.groupBy("o_custkey", "ds").agg(F.sum("c").alias("c"))
    places = (
        B.table(spark, sf, "nation")
        .join(B.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    )
    who = B.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    facts = (
        daily.join(who, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("region", "nation", "ds")
        .agg((F.sum("c") / 100).alias("y"))
    )
    return P.rollup_hierarchy(facts, ["region", "nation"]).select(
        "region", "nation", "level", "ds", F.round("y", 2).alias("y")
    )


@entry(
    "rollup_with_mode",
    f"""WITH l AS (SELECT CAST(l_shipdate AS DATE) AS ds, l_returnflag AS f, l_quantity AS q, l_tax AS t FROM lineitem),
    c AS (SELECT ds, f, COUNT(*) AS n FROM l GROUP BY 1, 2),
    m AS (SELECT ds, f, ROW_NUMBER() OVER (PARTITION BY ds ORDER BY n DESC, f) AS rn FROM c),
    a AS (SELECT ds, SUM(q) AS y, ROUND(SUM(t), 6) AS precip FROM l GROUP BY 1)
    SELECT a.ds, a.y, a.precip, m.f AS icon FROM a JOIN m ON m.ds = a.ds AND m.rn = 1""",
)
def rollup_with_mode(spark, sf):
    """Daily sums and the most common label, smallest on ties (A2)."""
    rows = B.table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("ds"), F.col("l_returnflag").alias("icon"),
        F.col("l_quantity").alias("q"), F.col("l_tax").alias("t"),
    )
    # Both results come from one (day, label) aggregate of the raw rows.
    small = rows.groupBy("ds", "icon").agg(
        F.sum("q").alias("q"), F.sum("t").alias("t"), F.count("*").alias("n")
    )
    return small.groupBy("ds").agg(
        F.sum("q").alias("y"),
        F.round(F.sum("t"), 6).alias("precip"),
        F.min_by("icon", F.struct(-F.col("n"), F.col("icon"))).alias("icon"),
    )


@entry(
    "common_status_per_priority",
    """WITH c AS (SELECT o_orderpriority AS series_id, o_orderstatus AS s, COUNT(*) AS n FROM orders GROUP BY 1, 2),
    m AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY n DESC, s) AS rn FROM c)
    SELECT series_id, s AS status FROM m WHERE rn = 1""",
)
def common_status_per_priority(spark, sf):
    """Mode per group (A2)."""
    rows = B.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderstatus").alias("status")
    )
    return most_common(rows, ["series_id"], "status")


@entry(
    "span_summary",
    f"""WITH {B.FACTS} SELECT series_id, MIN(ds) AS first_ds, MAX(ds) AS last_ds, COUNT(*) AS n_days,
      CAST(MAX(ds) - MIN(ds) + 1 AS INTEGER) AS span_days, ROUND(SUM(y), 2) / 1e6 AS total_m
    FROM facts GROUP BY 1""",
)
def span_summary(spark, sf):
    """First and last day per series, scaled total."""
    return B.facts(spark, sf).groupBy("series_id").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count("*").alias("n_days"),
        (F.datediff(F.max("ds"), F.min("ds")) + 1).alias("span_days"),
        (F.round(F.sum("y"), 2) / 1_000_000).alias("total_m"),
    )


@entry(
    "moving_average_30",
    f"""WITH {B.GOLD} SELECT series_id, ds, ROUND({B.trailing_sql('AVG', 'y', -29, 0)}, 5) AS y_mean30 FROM gold""",
)
def moving_average_30(spark, sf):
    """Trailing 30-day mean including the day itself."""
    df = B.panel(spark, sf)
    mean = FT.trailing(F.col("y"), F.avg, 30, current=True)
    return df.select("series_id", "ds", F.round(mean, 5).alias("y_mean30"))


@entry(
    "deviation_from_week",
    f"""WITH {B.GOLD} SELECT series_id, ds, ROUND(y - {B.trailing_sql('AVG', 'y', -7, -1)}, 5) + 0.0 AS deviation FROM gold""",
)
def deviation_from_week(spark, sf):
    """Distance to the mean of the seven days before."""
    off = F.round(FT.deviation_from_week("y"), 5) + 0.0
    return B.panel(spark, sf).select("series_id", "ds", off.alias("deviation"))


@entry(
    "last_rows",
    f"""WITH {B.GOLD}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rn FROM gold)
    SELECT series_id, ds, y FROM r WHERE rn <= 120""",
)
def last_rows(spark, sf):
    """The last 120 days of every series."""
    return FT.last_days(B.panel(spark, sf), 120).select("series_id", "ds", "y")


@entry(
    "scaled_covariates",
    f"""WITH {B.GOLD}, m AS (SELECT *, MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM gold),
    b AS (SELECT series_id, MIN(temp) AS t0, MAX(temp) AS t1, MIN(precip) AS p0, MAX(precip) AS p1,
      MIN(snow_lag1) AS s0, MAX(snow_lag1) AS s1, MIN(is_holiday) AS h0, MAX(is_holiday) AS h1
      FROM m WHERE back >= 30 GROUP BY 1)
    SELECT m.series_id, ds, CASE WHEN back < 30 THEN 'test' ELSE 'train' END AS split,
      ROUND((temp - t0) / CASE WHEN t1 > t0 THEN t1 - t0 ELSE 1 END, 9) AS temp,
      ROUND((precip - p0) / CASE WHEN p1 > p0 THEN p1 - p0 ELSE 1 END, 9) AS precip,
      ROUND((snow_lag1 - s0) / CASE WHEN s1 > s0 THEN s1 - s0 ELSE 1 END, 9) AS snow_lag1,
      CAST((is_holiday - h0) / CASE WHEN h1 > h0 THEN h1 - h0 ELSE 1 END AS DOUBLE) AS is_holiday
    FROM m JOIN b ON b.series_id = m.series_id""",
)
def scaled_covariates(spark, sf):
    """Covariates scaled on the training part, last 30 days held out (M1, M2)."""
    df = FT.holdout_split(B.panel(spark, sf))
    scaled = FT.scale_columns(
        df, ["temp", "precip", "snow_lag1", "is_holiday"], F.col("split") == "train"
    )
    return B.rounded(
        scaled.select("series_id", "ds", "split", "temp", "precip", "snow_lag1", "is_holiday")
    )


@entry(
    "scaler_bounds",
    f"""WITH {B.GOLD}, m AS (SELECT *, MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM gold)
    SELECT series_id, ROUND(MIN(temp), 6) AS temp_min, ROUND(MAX(temp), 6) AS temp_max,
      MIN(precip) AS precip_min, MAX(precip) AS precip_max
    FROM m WHERE back >= 30 GROUP BY 1""",
)
def scaler_bounds(spark, sf):
    """The scaler as a table (M1)."""
    df = FT.holdout_split(B.panel(spark, sf))
    return B.rounded(FT.scale_bounds(df, ["temp", "precip"], F.col("split") == "train"), 6)


TRAINING = f"""{B.FEATURES},
    training AS (SELECT * EXCLUDE (back) FROM (SELECT *, MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM features)
      WHERE back >= 30)"""


def training_rows(spark, sf):
    """The feature rows before the holdout."""
    rows = feature_table(B.panel(spark, sf)).withColumn("_back", FT.days_from_end())
    return rows.where(F.col("_back") >= S.HOLDOUT_DAYS).drop("_back")


@entry(
    "cv_fold_table",
    f"""WITH {TRAINING}, n AS (SELECT series_id, COUNT(*) AS n_rows FROM training GROUP BY 1),
    f AS (SELECT *, n_rows // 6 AS size, UNNEST([1, 2, 3, 4, 5]) AS fold FROM n)
    SELECT series_id, fold, CAST(n_rows - (6 - fold) * size AS BIGINT) AS train_end,
      CAST(n_rows - (5 - fold) * size AS BIGINT) AS test_end FROM f""",
)
def cv_fold_table(spark, sf):
    """Expanding-window folds of the training part as position ranges (M3)."""
    return FT.cv_folds(training_rows(spark, sf))


@entry(
    "cv_fold_scores",
    f"""WITH {TRAINING}, p AS (SELECT *, COUNT(*) OVER (PARTITION BY series_id) AS n,
      ROW_NUMBER() {B.W} - 1 AS pos FROM training),
    f AS (SELECT *, CASE WHEN pos < n - (n // 6) * 5 THEN 0
        ELSE (pos - (n - (n // 6) * 5)) // (n // 6) + 1 END AS fold FROM p)
    SELECT series_id, CAST(fold AS INTEGER) AS fold, COUNT(*) AS n_rows, MIN(ds) AS from_ds, MAX(ds) AS to_ds,
      ROUND(AVG(ABS(y_lag7 - y / 1e6)), 9) AS mae FROM f WHERE fold > 0 GROUP BY 1, 2""",
)
def cv_fold_scores(spark, sf):
    """Seasonal-naive error of each test fold (M3)."""
    rows = training_rows(spark, sf).withColumn("fold", FT.test_fold())
    return rows.where("fold > 0").groupBy("series_id", "fold").agg(
        F.count("*").alias("n_rows"),
        F.min("ds").alias("from_ds"),
        F.max("ds").alias("to_ds"),
        F.round(F.avg(F.abs(F.col("y_lag7") - F.col("y") / 1_000_000)), 9).alias("mae"),
    )


# Five fits of the linear model on lags and covariates, each on the folds before its own.
CV_COLUMNS = ["y_lag1", "y_lag2", "y_lag3", "y_lag7", "y_lag14", *S.EXOG]

CV_FITS = f"""{TRAINING}, p AS (SELECT *, COUNT(*) OVER (PARTITION BY series_id) AS n,
      ROW_NUMBER() {B.W} - 1 AS pos FROM training),
    obs AS (SELECT series_id, CASE WHEN pos < n - (n // 6) * 5 THEN 0 ELSE (pos - (n - (n // 6) * 5)) // (n // 6) + 1 END AS fold,
      y / 1e6 AS v, [1.0::DOUBLE, {', '.join(CV_COLUMNS)}] AS f FROM p),
    ix AS (SELECT CAST(UNNEST(range(1, 11)) AS INTEGER) AS i), folds AS (SELECT UNNEST([1, 2, 3, 4, 5]) AS k),
    gram AS (SELECT o.series_id, k AS fold, a.i, b.i AS j, SUM(o.f[a.i] * o.f[b.i]) AS s
      FROM obs o JOIN folds ON o.fold < k CROSS JOIN ix a CROSS JOIN ix b GROUP BY 1, 2, 3, 4),
    rhs AS (SELECT o.series_id, k AS fold, a.i, SUM(o.f[a.i] * o.v) AS s, COUNT(*) AS n
      FROM obs o JOIN folds ON o.fold < k CROSS JOIN ix a GROUP BY 1, 2, 3),
    lines AS (SELECT g.series_id, g.fold, g.i, list_append(list(g.s ORDER BY g.j), ANY_VALUE(r.s)) AS line, ANY_VALUE(r.n) AS n
      FROM gram g JOIN rhs r USING (series_id, fold, i) GROUP BY 1, 2, 3),
    gj AS (SELECT series_id, fold, ANY_VALUE(n) AS n, 1 AS k, list(line ORDER BY i) AS m FROM lines GROUP BY 1, 2
      UNION ALL
      SELECT series_id, fold, n, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
        ELSE list_transform(r, lambda x, c: x - r[k] * m[k][c] / m[k][k]) END) FROM gj WHERE k <= 10),
    off AS (SELECT o.series_id, o.fold, g.n, list_sum(list_transform(range(1, 11), lambda i: o.f[i] * g.m[i][11])) - o.v AS e
      FROM obs o JOIN gj g ON g.series_id = o.series_id AND g.fold = o.fold AND g.k = 11),
    s AS (SELECT series_id, fold, MAX(n) AS n_train, COUNT(*) AS n_rows, AVG(ABS(e)) AS mae, SQRT(AVG(e * e)) AS rmse FROM off GROUP BY 1, 2)"""


def _cv_scores(spark, sf):
    rows = stage(training_rows(spark, sf), "features").withColumn("target", F.col("y") / S.UNIT_SCALE)
    return fold_scores(rows, CV_COLUMNS, "target")


@entry(
    "cv_linear_scores",
    f"""WITH RECURSIVE {CV_FITS} SELECT series_id, CAST(fold AS INTEGER) AS fold, n_train, n_rows, ROUND(mae, 7) AS mae,
      ROUND(rmse, 6) AS rmse FROM s""",
)
def cv_linear_scores(spark, sf):
    """Errors of the linear model fitted anew for every fold (M3, M4)."""
    return B.rounded(_cv_scores(spark, sf), 7, rmse=6)


@entry(
    "cv_spread",
    f"""WITH RECURSIVE {CV_FITS}
    SELECT series_id, ROUND(AVG(mae), 7) AS cv_mean_mae, ROUND(STDDEV_POP(mae), 7) AS cv_std_mae FROM s GROUP BY 1""",
)
def cv_spread(spark, sf):
    """Mean and population deviation of the fitted model's error over the folds."""
    return _cv_scores(spark, sf).groupBy("series_id").agg(
        F.round(F.avg("mae"), 7).alias("cv_mean_mae"), F.round(F.stddev_pop("mae"), 7).alias("cv_std_mae")
    )
