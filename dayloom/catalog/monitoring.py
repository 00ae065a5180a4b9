"""Drift, live errors, retrain decision, run status."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.functions import errors as E
from dayloom.operators import forecast as FC
from dayloom.operators import monitor as M
from dayloom.operators import reports as R
from dayloom.operators.backtest import score
from dayloom.operators.features import whole
from dayloom.plans import monitoring as plan
from dayloom.plans import training
from dayloom.plans.gold import WEATHER

# Weekly snapshots, published a week after their origin: both baselines and their blend.
SNAPS = f"""{B.GOLD},
    o AS (SELECT series_id, ds AS origin FROM (SELECT *, ds - MIN(ds) OVER (PARTITION BY series_id) AS p FROM gold)
      WHERE p >= 13 AND isodow(ds) = 3),
    snaps AS (SELECT o.series_id, CAST(o.origin + 7 AS DATE) AS run_date, CAST(o.origin + s.h AS DATE) AS ds,
      n.y / 1e6 AS seasonal_naive, p.y / 1e6 AS persistence, 0.5::DOUBLE * (n.y / 1e6) + 0.5::DOUBLE * (p.y / 1e6) AS ensemble
      FROM o CROSS JOIN (SELECT CAST(UNNEST(range(1, 15)) AS INTEGER) AS h) s
      JOIN gold p ON p.series_id = o.series_id AND p.ds = o.origin
      JOIN gold n ON n.series_id = o.series_id AND n.ds = o.origin + s.h - CASE WHEN s.h <= 7 THEN 7 ELSE 14 END),
    today AS (SELECT MAX(ds) AS d FROM gold)"""

LIVE = f"""{SNAPS},
    recent AS (SELECT * FROM snaps WHERE run_date IN (SELECT DISTINCT run_date FROM snaps ORDER BY 1 DESC LIMIT 8)),
    numbered AS (SELECT *, CAST(ds - MIN(ds) OVER (PARTITION BY series_id, run_date) + 1 AS INTEGER) AS horizon FROM recent),
    live AS (SELECT n.*, g.y / 1e6 AS actual, n.ensemble - g.y / 1e6 AS error
      FROM numbered n JOIN gold g ON g.series_id = n.series_id AND g.ds = n.ds, today WHERE n.ds < today.d)"""


def snapshots(spark, sf, panel, newest=None):
    """The weekly runs; of the newest ones only, where the live window needs no others."""
    since = FC.newest_origins(panel, newest)[-1:] if newest else []
    cases = training.add_baselines(FC.snapshot_origins(panel, since=since[0] if since else None))
    cases = cases.withColumn(
        "ensemble", FC.blend_arrays(F.col("seasonal_naive"), F.col("persistence"))
    )
    wide = FC.to_wide(cases, ["seasonal_naive", "persistence", "ensemble"])
    return wide.withColumn("run_date", F.date_add("origin", 7)).drop("origin", "h", "y")


def today_of(panel):
    return panel.agg(F.max("ds").alias("m")).scalar()


@entry(
    "forecast_snapshots",
    f"""WITH {SNAPS} SELECT series_id, run_date, COUNT(*) AS n_days, MIN(ds) AS from_ds, MAX(ds) AS to_ds,
      ROUND(SUM(ensemble), 10) AS total FROM snaps GROUP BY 1, 2""",
)
def forecast_snapshots(spark, sf):
    """Every weekly snapshot over the whole history."""
    return B.rounded(
        snapshots(spark, sf, B.panel(spark, sf)).groupBy("series_id", "run_date").agg(
            F.count("*").alias("n_days"), F.min("ds").alias("from_ds"), F.max("ds").alias("to_ds"),
            F.sum("ensemble").alias("total"),
        ),
        10,
    )


@entry(
    "live_errors",
    f"""WITH {LIVE} SELECT series_id, run_date, ds, horizon, ROUND(ensemble, 12) AS ensemble, ROUND(seasonal_naive, 12) AS seasonal_naive,
      ROUND(actual, 12) AS actual, ROUND(error, 12) + 0.0 AS error, ROUND(ABS(error) / GREATEST(ABS(actual), 2.220446049250313e-16) * 100, 8) AS abs_pct_error,
      CAST(date_trunc('week', ds) AS DATE) AS week FROM live""",
)
def live_errors(spark, sf):
    """Past forecast days of the newest eight runs against actuals."""
    panel = B.gold(spark, sf)
    out = M.live_errors(snapshots(spark, sf, panel, S.LIVE_SNAPSHOTS), panel, today_of(panel))
    out = out.select(
        "series_id", "run_date", "ds", "horizon", "ensemble", "seasonal_naive", "actual", "error",
        "abs_pct_error", "week",
    )
    return B.rounded(out, 12, abs_pct_error=8)


@entry(
    "live_metrics",
    f"""WITH {LIVE} SELECT series_id, COUNT(*) AS n_evaluated, ROUND(AVG(ABS(error)), 9) AS rolling_mae,
      ROUND(AVG(ABS(error) / GREATEST(ABS(actual), 2.220446049250313e-16)) * 100, 6) AS rolling_mape_pct, COUNT(DISTINCT run_date) AS n_runs FROM live GROUP BY 1""",
)
def live_metrics(spark, sf):
    """MAE, MAPE, days and runs of the live window."""
    panel = B.gold(spark, sf)
    live = M.live_errors(snapshots(spark, sf, panel, S.LIVE_SNAPSHOTS), panel, today_of(panel))
    return B.rounded(M.live_metrics(live), 9, rolling_mape_pct=6)


@entry(
    "scatter_axis_range",
    f"""WITH {LIVE} SELECT series_id, ROUND(LEAST(MIN(actual), MIN(ensemble)) * 0.98, 9) AS axis_min,
      ROUND(GREATEST(MAX(actual), MAX(ensemble)) * 1.02, 9) AS axis_max FROM live GROUP BY 1""",
)
def scatter_axis_range(spark, sf):
    """Common axis of forecast and actual."""
    panel = B.gold(spark, sf)
    live = M.live_errors(snapshots(spark, sf, panel, S.LIVE_SNAPSHOTS), panel, today_of(panel))
    return B.rounded(R.axis_range(live, "actual", "ensemble"))


PSI = f"""{B.GOLD},
    ext AS (SELECT *, MAX(ds) OVER (PARTITION BY series_id) - ds AS back, COUNT(*) OVER (PARTITION BY series_id) AS n FROM gold),
    u AS (SELECT series_id, back, 'temp' AS feature, temp AS x FROM ext WHERE n >= 104 AND back < 104
      UNION ALL SELECT series_id, back, 'precip', precip FROM ext WHERE n >= 104 AND back < 104
      UNION ALL SELECT series_id, back, 'snow', snow FROM ext WHERE n >= 104 AND back < 104),
    e AS (SELECT series_id, feature, QUANTILE_CONT(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
      FROM u WHERE back >= 14 GROUP BY 1, 2),
    binned AS (SELECT u.series_id, u.feature, u.back < 14 AS is_recent, len(list_filter(e.edges, lambda b: b <= u.x)) AS bin
      FROM u JOIN e ON e.series_id = u.series_id AND e.feature = u.feature),
    slots AS (SELECT series_id, feature, UNNEST(range(0, 10)) AS bin FROM e),
    cnt AS (SELECT s.series_id, s.feature, s.bin, COUNT(*) FILTER (WHERE NOT b.is_recent) AS c_ref, COUNT(*) FILTER (WHERE b.is_recent) AS c_rec
      FROM slots s LEFT JOIN binned b ON b.series_id = s.series_id AND b.feature = s.feature AND b.bin = s.bin GROUP BY 1, 2, 3),
    psi AS (SELECT series_id, feature, SUM(((c_rec + 1e-8) / 14 - (c_ref + 1e-8) / 90) * LN(((c_rec + 1e-8) / 14) / ((c_ref + 1e-8) / 90))) AS psi
      FROM cnt GROUP BY 1, 2)"""


@entry(
    "psi_by_feature",
    f"WITH {PSI} SELECT series_id, feature, ROUND(psi, 8) AS psi FROM psi",
)
def psi_by_feature(spark, sf):
    """Stability index per series and feature."""
    return B.rounded(M.psi_scores(B.panel(spark, sf), WEATHER), 8)


@entry(
    "psi_summary",
    f"""WITH {PSI} SELECT series_id, ROUND(MAX(psi), 8) AS max_psi,
      CASE WHEN MAX(psi) > 0.25 THEN 'critical' WHEN MAX(psi) > 0.1 THEN 'moderate' ELSE 'stable' END AS psi_status FROM psi GROUP BY 1""",
)
def psi_summary(spark, sf):
    """Largest score and its class."""
    s = M.psi_summary(M.psi_scores(B.panel(spark, sf), WEATHER))
    return B.rounded(s.drop("psi_scores"), 8)


# Days on which a retrain would be recommended: far from the series' own mean.
RECOMMENDED = f"""{B.GOLD},
    av AS (SELECT series_id, ROUND(AVG(y), 2) AS m FROM gold GROUP BY 1),
    rcm AS (SELECT g.series_id, g.ds FROM gold g JOIN av ON av.series_id = g.series_id WHERE ABS(g.y - m) > 1.5 * m)"""

# A trigger blocks the next ones for a week: walk from trigger to trigger.
TRIGGERS = f"""{RECOMMENDED},
    trg AS (SELECT series_id, MIN(ds) AS d, 1 AS i FROM rcm GROUP BY 1
      UNION ALL
      SELECT t.series_id, (SELECT MIN(r.ds) FROM rcm r WHERE r.series_id = t.series_id AND r.ds >= t.d + 7), t.i + 1
      FROM trg t WHERE t.d IS NOT NULL),
    fired AS (SELECT series_id, d AS trigger_date FROM trg WHERE d IS NOT NULL
      QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY d DESC) <= 50)"""


def recommended(panel):
    mean = F.round(F.avg("y").over(whole()), 2)
    far = panel.withColumn("m", mean).where(F.abs(F.col("y") - F.col("m")) > 1.5 * F.col("m"))
    return far.select("series_id", "ds")


@entry(
    "trigger_history",
    f"WITH RECURSIVE {TRIGGERS} SELECT series_id, trigger_date FROM fired",
)
def trigger_history(spark, sf):
    """Cooldown replayed over the whole history, last 50 triggers kept."""
    return M.trigger_dates(recommended(B.panel(spark, sf)))


@entry(
    "last_trigger",
    f"""WITH RECURSIVE {TRIGGERS} SELECT series_id, MAX(trigger_date) AS last_trigger FROM fired
    WHERE trigger_date <= DATE '2001-01-31' GROUP BY 1""",
)
def last_trigger(spark, sf):
    """Last trigger on or before a day."""
    fired = M.trigger_dates(recommended(B.panel(spark, sf)))
    return M.last_trigger(fired, F.lit("2001-01-31").cast("date"))


@entry(
    "monitoring_report",
    f"""WITH RECURSIVE {LIVE},{PSI.split(B.GOLD + ',', 1)[1]},{TRIGGERS.split(B.GOLD + ',', 1)[1]},
    lm AS (SELECT series_id, COUNT(*) AS n_evaluated, AVG(ABS(error)) AS rolling_mae, AVG(ABS(error) / GREATEST(ABS(actual), 2.220446049250313e-16)) * 100 AS mape FROM live GROUP BY 1),
    tb AS (SELECT o.series_id, AVG(ABS(0.5::DOUBLE * (n.y / 1e6) + 0.5::DOUBLE * (p.y / 1e6) - a.y / 1e6)) AS training_mae
      FROM (SELECT series_id, CAST(MAX(ds) - 90 + 7 * i AS DATE) AS origin FROM gold, (SELECT CAST(UNNEST(range(0, 11)) AS INTEGER) AS i) GROUP BY series_id, i) o
      CROSS JOIN (SELECT CAST(UNNEST(range(1, 15)) AS INTEGER) AS h) s
      JOIN gold a ON a.series_id = o.series_id AND a.ds = o.origin + s.h
      JOIN gold p ON p.series_id = o.series_id AND p.ds = o.origin
      JOIN gold n ON n.series_id = o.series_id AND n.ds = o.origin + s.h - CASE WHEN s.h <= 7 THEN 7 ELSE 14 END GROUP BY 1),
    pm AS (SELECT series_id, MAX(psi) AS max_psi, MAX(psi) FILTER (feature = 'temp') AS psi_temp, MAX(psi) FILTER (feature = 'precip') AS psi_precip,
      MAX(psi) FILTER (feature = 'snow') AS psi_snow FROM psi GROUP BY 1),
    lt AS (SELECT series_id, MAX(trigger_date) AS last_trigger FROM fired, today WHERE trigger_date <= today.d GROUP BY 1),
    j AS (SELECT tb.series_id, today.d, n_evaluated, rolling_mae, mape, training_mae, max_psi, psi_temp, psi_precip, psi_snow, last_trigger,
      rolling_mae > 1.5 * training_mae AS wanted, rolling_mae > 1.5 * training_mae AND COALESCE(today.d - last_trigger < 7, FALSE) AS cooling
      FROM tb JOIN lm ON lm.series_id = tb.series_id JOIN pm ON pm.series_id = tb.series_id
      LEFT JOIN lt ON lt.series_id = tb.series_id, today)
    SELECT series_id, d AS report_date, n_evaluated, ROUND(rolling_mae, 9) AS rolling_mae, ROUND(mape, 6) AS rolling_mape_pct,
      ROUND(training_mae, 9) AS training_mae, ROUND(max_psi, 8) AS max_psi,
      CASE WHEN max_psi > 0.25 THEN 'critical' WHEN max_psi > 0.1 THEN 'moderate' ELSE 'stable' END AS psi_status,
      CASE WHEN wanted THEN 1 ELSE 0 END AS retrain_recommended, CASE WHEN cooling THEN 1 ELSE 0 END AS cooldown_active,
      CASE WHEN wanted AND NOT cooling THEN 1 ELSE 0 END AS retrain_triggered,
      ROUND(psi_temp, 8) AS psi_temp, ROUND(psi_precip, 8) AS psi_precip, ROUND(psi_snow, 8) AS psi_snow,
      CASE WHEN wanted THEN 'live_mae' END AS reason, CASE WHEN wanted THEN ROUND(rolling_mae, 9) END AS reason_value,
      CASE WHEN wanted THEN ROUND(1.5 * training_mae, 9) END AS reason_limit FROM j""",
)
def monitoring_report(spark, sf):
    """Live error, drift, retrain decision with cooldown."""
    panel = B.gold(spark, sf)
    # the limit's base: the backtest error of the very blend that the snapshots serve
    cases = training.add_baselines(FC.rolling_origins(panel))
    cases = cases.withColumn("ensemble", FC.blend_arrays(F.col("seasonal_naive"), F.col("persistence")))
    baseline = score(FC.to_long(cases, ["ensemble"])).select("series_id", F.col("mae").alias("training_mae"))
    triggers = M.trigger_dates(recommended(panel))
    out = plan.report(panel, snapshots(spark, sf, panel, S.LIVE_SNAPSHOTS), baseline, triggers, today_of(panel))
    out = out.select(
        "series_id", "report_date", "n_evaluated", "rolling_mae", "rolling_mape_pct", "training_mae",
        "max_psi", "psi_status", "retrain_recommended", "cooldown_active", "retrain_triggered",
        *[F.col("psi_scores")[c].alias(f"psi_{c}") for c in ("temp", "precip", "snow")],
        F.get("retrain_reasons", F.lit(0))["rule"].alias("reason"),
        F.get("retrain_reasons", F.lit(0))["value"].alias("reason_value"),
        F.get("retrain_reasons", F.lit(0))["limit"].alias("reason_limit"),
    )
    return B.rounded(out, 9, rolling_mape_pct=6, max_psi=8, psi_temp=8, psi_precip=8, psi_snow=8)


RUN_LOG = """log AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'ingestion' WHEN 'F' THEN 'training' ELSE 'prediction' END AS job,
    CAST(o_orderdate AS DATE) AS run_date,
    CASE WHEN COUNT(*) % 3 = 0 THEN 'failure' WHEN COUNT(*) % 7 = 0 THEN 'skipped' ELSE 'success' END AS status
    FROM orders GROUP BY 1, 2)"""


def run_log(spark, sf):
    job = (
        F.when(F.col("o_orderstatus") == "O", "ingestion")
        .when(F.col("o_orderstatus") == "F", "training")
        .otherwise("prediction")
    )
    n = F.count("*")
    status = F.when(n % 3 == 0, "failure").when(n % 7 == 0, "skipped").otherwise("success")
    return (
        B.table(spark, sf, "orders")
        .groupBy(job.alias("job"), F.to_date("o_orderdate").alias("run_date"))
        .agg(status.alias("status"))
    )


@entry(
    "run_status",
    f"""WITH {RUN_LOG},{B.FACTS}, t AS (SELECT MAX(ds) AS through FROM facts),
    n AS (SELECT MAX(run_date) AS today FROM log),
    r AS (SELECT job, run_date, status FROM log QUALIFY ROW_NUMBER() OVER (PARTITION BY job ORDER BY run_date DESC) = 1)
    SELECT job, run_date, status, CASE status WHEN 'success' THEN 'ok' WHEN 'failure' THEN 'failed' ELSE 'unknown' END AS badge,
      through AS data_through, CAST(today - through AS INTEGER) AS lag_days FROM r, t, n""",
)
def run_status(spark, sf):
    """Newest run of each job, badge, data coverage."""
    log = run_log(spark, sf)
    through = B.facts(spark, sf).agg(F.max("ds").alias("m")).scalar()
    return M.run_status(log, through, log.agg(F.max("run_date").alias("m")).scalar())


@entry(
    "run_status_fallback",
    f"""WITH {RUN_LOG},{B.FACTS}, t AS (SELECT MAX(ds) AS through FROM facts),
    n AS (SELECT MAX(run_date) AS today FROM log),
    r AS (SELECT job, run_date, status FROM log WHERE job <> 'prediction' QUALIFY ROW_NUMBER() OVER (PARTITION BY job ORDER BY run_date DESC) = 1
      UNION ALL SELECT 'prediction', CAST(through - 7 AS DATE), NULL FROM t)
    SELECT job, run_date, status, CASE status WHEN 'success' THEN 'ok' WHEN 'failure' THEN 'failed' ELSE 'unknown' END AS badge,
      through AS data_through, CAST(today - through AS INTEGER) AS lag_days FROM r, t, n""",
)
def run_status_fallback(spark, sf):
    """The same with no prediction run in the log: the served forecast tells its date."""
    log = run_log(spark, sf)
    ends = B.facts(spark, sf).agg(F.max("ds").alias("m"))
    served = ends.select(F.explode(F.array(F.date_sub("m", 14), F.date_sub("m", 7))).alias("run_date"))
    today = log.agg(F.max("run_date").alias("m")).scalar()
    return M.run_status(log.where("job <> 'prediction'"), ends.scalar(), today, served)


@entry(
    "data_lag",
    f"""WITH {B.FACTS},{B.WEATHER}, n AS (SELECT MAX(ds) AS today FROM weather), l AS (SELECT series_id, MAX(ds) AS last_actual FROM facts GROUP BY 1)
    SELECT series_id, last_actual, today, CAST(today - last_actual AS INTEGER) AS lag_days,
      CASE WHEN today > last_actual THEN CAST(last_actual + CAST((today - last_actual) // 2 AS INTEGER) AS DATE) END AS midpoint FROM l, n""",
)
def data_lag(spark, sf):
    """Last actual day, today and the middle between them (R2)."""
    today = B.weather(spark, sf).agg(F.max("ds").alias("m")).scalar()
    return R.data_lag(B.facts(spark, sf), today)
