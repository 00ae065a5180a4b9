"""Drift, live forecast errors and the retrain decision. ``as_of`` is always an argument:
nothing reads the wall clock, so a report can be made again for any past day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.functions import errors as E
from dayloom.functions.calendar import week_start
from dayloom.operators.features import SERIES, days_from_end, whole


def latest_snapshots(snapshots: DataFrame, n: int, run: str = "run_date") -> DataFrame:
    """Rows of the newest n snapshots. The run dates are reduced to n values first; no
    window over all rows is needed."""
    newest = snapshots.select(run).distinct().orderBy(F.desc(run)).limit(n)
    return snapshots.join(newest, run, "left_semi")


def newest_snapshot(snapshots: DataFrame, run: str = "run_date") -> DataFrame:
    top = snapshots.agg(F.max(run).alias("m")).scalar()
    return snapshots.where(F.col(run) == top)


def live_errors(
    forecasts: DataFrame,
    actuals: DataFrame,
    as_of: Column,
    n_runs: int = S.LIVE_SNAPSHOTS,
    keys: list[str] = SERIES,
    unit: float = S.UNIT_SCALE,
) -> DataFrame:
    """Past forecast days of the newest runs against actuals. A date forecast by several
    runs counts once per run. The step is counted from the run's first day, before past
    days are filtered."""
    origin = Window.partitionBy(*keys, "run_date")
    recent = latest_snapshots(forecasts, n_runs).withColumn(
        "horizon", F.datediff("ds", F.min("ds").over(origin)) + 1
    )
    truth = actuals.select(*keys, "ds", (F.col("y") / unit).alias("actual"))
    df = recent.where(F.col("ds") < as_of).join(truth, [*keys, "ds"])
    return df.withColumns(
        {
            "error": F.col("ensemble") - F.col("actual"),
            "abs_pct_error": E.pct_error(F.col("actual"), F.col("ensemble")),
            "week": week_start(F.col("ds")),
        }
    )


def live_metrics(errors: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    return errors.groupBy(*keys).agg(
        F.count("*").alias("n_evaluated"),
        F.avg(F.abs("error")).alias("rolling_mae"),
        F.avg(E.pct_error(F.col("actual"), F.col("actual") + F.col("error"))).alias("rolling_mape_pct"),
        F.count_distinct("run_date").alias("n_runs"),
    )


def psi_scores(
    panel: DataFrame,
    features: list[str],
    keys: list[str] = SERIES,
    reference_days: int = S.REFERENCE_DAYS,
    recent_days: int = S.RECENT_DAYS,
    buckets: int = S.PSI_BUCKETS,
    eps: float = S.PSI_EPS,
) -> DataFrame:
    """Population stability index per series and feature: last days against the window
    before. Series shorter than both windows give no row.

    Both samples are bounded by the two window lengths, so a series' samples and bin edges
    come from one aggregate and the bins are counted inside the row.
    """
    span = reference_days + recent_days
    df = panel.withColumns(
        {"_back": days_from_end(keys), "_n": F.count("*").over(whole(keys))}
    ).where((F.col("_n") >= span) & (F.col("_back") < span))
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
            for c in features
        ]
    )
    rows = df.select(
        *keys, (F.col("_back") < recent_days).alias("_recent"), F.explode(entries).alias("_e")
    ).select(*keys, "_recent", "_e.feature", "_e.x")
    reference = F.when(~F.col("_recent"), F.col("x"))
    recent = F.when(F.col("_recent"), F.col("x"))
    inner = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    samples = rows.groupBy(*keys, "feature").agg(
        F.percentile(reference, inner).alias("_edges"),
        F.collect_list(reference).alias("_ref"),
        F.collect_list(recent).alias("_rec"),
    )

    def shares(sample: str) -> Column:
        bins = F.transform(
            sample, lambda x: F.size(F.filter("_edges", lambda e: e <= x))
        )
        return F.transform(
            F.sequence(F.lit(0), F.lit(buckets - 1)),
            lambda b: (F.size(F.filter(bins, lambda i: i == b)) + F.lit(eps)) / F.size(sample),
        )

    both = samples.select(*keys, "feature", shares("_ref").alias("_p"), shares("_rec").alias("_q"))
    parts = F.zip_with("_p", "_q", lambda p, q: (q - p) * F.log(q / p))
    return both.select(
        *keys, "feature", F.aggregate(parts, F.lit(0.0), lambda a, v: a + v).alias("psi")
    )


def psi_summary(scores: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    top = scores.groupBy(*keys).agg(
        F.max("psi").alias("max_psi"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("feature", "psi")))
        ).alias("psi_scores"),
    )
    return top.withColumn("psi_status", E.psi_status(F.col("max_psi")))


def last_trigger(triggers: DataFrame, as_of: Column, keys: list[str] = SERIES) -> DataFrame:
    return (
        triggers.where(F.col("trigger_date") <= as_of)
        .groupBy(*keys)
        .agg(F.max("trigger_date").alias("last_trigger"))
    )


def retrain_decision(
    live: DataFrame,
    baseline: DataFrame,
    psi: DataFrame,
    triggers: DataFrame,
    as_of: Column,
    keys: list[str] = SERIES,
    multiplier: float = S.RETRAIN_MULTIPLIER,
    cooldown: int = S.COOLDOWN_DAYS,
) -> DataFrame:
    """The monitoring report, one row per series. Only the live MAE can recommend a
    retrain; drift is shown. A trigger less than ``cooldown`` days ago suppresses it.

    live: keys, rolling_mae, …; baseline: keys, training_mae; psi: keys, max_psi,
    psi_status; triggers: keys, trigger_date.
    """
    df = (
        baseline.join(live, keys, "left")
        .join(psi, keys, "left")
        .join(last_trigger(triggers, as_of, keys), keys, "left")
    )
    limit = F.col("training_mae") * multiplier
    wanted = F.coalesce(F.col("rolling_mae") > limit, F.lit(False))
    cooling = wanted & F.coalesce(F.datediff(as_of, "last_trigger") < cooldown, F.lit(False))
    reason = F.struct(F.lit("live_mae").alias("rule"), F.col("rolling_mae").alias("value"), limit.alias("limit"))
    return df.withColumns(
        {
            "report_date": as_of,
            "n_evaluated": F.coalesce("n_evaluated", F.lit(0)),
            "max_psi": F.coalesce("max_psi", F.lit(0.0)),
            "psi_status": F.coalesce("psi_status", F.lit("stable")),
            "retrain_recommended": wanted.cast("int"),
            "cooldown_active": cooling.cast("int"),
            "retrain_triggered": (wanted & ~cooling).cast("int"),
            "retrain_reasons": F.filter(F.array(F.when(wanted, reason)), lambda r: r.isNotNull()),
        }
    )


def retrain_flag(report: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """What a day's decision does to the flag of each series: written with its reasons when a retrain
    is triggered, cleared while the cooldown lasts, else left as it is (no row)."""
    acts = F.when(F.col("retrain_triggered") == 1, "write").when(F.col("cooldown_active") == 1, "clear")
    return report.select(
        *keys, F.col("report_date").alias("flag_date"), acts.alias("action"), "rolling_mae", "max_psi",
        "retrain_reasons",
    ).where("action IS NOT NULL")


def trigger_dates(
    recommended: DataFrame, cooldown: int = S.COOLDOWN_DAYS, keep: int = S.TRIGGER_HISTORY,
    keys: list[str] = SERIES,
) -> DataFrame:
    """Replays the cooldown over a history of daily recommendations (keys, ds) and keeps the
    last ``keep`` triggers. A trigger depends on the one before it, so the days of a series
    (at most one per calendar day) are folded in order inside one expression."""
    days = recommended.groupBy(*keys).agg(F.sort_array(F.collect_set("ds")).alias("_days"))
    empty = F.array().cast("array<date>")

    def add(done: Column, day: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        blocked = F.coalesce(F.datediff(day, last) < cooldown, F.lit(False))
        return F.when(blocked, done).otherwise(F.concat(done, F.array(day)))

    fired = days.withColumn("_fired", F.aggregate("_days", empty, add))
    kept = F.when(F.size("_fired") > keep, F.slice("_fired", -keep, keep)).otherwise(F.col("_fired"))
    return fired.select(*keys, F.explode(kept).alias("trigger_date"))


def run_status(
    runs: DataFrame, data_through: Column, as_of: Column, forecasts: DataFrame | None = None
) -> DataFrame:
    """Newest run per job with its badge and how far the data lags behind. Without a prediction run in
    the log, the served ``forecasts`` (``run_date``) say when one was; its status is unknown."""
    newest = runs.groupBy("job").agg(
        F.max("run_date").alias("run_date"), F.max_by("status", "run_date").alias("status")
    )
    if forecasts is not None:
        served = forecasts.agg(F.max("run_date").alias("run_date")).where("run_date IS NOT NULL").select(
            F.lit("prediction").alias("job"), "run_date", F.lit(None).cast("string").alias("status")
        )
        newest = newest.unionByName(served.join(newest.select("job"), "job", "left_anti"))
    return newest.withColumns(
        {
            "badge": E.status_badge(F.col("status")),
            "data_through": data_through,
            "lag_days": F.datediff(as_of, data_through),
        }
    )
