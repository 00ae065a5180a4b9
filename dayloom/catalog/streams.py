"""Streaming jobs over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.operators.features import by_day, trailing, whole
from dayloom.session import shared_dir, stage
from dayloom.streaming import jobs


def _events(spark, sf):
    schema = B.table(spark, sf, "events").schema
    return jobs.file_stream(spark, sf, schema, "events.parquet")


@entry(
    "stream_daily_totals",
    """SELECT CAST(ts AS DATE) AS ds, event_type, ROUND(SUM(value), 6) AS y, COUNT(*) AS n_rows FROM events
    WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def stream_daily_totals(spark, sf):
    """Day totals of a stream, open days included."""
    return jobs.upsert_totals(
        _events(spark, sf), ["event_type"], shared_dir(spark, "daily-totals"), shared_dir(spark, "daily-totals-ck")
    )


@entry(
    "stream_closed_totals",
    """SELECT CAST(ts AS DATE) AS ds, event_type, ROUND(SUM(value), 6) AS y, COUNT(*) AS n_rows FROM events
    WHERE CAST(ts AS DATE) + 1 <= (SELECT MAX(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1, 2""",
)
def stream_closed_totals(spark, sf):
    """Day totals of days that the watermark has closed, final when they come out."""
    out = jobs.daily_totals(_events(spark, sf), ["event_type"])
    return jobs.drain(out, shared_dir(spark, "closed-totals"), shared_dir(spark, "closed-totals-ck"))


@entry(
    "stream_distinct_arrivals",
    "SELECT DISTINCT event_type AS name, CAST(ts AS DATE) AS date, user_id FROM events",
)
def stream_distinct_arrivals(spark, sf):
    """First arrival per key on a stream."""
    events = _events(spark, sf).select(
        "ts", F.col("event_type").alias("name"), F.to_date("ts").alias("date"), "user_id"
    )
    out = jobs.distinct_arrivals(events, ["name", "date", "user_id"]).drop("ts")
    return jobs.drain(out, shared_dir(spark, "arrivals"), shared_dir(spark, "arrivals-ck"))


# The daily report's rule on the week-old value as forecast: its mean error of two weeks against
# half as much again as that of the first year.
REPORTS = f"""{B.GOLD},
    e AS (SELECT series_id, ds, ABS(y - LAG(y, 7) {B.W}) / 1e6 AS off, MIN(ds) OVER (PARTITION BY series_id) AS first FROM gold),
    r AS (SELECT *, CASE WHEN COUNT(off) {B.frame(-13, 0)} = 14 THEN ROUND(AVG(off) {B.frame(-13, 0)}, 6) END AS rolling,
      ROUND(AVG(CASE WHEN ds < first + 365 THEN off END) OVER (PARTITION BY series_id), 6) AS training FROM e),
    rec AS (SELECT series_id, ds FROM r WHERE rolling > 1.5 * training),
    trg AS (SELECT series_id, MIN(ds) AS d FROM rec GROUP BY 1
      UNION ALL SELECT t.series_id, (SELECT MIN(x.ds) FROM rec x WHERE x.series_id = t.series_id AND x.ds >= t.d + 7)
      FROM trg t WHERE t.d IS NOT NULL),
    acts AS (SELECT rec.series_id, rec.ds, CASE WHEN trg.d IS NULL THEN 'clear' ELSE 'trigger' END AS action
      FROM rec LEFT JOIN trg ON trg.series_id = rec.series_id AND trg.d = rec.ds)"""


def _reports(spark, sf):
    panel = B.panel(spark, sf)
    off = panel.withColumns({
        "off": F.abs(F.col("y") - F.lag("y", 7).over(by_day())) / S.UNIT_SCALE, "first": F.min("ds").over(whole()),
    })
    early = F.when(F.col("ds") < F.date_add("first", 365), F.col("off"))
    off = off.withColumns({
        "rolling": F.round(trailing(F.col("off"), F.avg, 14, current=True), 6),
        "training": F.round(F.avg(early).over(whole()), 6),
    })
    wanted = F.coalesce(F.col("rolling") > S.RETRAIN_MULTIPLIER * F.col("training"), F.lit(False))
    return off.select("series_id", "ds", wanted.alias("recommended"))


def _retrain_actions(spark, sf):
    """The reports arrive in files of a year, each year's rows in any order, and one last report of a
    day far ahead, which closes all others."""
    folder = shared_dir(spark, "reports")
    reports = stage(_reports(spark, sf), "reports")
    ahead = reports.agg(F.date_add(F.max("ds"), 400).alias("ds")).select(
        F.lit(None).cast("string").alias("series_id"), "ds", F.lit(False).alias("recommended")
    )
    years = [r.year for r in reports.select(F.year("ds").alias("year")).distinct().orderBy("year").collect()]
    for year in years:
        part = reports.where(F.year("ds") == year).coalesce(1).sortWithinPartitions(F.xxhash64("ds", "series_id"))
        part.write.mode("append").parquet(folder)
    ahead.write.mode("append").parquet(folder)
    stream = jobs.file_stream(spark, folder, reports.schema, "*.parquet", files_per_batch=3)
    actions = jobs.retrain_actions(stream, lateness="366 days")
    return jobs.drain_state(actions, shared_dir(spark, "actions"), shared_dir(spark, "actions-ck"))


@entry("stream_retrain_triggers", f"WITH RECURSIVE {REPORTS} SELECT series_id, ds, action FROM acts")
def stream_retrain_triggers(spark, sf):
    """Recommendations as keyed state with timers: trigger, or clear within the cooldown."""
    return _retrain_actions(spark, sf)


@entry(
    "retrain_flags",
    f"""WITH RECURSIVE {REPORTS} SELECT series_id, MAX(ds) AS as_of, MAX(ds) FILTER (action = 'trigger') AS last_trigger,
      arg_max(action, ds) = 'trigger' AS is_set FROM acts GROUP BY 1""",
)
def retrain_flags(spark, sf):
    """The retrain flag after the newest decision."""
    return jobs.retrain_flags(_retrain_actions(spark, sf))


@entry("stream_silver", f"WITH {B.SILVER} SELECT series_id, ds, y, temp, precip, snow FROM silver")
def stream_silver(spark, sf):
    """Bronze files to silver in steps over the stored watermark; rows of closed days are dropped."""
    facts = stage(B.facts(spark, sf), "facts")
    weather = B.weather(spark, sf).withColumn("arrival", F.lit(1))
    bronze, silver, ck = (shared_dir(spark, n) for n in ("bronze", "silver", "silver-ck"))
    late = facts.where(F.year("ds") == 1996).withColumn("y", F.lit(-1.0))
    steps = [facts.where(F.year("ds") < 1998), late.unionByName(facts.where(F.year("ds") == 1998)),
             facts.where(F.year("ds") > 1998)]
    for rows in steps:
        rows.coalesce(1).write.mode("append").parquet(bronze)
        stream = jobs.file_stream(spark, bronze, facts.schema, "*.parquet")
        jobs.append_silver(spark, stream, weather, "arrival", silver, ck)
    return spark.read.parquet(silver).drop(jobs.BATCH, jobs.MONTH)


@entry(
    "stream_gated_feed",
    f"""WITH {B.FACTS},{B.WEATHER} SELECT ds, ROUND(temp, 9) AS temp, ds IN (SELECT ds FROM facts) AS is_open FROM weather""",
)
def stream_gated_feed(spark, sf):
    """Weather rows wait for the facts of their day: the leader comes late, early or never."""
    weather = stage(B.weather(spark, sf).select("ds", F.round("temp", 9).alias("temp")), "weather")
    days = stage(B.facts(spark, sf).select("ds").distinct(), "days")
    ahead = weather.agg(F.date_add(F.max("ds"), 3000).alias("ds"))
    feed, lead = shared_dir(spark, "weather-feed"), shared_dir(spark, "facts-feed")
    cuts = [F.col("ds") < "1997-01-01", F.col("ds").between("1997-01-01", "1999-12-31"), F.col("ds") > "1999-12-31"]
    for k in range(3):  # in different order
        weather.where(cuts[k]).coalesce(1).write.mode("append").parquet(feed)
        days.where(cuts[(k + 1) % 3]).coalesce(1).write.mode("append").parquet(lead)
    ahead.withColumn("temp", F.lit(0.0)).write.mode("append").parquet(feed)
    ahead.write.mode("append").parquet(lead)
    rows, leader = (
        jobs.file_stream(spark, path, table.schema, "*.parquet", files_per_batch=1)
        for path, table in ((feed, weather), (lead, days))
    )
    out = jobs.gated(rows, leader, "2900 days")
    out = jobs.drain(out, shared_dir(spark, "gated"), shared_dir(spark, "gated-ck"))
    return out.join(weather.select("ds"), "ds", "left_semi")  # not the row far ahead, which closes the others
