"""Feeds, silver merge, snapshots of sources, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.operators import monitor as M
from dayloom.operators import panel as P
from dayloom.plans import jobs as scheduled
from dayloom.session import shared_dir, stage
from dayloom.sources import feeds, lake


def day(text: str):
    return F.lit(text).cast("date")


@entry(
    "extract_daily",
    """SELECT CAST(ts AS DATE) AS ds, user_id % 10 AS district, ROUND(SUM(value), 6) AS y FROM events
    WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00'
    GROUP BY 1, 2""",
)
def extract_daily(spark, sf):
    """Day × dimension totals of one kind in a date range."""
    events = B.table(spark, sf, "events").withColumn("district", F.col("user_id") % 10)
    kind = F.col("event_type") == "view"
    return feeds.extract_daily(events, kind, day("2024-01-05"), day("2024-01-20"), ["district"])


@entry(
    "extract_page",
    """WITH e AS (SELECT CAST(ts AS DATE) AS ds, event_type, ROUND(SUM(value), 6) AS y FROM events GROUP BY 1, 2)
    SELECT * FROM e ORDER BY ds, event_type LIMIT 40 OFFSET 20""",
)
def extract_page(spark, sf):
    """A page in a total order."""
    daily = B.table(spark, sf, "events").groupBy(F.to_date("ts").alias("ds"), "event_type").agg(
        F.round(F.sum("value"), 6).alias("y")
    )
    return feeds.page(daily, ["ds", "event_type"], 40, 20)


@entry(
    "all_pages",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y,
      CAST((ROW_NUMBER() OVER (ORDER BY CAST(o_orderdate AS DATE) NULLS FIRST, o_orderkey) - 1) // 500 AS BIGINT) AS page FROM orders""",
)
def all_pages(spark, sf):
    """Every row with its page, pages cut from ranges of the order."""
    rows = B.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ds"), F.col("o_totalprice").alias("y"))
    return feeds.paged(rows, ["ds", "o_orderkey"], 500)


@entry(
    "page_after_key",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y FROM orders),
    l AS (SELECT ds, o_orderkey FROM o WHERE ds <= DATE '2000-12-31' ORDER BY ds DESC, o_orderkey DESC LIMIT 1)
    SELECT o.* FROM o, l WHERE o.ds > l.ds OR (o.ds = l.ds AND o.o_orderkey > l.o_orderkey) ORDER BY o.ds, o.o_orderkey LIMIT 200""",
)
def page_after_key(spark, sf):
    """A deep page, sought from the last key of the page before."""
    rows = B.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ds"), F.col("o_totalprice").alias("y"))
    last = rows.where("ds <= '2000-12-31'").agg(F.max(F.struct("ds", "o_orderkey")).alias("k")).select("k.*").first()
    return feeds.seek_page(rows, ["ds", "o_orderkey"], 200, last)


@entry(
    "two_feed_history",
    f"""WITH {B.FACTS}, old AS (SELECT * FROM facts WHERE ds BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'),
    cur AS (SELECT o_orderpriority AS series_id, CAST(l_shipdate AS DATE) AS ds,
      CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS y
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE CAST(l_shipdate AS DATE) > DATE '1998-12-31' AND CAST(l_shipdate AS DATE) <= DATE '2000-06-30' GROUP BY 1, 2)
    SELECT series_id, ds, y FROM old UNION ALL SELECT series_id, ds, y FROM cur""",
)
def two_feed_history(spark, sf):
    """Old feed up to the boundary day, new feed after it."""
    lines = B.table(spark, sf, "lineitem").select(
        "l_orderkey", F.to_date("l_shipdate").alias("ds"), B.hundredths("l_extendedprice").alias("c")
    )
    lines = lines.groupBy("l_orderkey", "ds").agg(F.sum("c").alias("c"))
    orders = B.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("series_id")
    )
    current = (
        lines.join(orders, "l_orderkey")
        .groupBy("series_id", "ds")
        .agg((F.sum("c") / 100).alias("y"))
    )
    return feeds.split_at_boundary(
        B.facts(spark, sf), current, day("1996-01-01"), day("2000-06-30"), "1998-12-31"
    )


@entry(
    "silver_merge",
    f"""WITH {B.SILVER}, old AS (SELECT * FROM silver WHERE ds <= DATE '1999-12-31'),
    fresh AS (SELECT DISTINCT f.* FROM facts f WHERE f.ds > (SELECT MAX(ds) FROM old)),
    dup AS (SELECT ds, temp + 1 AS temp, precip, snow, 1 AS arrival FROM weather
      UNION ALL SELECT ds, temp, precip, snow, 2 FROM weather),
    dim AS (SELECT * FROM dup QUALIFY ROW_NUMBER() OVER (PARTITION BY ds ORDER BY arrival DESC) = 1)
    SELECT series_id, ds, y, temp, precip, snow FROM old
    UNION ALL SELECT fresh.series_id, fresh.ds, fresh.y, dim.temp, dim.precip, dim.snow
    FROM fresh LEFT JOIN dim ON dim.ds = fresh.ds""",
)
def silver_merge(spark, sf):
    """Watermark, semi-join, deduplicated covariates, left join, union."""
    facts, weather = B.facts(spark, sf), B.weather(spark, sf)
    old = P.join_covariates(facts, weather).where(F.col("ds") <= day("1999-12-31"))
    # Two overlapping covariate files: the later one has the right temperature.
    first = weather.withColumn("temp", F.col("temp") + 1).withColumn("arrival", F.lit(1))
    files = P.union_all([first, weather.withColumn("arrival", F.lit(2))])
    return P.merge_silver(old, facts, files, F.col("arrival")).select(
        "series_id", "ds", "y", "temp", "precip", "snow"
    )


@entry(
    "distinct_union",
    f"""WITH {B.FACTS}, a AS (SELECT ds, y, series_id FROM facts WHERE ds <= DATE '1998-06-30'),
    b AS (SELECT ds, y, series_id FROM facts WHERE ds >= DATE '1998-01-01')
    SELECT ds, y, series_id, CAST(NULL AS DOUBLE) AS temp FROM a
    UNION SELECT ds, y, series_id, NULL FROM b""",
)
def distinct_union(spark, sf):
    """Overlapping files, one with an extra column, made distinct."""
    f = B.facts(spark, sf)
    a = f.where(F.col("ds") <= day("1998-06-30"))
    b = P.add_missing_columns(f.where(F.col("ds") >= day("1998-01-01")), {"temp": "double"})
    return P.union_all([a, b]).dropDuplicates()


@entry(
    "covered_dimension",
    f"""WITH {B.FACTS},{B.WEATHER} SELECT ds, temp, precip, snow FROM weather
    WHERE ds IN (SELECT ds FROM facts)""",
)
def covered_dimension(spark, sf):
    """Covariate days that occur in the facts."""
    return P.covered_days(B.weather(spark, sf), B.facts(spark, sf))


@entry(
    "flat_listing",
    """WITH e AS (SELECT event_type, CAST(ts AS DATE) AS d, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
      user_id FROM events)
    SELECT event_type || '-' || k AS name, strftime(d, '%Y-%m-%d') AS date, 'hall-' || (user_id % 5) AS venue,
      'listing' AS source, COUNT(*) AS n FROM e GROUP BY 1, 2, 3, 4""",
)
def flat_listing(spark, sf):
    """Nested documents → one row per event."""
    rows = feeds.flatten_listing(_documents(spark, sf), "body", "venue", "listing")
    return rows.groupBy("name", "date", "venue", "source").agg(F.count("*").alias("n"))


def _documents(spark, sf):
    e = B.table(spark, sf, "events").select(
        "event_type", F.to_date("ts").cast("string").alias("d"), "user_id",
        F.from_json("props", "k int")["k"].alias("k"),
    )
    event = F.struct(
        F.concat_ws("-", "event_type", F.col("k").cast("string")).alias("name"),
        F.struct(F.struct(F.col("d").alias("localDate")).alias("start")).alias("dates"),
    )
    body = F.to_json(F.struct(F.struct(F.array(event).alias("events")).alias("_embedded")))
    venue = F.concat(F.lit("hall-"), (F.col("user_id") % 5).cast("string"))
    return e.select(venue.alias("venue"), body.alias("body"))


@entry(
    "fallback_source",
    """SELECT name, date, venue, source, COUNT(*) AS n FROM (
      SELECT CASE WHEN event_id % 7 <> 0 THEN event_type || '!' WHEN event_id % 2 = 0 THEN event_type ELSE 'Event' END AS name,
        strftime(ts, '%Y-%m-%d') AS date, '' AS venue, 'permits' AS source FROM events) GROUP BY 1, 2, 3, 4""",
)
def fallback_source(spark, sf):
    """The second source with its defaults, because the first is empty."""
    e = B.table(spark, sf, "events")
    listing = feeds.flatten_listing(_documents(spark, sf), "body", "venue", "listing").drop("seq")
    permits = feeds.flatten_permits(
        e.select(
            F.when(F.col("event_id") % 7 != 0, F.concat("event_type", F.lit("!"))).alias("event_name"),
            F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("event_type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("start_date_time"),
            F.lit(None).cast("string").alias("event_location"),
        ),
        "permits",
    )
    rows = feeds.with_fallback(listing.where(F.col("name") == "no such event"), permits)
    return rows.groupBy("name", "date", "venue", "source").agg(F.count("*").alias("n"))


@entry(
    "first_arrival",
    """SELECT event_type AS name, CAST(ts AS DATE) AS date, event_id AS seq, user_id AS venue FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id) = 1""",
)
def first_arrival(spark, sf):
    """First row per name and date in arrival order."""
    e = B.table(spark, sf, "events").select(
        F.col("event_type").alias("name"), F.to_date("ts").alias("date"),
        F.col("event_id").alias("seq"), F.col("user_id").alias("venue"),
    )
    return P.first_arrival(e, ["name", "date"], ["seq"])


@entry(
    "latest_event_files",
    """WITH s AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS run_date, event_type AS name, COUNT(*) AS n
      FROM events GROUP BY 1, 2)
    SELECT * FROM s WHERE run_date IN (SELECT DISTINCT run_date FROM s ORDER BY 1 DESC LIMIT 4)""",
)
def latest_event_files(spark, sf):
    """Records of the newest four weekly snapshots."""
    s = B.table(spark, sf, "events").groupBy(
        F.date_trunc("week", "ts").cast("date").alias("run_date"), F.col("event_type").alias("name")
    ).agg(F.count("*").alias("n"))
    return M.latest_snapshots(s, 4)


@entry(
    "newest_event_file",
    """WITH s AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS run_date, event_type AS name, COUNT(*) AS n
      FROM events GROUP BY 1, 2)
    SELECT * FROM s WHERE run_date = (SELECT MAX(run_date) FROM s)""",
)
def newest_event_file(spark, sf):
    """Records of the newest snapshot."""
    s = B.table(spark, sf, "events").groupBy(
        F.date_trunc("week", "ts").cast("date").alias("run_date"), F.col("event_type").alias("name")
    ).agg(F.count("*").alias("n"))
    return M.newest_snapshot(s)


@entry(
    "ingest_windows",
    f"""WITH {B.FACTS},{B.WEATHER}, w AS (SELECT series_id, MAX(ds) AS wm FROM facts GROUP BY 1),
    d AS (SELECT MAX(ds) AS top FROM weather)
    SELECT series_id, CAST(wm + 1 AS DATE) AS from_ds, CAST(top - 6 AS DATE) AS to_ds,
      CASE WHEN wm + 1 <= top - 6 THEN 1 ELSE 0 END AS has_work, CAST(wm + 1 AS DATE) AS outlook_from, CAST(wm + 14 AS DATE) AS outlook_to
    FROM w, d""",
)
def ingest_windows(spark, sf):
    """Next range of each feed from watermark and publish lag, and its outlook range."""
    wm = B.facts(spark, sf).groupBy("series_id").agg(F.max("ds").alias("wm"))
    as_of = B.weather(spark, sf).agg(F.max("ds").alias("m")).scalar()
    first, last, work = lake.ingest_window(F.col("wm"), as_of)
    return wm.select(
        "series_id", first.alias("from_ds"), last.alias("to_ds"), work.cast("int").alias("has_work"),
        F.date_add("wm", 1).alias("outlook_from"), F.date_add("wm", 14).alias("outlook_to"),
    )


@entry(
    "table_fingerprint",
    """WITH f AS (SELECT o_orderpriority AS series_id, md5(concat(COALESCE(length(k) || ':' || k, '-'),
        COALESCE(length(c) || ':' || c, '-'), COALESCE(length(s) || ':' || s, '-'), COALESCE(length(d) || ':' || d, '-'))) AS m
      FROM (SELECT o_orderpriority, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s,
        strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders))
    SELECT series_id, COUNT(*) AS n_rows, CAST(SUM(CAST('0x' || substr(m, 1, 15) AS BIGINT)) AS VARCHAR) || '-'
      || CAST(SUM(CAST('0x' || substr(m, 16, 15) AS BIGINT)) AS VARCHAR) AS digest FROM f GROUP BY 1""",
)
def table_fingerprint(spark, sf):
    """Order-free content hash per group."""
    o = B.table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return lake.fingerprint(
        o.withColumnRenamed("o_orderpriority", "series_id"),
        ["o_orderkey", "o_custkey", "o_orderstatus", "day"], ["series_id"],
    )


@entry(
    "csv_batches",
    f"""WITH {B.FACTS} SELECT series_id, ds, ROUND(y, 2) AS y, CAST(make_date(year(ds), 12, 31) AS DATE) AS through
    FROM facts WHERE year(ds) > 1998""",
)
def csv_batches(spark, sf):
    """Facts as CSV batches by year; only those past a stored watermark are read back."""
    facts = stage(B.facts(spark, sf), "facts")
    root, log = shared_dir(spark, "csv"), shared_dir(spark, "csv-log")
    named = facts.select("ds", F.col("series_id").alias("entity"), F.lit(None).cast("string").alias("region"), F.round("y", 2).alias("y"))
    for (year,) in facts.select(F.year("ds").alias("y")).distinct().orderBy("y").collect():
        lake.write_csv(named.where(F.year("ds") == year), lake.batch_path(root, "facts", f"{year}-01-01", f"{year}-12-31"))
    lake.write_watermark(spark, log, "facts", 0, "1998-12-31")
    seen = F.lit(lake.read_watermark(spark, log, "facts"))
    rows = lake.read_csv(spark, root, lake.FACTS, newer_than=seen)
    return rows.select(
        F.col("entity").alias("series_id"), "ds", "y", lake.file_end_date(F.col("_file")).alias("through")
    )


@entry(
    "file_listing",
    f"""WITH {B.FACTS} SELECT CAST(make_date(year(ds), 12, 31) AS DATE) AS through, COUNT(*) AS n_rows FROM facts GROUP BY 1""",
)
def file_listing(spark, sf):
    """The batches that lie in a folder by name, and what each holds."""
    facts = stage(B.facts(spark, sf), "facts")
    root = shared_dir(spark, "batches")
    for (year,) in facts.select(F.year("ds").alias("y")).distinct().orderBy("y").collect():
        lake.write_csv(facts.where(F.year("ds") == year), lake.batch_path(root, "facts", f"{year}-01-01", f"{year}-12-31"))
    found = lake.list_files(spark, root, ".csv").select(lake.file_end_date(F.col("path")).alias("through")).distinct()
    rows = facts.groupBy(F.make_date(F.year("ds"), F.lit(12), F.lit(31)).alias("through")).agg(F.count("*").alias("n_rows"))
    return found.join(rows, "through", "left")


@entry(
    "json_snapshots",
    f"""WITH {B.FACTS}, l AS (SELECT series_id, MAX(ds) AS last_ds, COUNT(*) AS n_days FROM facts GROUP BY 1)
    SELECT series_id, last_ds, n_days, DATE '2001-08-01' AS run_date, 2 AS attempt FROM l
    UNION ALL SELECT series_id, last_ds, n_days, DATE '2001-08-02', 1 FROM l""",
)
def json_snapshots(spark, sf):
    """One JSON snapshot per run date, the last write of a date standing."""
    rows = stage(B.facts(spark, sf).groupBy("series_id").agg(F.max("ds").alias("last_ds"), F.count("*").alias("n_days")), "last")
    root = shared_dir(spark, "snapshots")
    for run_date, attempt in (("2001-08-01", 1), ("2001-08-01", 2), ("2001-08-02", 1)):
        lake.write_json(rows.withColumn("attempt", F.lit(attempt)), f"{root}/run_date={run_date}")
    return lake.read_json(spark, root, "series_id string, last_ds date, n_days long, attempt int, run_date date")


@entry(
    "dependent_feed",
    f"""WITH {B.FACTS},{B.WEATHER}, lead_day AS (SELECT MAX(ds) AS d FROM facts WHERE ds <= DATE '2000-06-30')
    SELECT ds, ROUND(temp, 9) AS temp FROM weather, lead_day WHERE ds > DATE '1999-12-31' AND ds <= lead_day.d""",
)
def dependent_feed(spark, sf):
    """A feed's next range, up to the watermark that its leader has stored."""
    log = shared_dir(spark, "feed-log")
    lead = B.facts(spark, sf).where(F.col("ds") <= day("2000-06-30")).agg(F.max("ds")).first()[0]
    lake.write_watermark(spark, log, "facts", 0, lead)
    lake.write_watermark(spark, log, "weather", 0, "1999-12-31")
    own, leader = (F.lit(lake.read_watermark(spark, log, f)) for f in ("weather", "facts"))
    first, last, open_ = lake.dependent_window(own, leader)
    rows = B.weather(spark, sf).where(open_ & F.col("ds").between(first, last))
    return rows.select("ds", F.round("temp", 9).alias("temp"))


@entry(
    "job_runs",
    f"""WITH {B.GOLD}, n AS (SELECT COUNT(*) AS g FROM gold), {B.FEATURES.split(B.GOLD + ',', 1)[1]},
    f AS (SELECT COUNT(*) AS x FROM features), s AS (SELECT COUNT(DISTINCT series_id) AS k FROM gold)
    SELECT 'gold' AS job, DATE '2001-08-01' AS run_date, 'success' AS status, CAST(g + x AS BIGINT) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM n, f
    UNION ALL SELECT 'gold', DATE '2001-08-02', 'skipped', NULL, NULL
    UNION ALL SELECT 'training', DATE '2001-08-01', 'success', CAST(2 * k AS BIGINT), NULL FROM s
    UNION ALL SELECT 'training', DATE '2001-08-02', 'failure', NULL, 'ValueError: missing required columns: [''temp'']'""",
)
def job_runs(spark, sf):
    """Scheduled jobs with snapshots and run records: repeated, with nothing to do, failing."""
    root = shared_dir(spark, "jobs")
    silver = B.silver(spark, sf)
    for _ in range(2):
        scheduled.build_gold(spark, root, "2001-08-01", silver)
    scheduled.build_gold(spark, root, "2001-08-02", silver.limit(0))
    daily = spark.read.parquet(f"{root}/gold_daily").drop("run_date")
    scheduled.train(spark, root, "2001-08-01", daily, n_trees=20)
    try:
        scheduled.train(spark, root, "2001-08-02", daily.drop("temp"))
    except ValueError:
        pass  # the run record tells
    runs = lake.read_runs(spark, f"{root}/run_log")
    return runs.select("job", "run_date", "status", F.col("rows").alias("n_rows"), "error")
