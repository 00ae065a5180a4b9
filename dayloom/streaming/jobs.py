"""Incremental jobs. Each is a streaming query that handles what is new and stops
(``availableNow``), so it can be scheduled like a batch; checkpoints hold the progress."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dayloom import settings as S
from dayloom.operators.panel import covered_days, join_covariates, latest_per_day, newer_than
from dayloom.session import exists, remove
from dayloom.sources.lake import read_watermark, write_partitions, write_watermark


def file_stream(spark: SparkSession, path: str, schema, pattern: str, files_per_batch: int = 1000):
    """Parquet files under a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all available input into a parquet folder and reads that back."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(path)


def daily_totals(events: DataFrame, dims: list[str], ts: str = "ts", value: str = "value",
                 lateness: str = "2 days") -> DataFrame:
    """Day × dimension totals of an event stream. A day comes out once the watermark has
    passed its end; later rows for it are dropped."""
    day = F.window(ts, "1 day")
    return (
        events.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, lateness)
        .groupBy(day.alias("_w"), *dims)
        .agg(F.sum(value).alias("y"), F.count("*").alias("n_rows"))
        .select(F.to_date("_w.start").alias("ds"), *dims, F.round("y", 6).alias("y"), "n_rows")
    )


def upsert_totals(events: DataFrame, dims: list[str], path: str, checkpoint: str, ts: str = "ts",
                  value: str = "value", lateness: str = "2 days") -> DataFrame:
    """Day totals with the open days: every batch writes the totals it changed as a version of its
    own, and the newest version of a total counts. A repeated batch replaces its version. State
    of a day goes when the watermark passes it; rows later than that are dropped."""
    totals = daily_totals(events, dims, ts, value, lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={batch_id}")

    query = (
        totals.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark = events.sparkSession
    schema = totals.schema.add("version", "long")
    stored = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    return newest_versions(stored, ["ds", *dims])


def newest_versions(rows: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """The newest version of each key, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, version)]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def thinned(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Drops repeats of a key inside each Arrow batch, before any shuffle. Keyed state has no
    map-side combine; without this, a key with a third of all rows goes to one task whole."""

    def first_of_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop_duplicates(keys)

    return rows.mapInPandas(first_of_batch, rows.schema)


def distinct_arrivals(events: DataFrame, keys: list[str], ts: str = "ts", lateness: str = "2 days"):
    """First arrival per key; state is dropped once the watermark passes."""
    return (
        thinned(events.withColumn(ts, F.col(ts).cast("timestamp")), keys)
        .withWatermark(ts, lateness)
        .dropDuplicatesWithinWatermark(keys)
    )


def gated(follower: DataFrame, leader: DataFrame, lateness: str, ts: str = "ds") -> DataFrame:
    """Rows of a feed with whether its leader has their day (``is_open``).

    A row waits for the leader and comes out when the leader's day arrives, however much later
    within ``lateness``; when the watermarks of both feeds have passed the day without it, the row
    comes out closed. Repeated days of the leader count once.
    """
    led = leader.select(F.col(ts).cast("timestamp").alias("_led")).withWatermark("_led", lateness)
    led = led.dropDuplicatesWithinWatermark(["_led"])
    rows = follower.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness)
    joined = rows.join(led, rows["_ts"] == led["_led"], "left_outer")
    return joined.withColumn("is_open", F.col("_led").isNotNull()).drop("_ts", "_led")


BATCH = "ingest_batch"
MONTH = "month"


def append_silver(
    spark: SparkSession,
    bronze: DataFrame,
    covariates: DataFrame,
    arrival: str,
    silver_path: str,
    checkpoint: str,
    late_days: int = 0,
    files_per_month: int = 1,
) -> None:
    """Bronze stream → silver table partitioned by month.

    Each batch keeps the days past the stored watermark (minus ``late_days``), joins the
    day's covariates and overwrites only the months it touches; rows already stored for these
    months stay, under the batch that brought them. The finished months are first written under the
    checkpoint, by batch. A batch repeated after a failure finds them there and only overwrites
    the same months again, however much of the table its first attempt had replaced.

    The watermark is kept in a log, an entry a batch; a batch reads the entries before its own, so
    repeating it gives the same. Of the table only months from the watermark's on are read. Where the log has
    no valid entry though the table is there, the table's newest day is taken, once.
    """
    folder = f"{checkpoint.rstrip('/')}/silver-batches"
    log = watermark_log(silver_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = f"{folder}/{batch_id}"
        before = read_watermark(spark, log, "silver", batch_id)
        if not exists(spark, f"{staged}/_SUCCESS"):
            _finished_days(batch, batch_id, before).write.mode("overwrite").parquet(staged)
        done = spark.read.parquet(staged)
        write_partitions(done, silver_path, MONTH, files_per_month)
        newest = done.agg(F.max("ds")).first()[0]
        if newest is not None:
            write_watermark(spark, log, "silver", batch_id, max(newest, before or newest))
        remove(spark, f"{folder}/{batch_id - 1}")

    def _finished_days(batch: DataFrame, batch_id: int, top: dt.date | None) -> DataFrame:
        stored = _stored(spark, silver_path)
        if stored is not None:
            stored = stored.where(F.col(BATCH) < batch_id)
            top = top or stored.agg(F.max("ds")).first()[0]
        floor = (top or dt.date.fromisoformat(S.NO_DATE)) - dt.timedelta(days=late_days if top else 0)
        fresh = newer_than(batch, F.lit(floor)).dropDuplicates()
        gated = latest_per_day(covered_days(covariates, fresh), F.col(arrival)).drop(arrival)
        rows = join_covariates(fresh, gated).withColumn(BATCH, F.lit(batch_id)).withColumn(MONTH, F.trunc("ds", "MM"))
        if stored is not None:
            touched = rows.select(MONTH).distinct()
            kept = stored.where(F.col(MONTH) >= F.lit(floor.replace(day=1))).join(touched, MONTH, "left_semi")
            rows = kept.unionByName(rows)
        values = [c for c in rows.columns if c != BATCH]
        return rows.groupBy(*values).agg(F.min(BATCH).alias(BATCH))

    (
        bronze.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def watermark_log(silver_path: str) -> str:
    """The log beside a table."""
    return f"{silver_path.rstrip('/')}_watermarks"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table under a path, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


TRIGGERS = "series_id string, ds date, action string"
_DAY_MS = 86_400_000
_EPOCH = dt.date(1970, 1, 1)


class Cooldown(StatefulProcessor):
    """Retrain state of one series: the days with a recommendation whose turn has not come, and the
    day of the last trigger."""

    def __init__(self, cooldown: int):
        self.cooldown = cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "day int", "known boolean")
        self.last = handle.getValueState("last", "day int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for day in frame["ds"].unique():
                number = (pd.Timestamp(day).date() - _EPOCH).days
                if not self.pending.containsKey((number,)):
                    self.pending.updateValue((number,), (True,))
                    self.handle.registerTimer((number + 1) * _DAY_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number = expiredTimerInfo.getExpiryTimeInMs() // _DAY_MS - 1
        self.pending.removeKey((number,))
        last = self.last.get()[0] if self.last.exists() else None
        fires = last is None or number - last >= self.cooldown
        if fires:
            self.last.update((number,))
        day = _EPOCH + dt.timedelta(days=number)
        yield pd.DataFrame({"series_id": [key[0]], "ds": [day], "action": ["trigger" if fires else "clear"]})

    def close(self) -> None:
        pass


def retrain_actions(reports: DataFrame, cooldown: int = S.COOLDOWN_DAYS, lateness: str = "0 days") -> DataFrame:
    """The retrain flag's history from a stream of daily reports (``series_id, ds, recommended``).

    A day's turn comes when the watermark has passed it, so reports may arrive in any order within
    ``lateness``. A recommended day triggers (the flag is written) unless the last trigger was less
    than ``cooldown`` days before; then the flag is cleared. Reports that recommend nothing only
    move the time on. One row a recommended day: ``series_id, ds, action``.
    """
    days = reports.withColumn("_ts", F.col("ds").cast("timestamp")).withWatermark("_ts", lateness)
    # a condition without the time column would be moved below the watermark, which then stands still
    wanted = F.when(F.col("_ts").isNotNull(), F.col("recommended") & F.col("series_id").isNotNull())
    return days.where(wanted).select("series_id", "ds", "_ts").groupBy("series_id").transformWithStateInPandas(
        Cooldown(cooldown), TRIGGERS, "append", "EventTime"
    )


def drain_state(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """``drain`` for operators with timers, which keep their state in RocksDB."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return drain(stream, path, checkpoint)
    finally:
        conf.set(key, before)


def retrain_flags(actions: DataFrame) -> DataFrame:
    """Where the flag stands after the newest action of each series, and since when."""
    newest = actions.groupBy("series_id").agg(
        F.max_by("action", "ds").alias("_a"), F.max("ds").alias("as_of"),
        F.max(F.when(F.col("action") == "trigger", F.col("ds"))).alias("last_trigger"),
    )
    return newest.select("series_id", "as_of", "last_trigger", (F.col("_a") == "trigger").alias("is_set"))
