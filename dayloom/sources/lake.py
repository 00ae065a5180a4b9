"""Files and tables of the lake. Explicit schemas, pruning by file date, and dynamic
partition overwrite, so a rerun replaces exactly the days it covers."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from dayloom import settings as S
from dayloom.session import exists

FACTS = StructType(
    [
        StructField("ds", DateType()),
        StructField("entity", StringType()),
        StructField("region", StringType()),
        StructField("y", DoubleType()),
    ]
)
COVARIATES = StructType(
    [
        StructField("ds", DateType()),
        StructField("temp", DoubleType()),
        StructField("precip", DoubleType()),
        StructField("snow", DoubleType()),
    ]
)


def file_end_date(name: Column) -> Column:
    """Last date in the name of a file or of the folder that its parts lie in,
    ``…_<start>_<end>.<ext>``; long ago if there is none."""
    text = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})[^_/]*(?:/part-[^/]*)?$", 1)
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.lit(S.NO_DATE).cast("date"))


def list_files(spark: SparkSession, path: str, extension: str) -> DataFrame:
    """Names of the files under a folder (no content is read)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{extension}")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )


def read_csv(
    spark: SparkSession, path: str, schema: StructType, newer_than: Column | None = None
) -> DataFrame:
    """CSV with a header, columns matched by name. ``newer_than`` skips whole files: the
    filter is on the file name, which Spark checks before it opens a file."""
    # Files whose header differs from the first one's are an error, not misread columns.
    options = {"header": True, "enforceSchema": False, "recursiveFileLookup": True}
    raw = spark.read.options(**options).csv(path)
    missing = {f.name for f in schema} - set(raw.columns)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    df = raw.select(
        *[F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in schema],
        F.col("_metadata.file_path").alias("_file"),
    )
    if newer_than is not None:
        df = df.where(file_end_date(F.col("_file")) > newer_than)
    return df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def batch_path(root: str, name: str, first: str, last: str) -> str:
    """Where a feed's batch of days lies; its name tells the days."""
    return f"{root.rstrip('/')}/{name}_{first}_{last}.csv"


WATERMARKS = "feed string, batch long, watermark string"


def write_watermark(spark: SparkSession, log: str, feed: str, batch: int, day: dt.date | str) -> None:
    """One entry per feed and batch; a repeated batch replaces its own."""
    row = spark.range(1).select(F.lit(str(day)).alias("watermark"))
    row.write.mode("overwrite").parquet(f"{log.rstrip('/')}/feed={feed}/batch={batch}")


def read_watermark(spark: SparkSession, log: str, feed: str, before: int | None = None) -> dt.date | None:
    """The newest valid entry of a feed, before a batch if that is given; None if there is none.
    Malformed entries are passed over. A plain value, so that a filter on it prunes partitions."""
    if not exists(spark, f"{log.rstrip('/')}/feed={feed}"):
        return None
    entries = spark.read.schema(WATERMARKS).parquet(log).where(F.col("feed") == feed)
    if before is not None:
        entries = entries.where(F.col("batch") < before)
    return entries.agg(F.max(F.try_to_date("watermark", "yyyy-MM-dd"))).first()[0]


def write_partitions(df: DataFrame, path: str, by: str, files_per_partition: int = 0) -> None:
    """Overwrites only the partitions present in ``df``. Rows go to writers by partition
    value; ``files_per_partition`` spreads a heavy value over that many tasks."""
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(F.col(by), salt)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_snapshot(df: DataFrame, path: str, run_date: Column) -> None:
    """One snapshot per run date; a second run on the same day replaces the first."""
    write_partitions(df.withColumn("run_date", run_date), path, "run_date")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def ingest_window(watermark: Column, as_of: Column, start: str = S.FEED_START,
                  lag_days: int = S.PUBLISH_LAG_DAYS) -> tuple[Column, Column, Column]:
    """First day, last day and whether there is anything to fetch."""
    first = F.coalesce(F.date_add(watermark, 1), F.lit(start).cast("date"))
    last = F.date_sub(as_of, lag_days)
    return first, last, (first <= last)


def dependent_window(own: Column, leader: Column, start: str = S.FEED_START):
    """A feed that may only run up to the watermark of another one."""
    gate = F.when(leader.isNull(), F.raise_error(F.lit("the leading feed has no watermark yet")))
    last = F.coalesce(gate.cast("date"), leader)
    first = F.coalesce(F.date_add(own, 1), F.lit(start).cast("date"))
    return first, last, (first <= last)


def fingerprint(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Order-free content hash of a table: equal rows give equal prints on any layout.
    Sums of row digests, so it is one map-side aggregate. Fields carry their length, so no two
    rows have one text; 120 bits of each digest are summed as decimals, which do not overflow."""

    def field(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    digest = F.md5(F.concat(*[field(c) for c in columns]))
    parts = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16)]
    sums = [F.sum(p).cast("string") for p in parts]
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.concat_ws("-", *sums).alias("digest"))


RUN_LOG = "job string, run_date date, status string, duration_seconds double, error string, rows long"


def log_run(
    spark: SparkSession, log: str, job: str, run_date: str, status: str, seconds: float,
    error: str | None = None, rows: int | None = None, **extra: str,
) -> None:
    """The run record of a job and date; a second run of the same date replaces the first."""
    row = spark.range(1).select(
        F.lit(status).alias("status"), F.lit(float(seconds)).alias("duration_seconds"),
        F.lit(error).cast("string").alias("error"), F.lit(rows).cast("long").alias("rows"),
        *[F.lit(v).alias(k) for k, v in extra.items()],
    )
    row.write.mode("overwrite").parquet(f"{log.rstrip('/')}/job={job}/run_date={run_date}")


def read_runs(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(log)


def run_job(
    spark: SparkSession, root: str, job: str, run_date: str, make: Callable[[], dict[str, DataFrame] | None]
) -> str:
    """Runs a job, publishes what it made and writes its run record.

    ``make`` returns tables by name, or None when there is nothing to do (status ``skipped``). Each
    is published as the snapshot of ``run_date`` under ``root/<name>``; a failure is recorded and
    raised again, and its snapshots are those of the tables finished before it. Everything is
    addressed by name and date, so a repeated run replaces its own snapshots and record and
    nothing else.
    """
    began, status, error, rows = time.monotonic(), "success", None, None
    try:
        made = make()
        if made is None:
            status = "skipped"
        else:
            rows = 0
            for name, table in made.items():
                path = f"{root.rstrip('/')}/{name}"
                table.drop("run_date").write.mode("overwrite").parquet(f"{path}/run_date={run_date}")
                rows += spark.read.parquet(f"{path}/run_date={run_date}").count()
    except Exception as e:
        status, error = "failure", f"{type(e).__name__}: {e}"[:1000]
        raise
    finally:
        log_run(spark, f"{root.rstrip('/')}/run_log", job, run_date, status, time.monotonic() - began, error, rows)
    return status
