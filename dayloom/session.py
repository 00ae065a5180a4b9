"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "dayloom", shuffle: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster, use the one that is given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


_LOCAL_ROOTS: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a
    cluster the setting is required, since executors do not share local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _LOCAL_ROOTS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="dayloom-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back. Cuts the lineage
    where several branches need the same table, so its inputs are scanned once; the files
    survive the loss of an executor."""
    return store(df, name)[0]


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``stage``, with the folder: a large one may go as soon as nothing reads it any more."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(spark: SparkSession, rows: int) -> None:
    """Sends at most so many rows to Python at once, from now on in this session; a lower limit
    stays. Both sides of the exchange hold a whole batch, so that of texts should be small."""
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _path(spark, path)
    return files.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate results; one that is not there is no error."""
    found, files = _path(spark, path)
    files.delete(found, True)
