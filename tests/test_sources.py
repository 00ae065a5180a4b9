import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dayloom.session import shared_dir, stage
from dayloom.sources import feeds, lake

D = dt.date


def test_end_date_of_file_names(spark):
    names = {
        "feed_2025-01-01_2026-01-29.csv": D(2026, 1, 29),
        "no_date_here.csv": D(1900, 1, 1),
        "": D(1900, 1, 1),
        "x_2025-99-99.csv": D(1900, 1, 1),
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.d for r in df.select("n", lake.file_end_date(F.col("n")).alias("d")).collect()}
    assert got == names


def test_csv_scan_prunes_files_and_checks_columns(spark, tmp_path):
    (tmp_path / "w_2025-01-01_2025-01-02.csv").write_text("ds,temp,precip,snow,icon\n2025-01-01,1,0,0,a\n2025-01-02,bad,0,0,b\n")
    (tmp_path / "w_2025-01-03_2025-01-04.csv").write_text("ds,temp,precip,snow,icon\n2025-01-03,3,0,0,a\n2025-01-04,4,0,0,b\n")
    df = lake.read_csv(spark, str(tmp_path), lake.COVARIATES)
    assert df.count() == 4 and df.where("temp is null").count() == 1 and "icon" not in df.columns
    newer = lake.read_csv(spark, str(tmp_path), lake.COVARIATES, F.lit("2025-01-02").cast("date"))
    assert newer.count() == 2
    assert lake.list_files(spark, str(tmp_path), ".csv").count() == 2
    with pytest.raises(ValueError, match="region"):
        lake.read_csv(spark, str(tmp_path), lake.FACTS)


def test_overwriting_a_day_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D(2025, 1, 1), 1.0), (D(2025, 1, 2), 2.0)], "ds date, y double")
    lake.write_partitions(df, path, "ds", files_per_partition=3)
    again = spark.createDataFrame([(D(2025, 1, 2), 5.0)], "ds date, y double")
    lake.write_partitions(again, path, "ds")
    assert sorted(r.y for r in spark.read.parquet(path).collect()) == [1.0, 5.0]
    snap = str(tmp_path / "s")
    for v in (1.0, 2.0):
        lake.write_snapshot(spark.createDataFrame([(v,)], "y double"), snap, F.lit("2025-01-01").cast("date"))
    assert [r.y for r in spark.read.parquet(snap).collect()] == [2.0]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, [("a", 0.5)])], "id int, psi array<struct<f:string,v:double>>")
    lake.write_json(df, str(tmp_path / "j"))
    assert lake.read_json(spark, str(tmp_path / "j"), df.schema).collect() == df.collect()
    flat = spark.createDataFrame([(D(2025, 1, 1), 1.0, 2.0, 0.0)], lake.COVARIATES)
    lake.write_csv(flat, str(tmp_path / "c"))
    assert lake.read_csv(spark, str(tmp_path / "c"), lake.COVARIATES).drop("_file").collect() == flat.collect()
    staged = stage(flat, "staged")
    assert staged.collect() == flat.collect()
    assert shared_dir(spark, "a") != shared_dir(spark, "a")


def test_windows(spark):
    def run(wm, as_of="2025-06-20"):
        first, last, work = lake.ingest_window(F.lit(wm).cast("date"), F.lit(as_of).cast("date"))
        return tuple(spark.range(1).select(first, last, work).first())

    assert run("2025-06-01") == (D(2025, 6, 2), D(2025, 6, 14), True)
    assert run("2025-06-14") == (D(2025, 6, 15), D(2025, 6, 14), False)
    assert run(None)[0] == D(2022, 1, 1)
    first, last, work = lake.dependent_window(F.lit("2025-06-01").cast("date"), F.lit("2025-06-10").cast("date"))
    assert tuple(spark.range(1).select(first, last, work).first()) == (D(2025, 6, 2), D(2025, 6, 10), True)
    first, last, work = lake.dependent_window(F.lit(None).cast("date"), F.col("d"))
    with pytest.raises(Exception, match="watermark"):
        spark.createDataFrame([(None,)], "d date").select(last).collect()


def test_fingerprint_ignores_layout_but_not_content(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "a int, b string")
    base = lake.fingerprint(df, ["a", "b"]).first()
    assert lake.fingerprint(df.orderBy(F.desc("a")).repartition(5), ["a", "b"]).first() == base
    other = df.withColumn("b", F.when(F.col("a") == 3, "x").otherwise(F.col("b")))
    assert lake.fingerprint(other, ["a", "b"]).first().digest != base.digest
    sides = spark.createDataFrame([("x|", "y"), ("x", "|y"), ("-", None), (None, "-")], "a string, b string")
    prints = [lake.fingerprint(sides.limit(4).where(F.col("a").eqNullSafe(r.a) & F.col("b").eqNullSafe(r.b)), ["a", "b"]).first() for r in sides.collect()]
    assert len({p.digest for p in prints}) == 4


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    lake.log_run(spark, path, "training", "2025-01-01", "success", 1.5, champion="linear")
    lake.log_run(spark, path, "training", "2025-01-02", "failure", 2.0, error="boom", champion="linear")
    rows = spark.read.parquet(path).orderBy("run_date").collect()
    assert [(r.status, r.error) for r in rows] == [("success", None), ("failure", "boom")]


def test_boundary_split(spark):
    schema = "ds date, y double"
    old = spark.createDataFrame([(D(2024, 12, 30), 1.0), (D(2025, 1, 5), 99.0)], schema)
    new = spark.createDataFrame([(D(2024, 12, 30), 98.0), (D(2025, 1, 5), 2.0)], schema)

    def read(a, b):
        df = feeds.split_at_boundary(old, new, F.lit(a).cast("date"), F.lit(b).cast("date"))
        return sorted(r.y for r in df.collect())

    assert read("2024-12-01", "2025-02-01") == [1.0, 2.0]
    assert read("2024-12-01", "2024-12-31") == [1.0]
    assert read("2025-01-01", "2025-02-01") == [2.0]


def test_pages_cover_everything_once(spark):
    df = spark.createDataFrame([(1, str(i)) for i in range(25)], "d int, k string")
    seen = [r.k for o in range(0, 30, 10) for r in feeds.page(df, ["d", "k"], 10, o).collect()]
    assert sorted(seen) == sorted(str(i) for i in range(25))


def test_listing_and_fallback(spark):
    doc = json.dumps({"_embedded": {"events": [{"name": "A", "dates": {"start": {"localDate": "2025-01-01"}}}, {"name": None}]}})
    docs = spark.createDataFrame([("hall", doc), ("hall", "{}")], "venue string, body string")
    rows = feeds.flatten_listing(docs, "body", "venue", "main")
    assert sorted((r.name, r.date) for r in rows.collect()) == [("", ""), ("A", "2025-01-01")]
    permits = feeds.flatten_permits(
        spark.createDataFrame(
            [("X", "t", "2025-02-03T10:00", None), (None, "t", None, "park"), (None, None, None, None)],
            "event_name string, event_type string, start_date_time string, event_location string",
        ),
        "second",
    )
    assert [(r.name, r.date, r.venue) for r in permits.collect()] == [("X", "2025-02-03", ""), ("t", "", "park"), ("Event", "", "")]
    main = rows.drop("seq")
    assert {r.source for r in feeds.with_fallback(main, permits).collect()} == {"main"}
    assert {r.source for r in feeds.with_fallback(main.where("false"), permits).collect()} == {"second"}


def test_pages_by_seeking_and_by_ranges(spark):
    rows = [(None, 3), (None, 1), *[(i // 4, i) for i in range(50)]]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got, after = [], None
    while True:
        page = [tuple(r) for r in feeds.seek_page(df, ["a", "b"], 7, after).collect()]
        if not page:
            break
        got.append(page)
        after = page[-1]
    assert [r for page in got for r in page] == order and all(len(p) == 7 for p in got[:-1])
    paged = feeds.paged(df, ["a", "b"], 7, partitions=4).collect()
    assert sorted((r.page, r.a is not None, r.a or 0, r.b) for r in paged) == [
        (i // 7, a is not None, a or 0, b) for i, (a, b) in enumerate(order)
    ]
