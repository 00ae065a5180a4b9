import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from dayloom.operators.monitor import trigger_dates
from dayloom.operators.panel import merge_silver
from dayloom.sources import lake
from dayloom.streaming import jobs

D = dt.date
FACTS = "ds date, series_id string, y double"
DIM = "ds date, temp double, arrival int"


def put(spark, path, rows, schema=FACTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def silver_rows(spark, path):
    return sorted((str(r.ds), r.series_id, r.y, r.temp) for r in spark.read.parquet(path).collect())


def test_bronze_to_silver_in_steps_equals_one_pass(spark, tmp_path):
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    dim = spark.createDataFrame(
        [(D(2025, 1, d), float(d), 1) for d in range(1, 9)] + [(D(2025, 1, 2), 22.0, 2)], DIM
    )

    def step():
        schema = "ds date, series_id string, y double"
        stream = jobs.file_stream(spark, bronze, schema, "*.parquet")
        jobs.append_silver(spark, stream, dim, "arrival", silver, ck)

    put(spark, bronze, [(D(2025, 1, 1), "a", 1.0), (D(2025, 1, 2), "a", 2.0), (D(2025, 1, 2), "a", 2.0)])
    step()
    assert silver_rows(spark, silver) == [("2025-01-01", "a", 1.0, 1.0), ("2025-01-02", "a", 2.0, 22.0)]
    # A late row for a closed day is dropped; newer days come in.
    put(spark, bronze, [(D(2025, 1, 2), "b", 5.0), (D(2025, 1, 3), "b", 3.0)])
    step()
    step()
    assert silver_rows(spark, silver) == [
        ("2025-01-01", "a", 1.0, 1.0), ("2025-01-02", "a", 2.0, 22.0), ("2025-01-03", "b", 3.0, 3.0),
    ]


def test_late_days_reopen_recent_days(spark, tmp_path):
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    dim = spark.createDataFrame([(D(2025, 1, d), float(d), 1) for d in range(1, 9)], DIM)

    def step():
        stream = jobs.file_stream(spark, bronze, FACTS, "*.parquet")
        jobs.append_silver(spark, stream, dim, "arrival", silver, ck, late_days=1)

    put(spark, bronze, [(D(2025, 1, 1), "a", 1.0), (D(2025, 1, 2), "a", 2.0)])
    step()
    put(spark, bronze, [(D(2025, 1, 2), "b", 5.0), (D(2025, 1, 1), "b", 9.0), (D(2025, 1, 3), "a", 3.0)])
    step()
    assert silver_rows(spark, silver) == [
        ("2025-01-01", "a", 1.0, 1.0), ("2025-01-02", "a", 2.0, 2.0),
        ("2025-01-02", "b", 5.0, 2.0), ("2025-01-03", "a", 3.0, 3.0),
    ]


def test_a_repeated_batch_writes_the_same_days(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    dim = spark.createDataFrame([(D(2025, 1, d), float(d), 1) for d in range(1, 9)], DIM)
    put(spark, bronze, [(D(2025, 1, 1), "a", 1.0), (D(2025, 1, 2), "a", 2.0)])
    for attempt in range(2):  # a lost checkpoint commit: the same batch id comes again
        stream = jobs.file_stream(spark, bronze, FACTS, "*.parquet")
        jobs.append_silver(spark, stream, dim, "arrival", silver, str(tmp_path / f"ck{attempt}"))
    assert len(silver_rows(spark, silver)) == 2


def test_a_repeated_batch_keeps_stored_rows_of_reopened_days(spark, tmp_path):
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    dim = spark.createDataFrame([(D(2025, 1, d), float(d), 1) for d in range(1, 9)], DIM)

    def step():
        stream = jobs.file_stream(spark, bronze, FACTS, "*.parquet")
        jobs.append_silver(spark, stream, dim, "arrival", silver, ck, late_days=3)

    put(spark, bronze, [(D(2025, 1, 4), "a", 5.0), (D(2025, 1, 5), "a", 6.0)])
    step()
    put(spark, bronze, [(D(2025, 1, 4), "b", 7.0), (D(2025, 1, 6), "a", 8.0)])
    step()
    want = silver_rows(spark, silver)
    assert [r[:3] for r in want] == [
        ("2025-01-04", "a", 5.0), ("2025-01-04", "b", 7.0), ("2025-01-05", "a", 6.0), ("2025-01-06", "a", 8.0),
    ]
    last = max(int(p.name) for p in (tmp_path / "ck" / "commits").iterdir() if p.name.isdigit())
    for p in list((tmp_path / "ck" / "commits").iterdir()):  # the commit of the last batch is lost
        if p.name in (str(last), f".{last}.crc"):
            p.unlink()
    step()
    assert silver_rows(spark, silver) == want
    put(spark, bronze, [(D(2025, 1, 4), "c", 9.0)])
    step()
    assert silver_rows(spark, silver) == sorted([*want, ("2025-01-04", "c", 9.0, 4.0)])


def test_daily_totals_equal_the_batch_for_closed_days(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [(dt.datetime(2025, 1, 1 + i // 4, 3 * (i % 4)), "k", float(i)) for i in range(40)]
    put(spark, src, rows, "ts timestamp_ntz, kind string, value double")
    stream = jobs.file_stream(spark, src, "ts timestamp_ntz, kind string, value double", "*.parquet")
    out = jobs.drain(jobs.daily_totals(stream, ["kind"]), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {r.ds: r.y for r in out.collect()}
    want = {}
    for ts, _, v in rows:
        want[ts.date()] = want.get(ts.date(), 0) + v
    assert got == {d: v for d, v in want.items() if d <= D(2025, 1, 7)}


def test_distinct_arrivals_across_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "o", "c"))
    schema = "ts timestamp, name string"
    for _ in range(2):
        put(spark, src, [(dt.datetime(2025, 1, 1, h), n) for h in range(3) for n in "ab"], schema)
        stream = jobs.file_stream(spark, src, schema, "*.parquet")
        got = jobs.drain(jobs.distinct_arrivals(stream, ["name"]), out, ck)
    assert sorted(r.name for r in got.collect()) == ["a", "b"]


def test_open_days_come_out_and_repeats_replace(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "o", "c"))
    schema = "ts timestamp_ntz, kind string, value double"
    rows = [(dt.datetime(2025, 1, 1 + i // 4, 3 * (i % 4)), "ab"[i % 2], float(i)) for i in range(40)]
    want = {}
    for part in (rows[:17], rows[17:30], [], rows[30:]):
        if part:
            put(spark, src, part, schema)
        for ts, kind, v in part:
            want[ts.date(), kind] = want.get((ts.date(), kind), 0) + v
        stream = jobs.file_stream(spark, src, schema, "*.parquet")
        got = jobs.upsert_totals(stream, ["kind"], out, ck)
        assert {(r.ds, r.kind): r.y for r in got.collect()} == want
    last = max(int(p.name) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    for p in list((tmp_path / "c" / "commits").iterdir()):  # the commit of the last batch is lost
        if p.name in (str(last), f".{last}.crc"):
            p.unlink()
    stream = jobs.file_stream(spark, src, schema, "*.parquet")
    assert {(r.ds, r.kind): r.y for r in jobs.upsert_totals(stream, ["kind"], out, ck).collect()} == want


REPORTS = "series_id string, ds date, recommended boolean"


def test_retrain_state_equals_the_replay_in_any_order(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "o", "c"))
    days = {"a": [1, 2, 8, 9, 14, 20], "b": [3, 9, 11, 28]}
    rows = [(s, D(2025, 1, d), d in ds) for s, ds in days.items() for d in range(1, 29)]
    rows += rows[:9]
    # shuffled over files, a week late at most: the parts are weeks, each in any order
    for low, high in ((15, 21), (1, 8), (8, 15), (21, 29)):
        put(spark, src, [r for r in rows if low <= r[1].day < high][::-1], REPORTS)
    put(spark, src, [(None, D(2025, 2, 20), False)], REPORTS)
    stream = jobs.file_stream(spark, src, REPORTS, "*.parquet", files_per_batch=1)
    got = jobs.drain_state(jobs.retrain_actions(stream, lateness="21 days"), out, ck)
    fired = sorted((r.series_id, r.ds) for r in got.collect() if r.action == "trigger")
    want = trigger_dates(
        spark.createDataFrame([r[:2] for r in rows if r[2]], "series_id string, ds date")
    )
    assert got.count() == sum(map(len, days.values()))
    assert fired == sorted(map(tuple, want.collect()))
    # a: 1, 8 and 20 fire, 2, 9 and 14 clear; b: 3, 11 and 28 fire, 9 clears
    flags = {r.series_id: (r.is_set, r.last_trigger.day) for r in jobs.retrain_flags(got).collect()}
    assert flags == {"a": (True, 20), "b": (True, 28)}


def test_watermark_log(spark, tmp_path):
    log = str(tmp_path / "log")
    assert lake.read_watermark(spark, log, "facts") is None
    lake.write_watermark(spark, log, "facts", 0, "2025-06-15")
    lake.write_watermark(spark, log, "other", 5, "2026-01-01")
    lake.write_watermark(spark, log, "facts", 1, "not-a-date")
    assert lake.read_watermark(spark, log, "facts") == D(2025, 6, 15)
    lake.write_watermark(spark, log, "facts", 2, "2025-07-01")
    lake.write_watermark(spark, log, "facts", 2, "2025-07-02")
    assert lake.read_watermark(spark, log, "facts") == D(2025, 7, 2)
    assert lake.read_watermark(spark, log, "facts", before=2) == D(2025, 6, 15)
    assert lake.read_watermark(spark, log, "none") is None


def test_a_lost_log_falls_back_to_the_table_and_plans_prune(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    dim = spark.createDataFrame([(D(2025, 1, d), float(d), 1) for d in range(1, 9)], DIM)

    def step(ck):
        stream = jobs.file_stream(spark, bronze, FACTS, "*.parquet")
        jobs.append_silver(spark, stream, dim, "arrival", silver, str(tmp_path / ck))

    put(spark, bronze, [(D(2025, 1, 1), "a", 1.0), (D(2025, 1, 2), "a", 2.0)])
    step("ck")
    log = jobs.watermark_log(silver)
    assert lake.read_watermark(spark, log, "silver") == D(2025, 1, 2)
    lake.write_watermark(spark, log, "silver", 0, "lost")
    put(spark, bronze, [(D(2025, 1, 2), "b", 9.0), (D(2025, 1, 3), "a", 3.0)])
    step("ck")
    assert [r[:3] for r in silver_rows(spark, silver)] == [
        ("2025-01-01", "a", 1.0), ("2025-01-02", "a", 2.0), ("2025-01-03", "a", 3.0)]
    assert lake.read_watermark(spark, log, "silver") == D(2025, 1, 3)
    stored = spark.read.parquet(silver)
    merged = merge_silver(stored.drop("temp", "ingest_batch"), stored.select("ds", "series_id", "y", "month"), dim,
                          F.col("arrival"), watermark=D(2025, 1, 2))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[IsNotNull\(ds\), GreaterThan\(ds,2025-01-02\)\]", plan)


def test_job_wrapper_publishes_once_and_logs_failures(spark, tmp_path):
    root = str(tmp_path)
    table = spark.range(3)
    for n in (2, 3):
        assert lake.run_job(spark, root, "gold", "2025-01-02", lambda n=n: {"gold": table.limit(n)}) == "success"
    assert lake.run_job(spark, root, "gold", "2025-01-03", lambda: None) == "skipped"

    def broken():
        raise ValueError("no rows")

    with pytest.raises(ValueError):
        lake.run_job(spark, root, "train", "2025-01-03", broken)
    runs = {(r.job, str(r.run_date)): (r.status, r.rows, r.error) for r in lake.read_runs(spark, f"{root}/run_log").collect()}
    assert runs == {
        ("gold", "2025-01-02"): ("success", 3, None), ("gold", "2025-01-03"): ("skipped", None, None),
        ("train", "2025-01-03"): ("failure", None, "ValueError: no rows"),
    }
    assert spark.read.parquet(f"{root}/gold").count() == 3


def test_a_feed_waits_for_its_leader(spark, tmp_path):
    feed, lead, out, ck = (str(tmp_path / n) for n in ("feed", "lead", "o", "c"))

    def step():
        f = jobs.file_stream(spark, feed, "ds date, temp double", "*.parquet")
        l = jobs.file_stream(spark, lead, "ds date", "*.parquet")  # noqa: E741
        got = jobs.drain(jobs.gated(f, l, "3 days"), out, ck)
        return sorted((r.ds.day, r.is_open) for r in got.collect())

    put(spark, feed, [(D(2025, 1, d), 1.0) for d in (1, 2, 3)], "ds date, temp double")
    put(spark, lead, [(D(2025, 1, 1),), (D(2025, 1, 1),)], "ds date")
    assert step() == [(1, True)]
    put(spark, lead, [(D(2025, 1, 3),)], "ds date")  # late; the 2nd never comes
    assert step() == [(1, True), (3, True)]
    put(spark, feed, [(D(2025, 1, 20), 1.0)], "ds date, temp double")
    put(spark, lead, [(D(2025, 1, 20),)], "ds date")
    assert step() == [(1, True), (2, False), (3, True), (20, True)]
