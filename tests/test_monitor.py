import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from dayloom.operators import monitor as M
from dayloom.operators import registry as RG
from dayloom.operators import reports as R

D = dt.date


def psi(df, *features):
    return {(r.series_id, r.feature): r.psi for r in M.psi_scores(df, list(features)).collect()}


def index(reference, recent):
    """Population stability index of two lists of counts, from its definition on shares."""
    total = 0.0
    for a, b in zip(reference, recent, strict=True):
        p, q = (a + 1e-8) / sum(reference), (b + 1e-8) / sum(recent)
        total += q * math.log(q / p) - p * math.log(q / p)
    return total


def test_psi_of_counted_deciles(make_panel):
    # 90 reference days with the values 0…89: nine to each tenth. The 14 recent days are dealt
    # by hand: seven in the lowest tenth, four in the middle, three above all.
    recent = [1, 2, 3, 4, 5, 6, 7, 41, 42, 43, 44, 95, 96, 97]
    values = [50.5] * 20 + list(range(90)) + recent
    df = make_panel({"a": [1.0] * 124}, u=lambda i: float(values[i]))
    want = index([9] * 10, [7, 0, 0, 0, 4, 0, 0, 0, 0, 3])
    assert psi(df, "u")[("a", "u")] == pytest.approx(want, rel=1e-9)
    even = make_panel({"a": [1.0] * 104}, u=lambda i: float(i % 90))
    assert psi(even, "u")[("a", "u")] == pytest.approx(index([9] * 10, [9, 5, *[0] * 8]), rel=1e-9)


def test_psi_edge_cases(make_panel):
    flat = make_panel({"a": [1.0] * 120}, u=lambda i: 5.0)
    assert psi(flat, "u")[("a", "u")] == pytest.approx(0.0, abs=1e-6)
    moved = make_panel({"a": [1.0] * 120}, u=lambda i: 5.0 if i < 106 else 9.0)
    assert psi(moved, "u")[("a", "u")] < 0.1
    shift = make_panel({"a": [1.0] * 120}, u=lambda i: float(i % 10) + (0 if i < 106 else 80))
    assert psi(shift, "u")[("a", "u")] > 0.25
    assert psi(make_panel({"a": [1.0] * 103}), "temp") == {}


@pytest.mark.parametrize("score,want", [(0.3, "critical"), (0.25, "moderate"), (0.1, "stable"), (0.05, "stable")])
def test_status(spark, score, want):
    from dayloom.functions.errors import psi_status

    assert spark.range(1).select(psi_status(F.lit(score))).first()[0] == want


def forecasts(spark, rows):
    return spark.createDataFrame(rows, "series_id string, run_date date, ds date, ensemble double")


def test_live_errors_use_newest_runs_and_past_days(spark):
    actual = spark.createDataFrame(
        [("s", D(2025, 1, d), 3_000_000.0) for d in range(1, 20)], "series_id string, ds date, y double"
    )
    rows = [("s", D(2025, 1, 1 + r), D(2025, 1, 1 + r + h), 3.5) for r in range(10) for h in range(2)]
    out = M.live_errors(forecasts(spark, rows), actual, F.lit("2025-01-10").cast("date"))
    got = out.collect()
    assert {r.run_date for r in got} == {D(2025, 1, d) for d in range(3, 10)}
    assert all(r.ds < D(2025, 1, 10) for r in got)
    assert {r.horizon for r in got} == {1, 2}
    assert all(r.error == 0.5 for r in got)
    m = M.live_metrics(out).first()
    assert m.n_evaluated == 13 and m.rolling_mae == 0.5
    assert m.rolling_mape_pct == pytest.approx(0.5 / 3 * 100)


def decide(spark, live_mae, train_mae, trigger=None, psi=9.0):
    today = F.lit("2025-06-10").cast("date")
    live = spark.createDataFrame(
        [("s", 5, live_mae)] if live_mae is not None else [], "series_id string, n_evaluated long, rolling_mae double"
    )
    base = spark.createDataFrame([("s", train_mae)], "series_id string, training_mae double")
    drift = spark.createDataFrame([("s", psi, "critical")], "series_id string, max_psi double, psi_status string")
    fired = spark.createDataFrame([("s", trigger)] if trigger else [], "series_id string, trigger_date date")
    r = M.retrain_decision(live, base, drift, fired, today).first()
    return r.retrain_recommended, r.cooldown_active, r.retrain_triggered


def test_retrain_rules(spark):
    assert decide(spark, 1.0, 0.5) == (1, 0, 1)
    assert decide(spark, 0.75, 0.5) == (0, 0, 0)
    assert decide(spark, None, 0.5) == (0, 0, 0)
    assert decide(spark, 0.5, None) == (0, 0, 0)


@pytest.mark.parametrize("days,want", [(6, (1, 1, 0)), (7, (1, 0, 1)), (8, (1, 0, 1))])
def test_cooldown_edges(spark, days, want):
    assert decide(spark, 1.0, 0.5, D(2025, 6, 10) - dt.timedelta(days=days)) == want


def test_trigger_replay(spark):
    days = [1, 2, 7, 8, 9, 15, 30]
    df = spark.createDataFrame([("s", D(2025, 1, d)) for d in days], "series_id string, ds date")
    got = sorted(r.trigger_date.day for r in M.trigger_dates(df).collect())
    assert got == [1, 8, 15, 30]
    assert sorted(r.trigger_date.day for r in M.trigger_dates(df, keep=2).collect()) == [15, 30]


def test_snapshots(spark):
    df = spark.createDataFrame([(D(2025, 1, d), d) for d in (1, 1, 5, 9)], "run_date date, v int")
    assert M.latest_snapshots(df, 2).count() == 2
    assert M.newest_snapshot(df).first().v == 9


RUNS = "model string, version int, stage string, mae double, run_id string"


def test_gate_cases(spark):
    rows = [
        ("first", 1, "None", 0.4, "a"),
        ("better", 1, "Production", 0.5, "b"), ("better", 2, "None", 0.4, "c"),
        ("worse", 1, "Production", 0.3, "d"), ("worse", 2, "None", 0.4, "e"),
        ("equal", 1, "Production", 0.4, "f"), ("equal", 2, "None", 0.4, "g"),
        ("same", 1, "None", 0.9, "h"), ("same", 2, "Production", 0.4, "i"),
        ("blank", 1, "Production", 0.4, "j"), ("blank", 2, "None", None, "k"),
    ]
    gate = RG.promotion_gate(spark.createDataFrame(rows, RUNS))
    got = {r.model: (r.decision, r.serving_version) for r in gate.collect()}
    assert got == {
        "first": ("first", 1), "better": ("promoted", 2), "worse": ("kept", 1), "equal": ("kept", 1),
        "same": ("unchanged", 2), "blank": ("kept", 1),
    }


def test_champion_ties_and_zero(spark):
    def pick(a, b):
        rows = [("linear", 1, "None", a, "x"), ("trees", 1, "None", b, "y")]
        gate = RG.promotion_gate(spark.createDataFrame(rows, RUNS)).withColumn("series", F.lit("s"))
        return RG.champion(gate, ["series"], F.col("model")).first().champion

    assert pick(0.2, 0.3) == "linear" and pick(0.3, 0.2) == "trees" and pick(0.2, 0.2) == "linear"
    assert pick(0.0, None) == "linear" and pick(None, 0.5) == "trees"


def test_run_status_and_lag(spark):
    log = spark.createDataFrame(
        [("training", D(2025, 1, 1), "failure"), ("training", D(2025, 2, 1), "success"), ("ingestion", D(2025, 1, 5), "odd")],
        "job string, run_date date, status string",
    )
    out = M.run_status(log, F.lit("2025-01-30").cast("date"), F.lit("2025-02-05").cast("date"))
    got = {r.job: (r.badge, r.lag_days) for r in out.collect()}
    assert got == {"training": ("ok", 6), "ingestion": ("unknown", 6)}


def test_report_tables(spark, make_panel):
    panel = make_panel({"a": [float(i) for i in range(100)]})
    fc = spark.createDataFrame(
        [("a", D(2025, 4, 16) + dt.timedelta(days=i), float(i)) for i in range(14)], "series_id string, ds date, m double"
    )
    chart = R.forecast_chart(panel, fc, ["m"])
    assert chart.where("line = 'actual'").count() == 90 and chart.where("line = 'm'").count() == 15
    assert R.forward_total(fc, "m").first().total == sum(range(7, 14))
    lag = R.data_lag(panel, F.lit("2025-04-20").cast("date")).first()
    assert (lag.lag_days, lag.midpoint) == (5, D(2025, 4, 17))
    bt = spark.createDataFrame([("a", 0.2, 0.4)], "series_id string, ensemble_mae double, seasonal_naive_mae double")
    ho = spark.createDataFrame([("a", 9.0, 9.0), ("b", 0.3, 0.6)], bt.schema)
    got = {r.series_id: (r.source, r.skill_pct) for r in R.accuracy_view(bt, ho).collect()}
    assert got == {"a": ("walk-forward", 50.0), "b": ("holdout", 50.0)}
