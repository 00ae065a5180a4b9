import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.functions import errors as E
from dayloom.operators import backtest as BT
from dayloom.operators import forecast as FC


@pytest.fixture()
def cases(spark):
    """Four origins of three steps: a is perfect, b is half a unit too high."""
    rows = [
        ("s", i, [float(i + h) for h in range(3)], [float(i + h) for h in range(3)], [i + h + 0.5 for h in range(3)])
        for i in range(1, 5)
    ]
    df = spark.createDataFrame(
        rows, "series_id string, i int, actual array<double>, a array<double>, b array<double>"
    )
    df = df.withColumn("origin", F.date_add(F.lit("2025-01-01").cast("date"), F.col("i"))).drop("i")
    return df.withColumn("ensemble", FC.blend_arrays(F.col("a"), F.col("b")))


def test_score_table_and_best_weight(cases):
    scores = {r.model: r for r in BT.score(FC.to_long(cases, ["a", "b", "ensemble"])).collect()}
    assert [scores[m].mae for m in ("a", "b", "ensemble")] == [0.0, 0.5, 0.25]
    assert scores["b"].bias == 0.5 and scores["b"].n_points == 12
    curve = BT.weight_curve(FC.to_wide(cases, ["a", "b"]), "a", "b")
    assert curve.count() == 21
    best = BT.best_weight(curve).first()
    assert (best.best_weight, best.best_mae) == (1.0, 0.0)


def test_equal_models_give_the_first_weight(cases):
    same = cases.withColumn("b", F.col("a"))
    best = BT.best_weight(BT.weight_curve(FC.to_wide(same, ["a", "b"]), "a", "b")).first()
    assert best.best_weight == 0.0


def test_relative_mae(cases):
    s = BT.relative_mae(BT.score(FC.to_long(cases, ["a", "b", "ensemble"])), naive="b")
    assert {r.model: r.mase for r in s.collect()} == {"a": 0.0, "b": 1.0, "ensemble": 0.5}
    zero = BT.relative_mae(BT.score(FC.to_long(cases, ["a", "b"])), naive="a")
    assert {r.model: r.mase for r in zero.collect()} == {"a": 1.0, "b": None}


def test_bootstrap_of_identical_and_shifted_models(cases):
    same = BT.block_bootstrap(cases.withColumn("b", F.col("a")), [("a", "b")], 50).first()
    assert (same.dmae, same.ci_lo, same.ci_hi) == (0, 0, 0)
    assert same.verdict == "tie"
    out = BT.block_bootstrap(cases, [("a", "b"), ("b", "a")], 50)
    got = {r.pair: r for r in out.collect()}
    assert got["a_vs_b"].dmae == pytest.approx(-0.5) and got["a_vs_b"].ci_hi < 0
    assert got["a_vs_b"].verdict == "first"
    assert got["b_vs_a"].verdict == "second"


def noisy(spark, k=11, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(k):
        y = rng.normal(size=14)
        rows.append(("s", i, list(map(float, y)), list(map(float, y + rng.normal(0, 1, 14))), list(map(float, y + rng.normal(0, 1.2, 14)))))
    df = spark.createDataFrame(rows, "series_id string, i int, actual array<double>, a array<double>, b array<double>")
    return df.withColumn("origin", F.date_add(F.lit("2025-01-01").cast("date"), F.col("i"))), rows


def test_bootstrap_interval_agrees_with_numpy(spark):
    df, rows = noisy(spark)
    got = BT.block_bootstrap(df, [("a", "b")], 10_000).first()
    d = np.array([np.sum(np.abs(np.array(a) - y)) - np.sum(np.abs(np.array(b) - y)) for _, _, y, a, b in rows])
    rng = np.random.default_rng(0)
    diffs = d[rng.integers(0, 11, (10_000, 11))].sum(axis=1) / (11 * 14)
    assert got.dmae == pytest.approx(diffs.mean(), abs=0.01)
    assert got.ci_lo == pytest.approx(np.percentile(diffs, 2.5), abs=0.02)
    assert got.ci_hi == pytest.approx(np.percentile(diffs, 97.5), abs=0.02)


def test_bootstrap_is_repeatable_and_takes_short_series(spark):
    df, _ = noisy(spark, 5)
    first = BT.block_bootstrap(df, [("a", "b")], 200).first()
    second = BT.block_bootstrap(df.repartition(3), [("a", "b")], 200).first()
    assert first == second
    with pytest.raises(Exception, match="max_blocks"):
        BT.block_bootstrap(df, [("a", "b")], 10, max_blocks=3).collect()


@pytest.mark.parametrize(
    "lo,hi,want", [(-2.0, -1.0, "first"), (1.0, 2.0, "second"), (-1.0, 1.0, "tie"), (0.0, 0.0, "tie"), (-1.0, 0.0, "tie")]
)
def test_verdict(spark, lo, hi, want):
    assert spark.range(1).select(E.verdict(F.lit(lo), F.lit(hi))).first()[0] == want


def test_training_baseline_flags(spark, cases):
    naive = spark.createDataFrame([("s", 0.2, 1.0)], "series_id string, seasonal_naive double, persistence double")
    row = BT.training_baseline(FC.to_wide(cases, ["a", "b"]), "a", "b", naive).first()
    assert row.champion == "a" and row.ensemble_mae == 0.25 and row.n_holdout == 12
    assert row.loses_to_naive == 1 and row.weight_suboptimal == 1 and row.best_weight == 1.0


def test_mape_survives_a_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "y double, yhat double")
    assert df.agg(E.mape_pct(F.col("y"), F.col("yhat"), 1.0)).first()[0] == 100.0
