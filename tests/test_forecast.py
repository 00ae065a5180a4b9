import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.operators import backtest as BT
from dayloom.operators import forecast as FC
from dayloom.operators import linear as L
from dayloom.operators import trees as T
from dayloom.plans import prediction, training
from dayloom.plans.gold import daily_panel, feature_table

RNG = np.random.default_rng(5)


def weekly(n, noise=0.02, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return [float(v) for v in 1e6 * (3 + np.sin(2 * np.pi * t / 7) + noise * rng.normal(size=n))]


def array_of(df, col):
    return df.select(col).first()[0]


def test_lag_seven_recursion_uses_the_right_day(spark):
    df = spark.range(1).select(F.array(*[F.lit(float(v)) for v in range(1, 31)]).alias("hist"))
    coef = F.array(F.lit(0.0), F.lit(1.0))
    path = L.recurse_linear(F.col("hist"), F.array(), coef, [7], [], 14)
    assert array_of(df.select(path.alias("p")), "p") == [float(v) for v in list(range(24, 31)) * 2]
    naive = FC.seasonal_naive(F.col("hist"))
    assert array_of(df.select(naive.alias("p")), "p") == [float(v) for v in list(range(24, 31)) * 2]
    assert array_of(df.select(FC.persistence(F.col("hist")).alias("p")), "p") == [30.0] * 14


def test_second_step_sees_the_first_prediction(spark):
    df = spark.range(1).select(F.array(*[F.lit(1.0)] * 14).alias("hist"))
    path = L.recurse_linear(F.col("hist"), F.array(), F.array(F.lit(9.0), F.lit(0.5)), [1], [], 3)
    assert array_of(df.select(path.alias("p")), "p") == [9.5, 13.75, 15.875]


def test_origins(make_panel):
    df = make_panel({"a": [float(i) for i in range(200)], "b": [float(i) for i in range(120)]})
    rows = FC.rolling_origins(df, unit=1.0).orderBy("series_id", "origin").collect()
    for name, n in (("a", 200), ("b", 120)):
        mine = [r for r in rows if r.series_id == name]
        assert [r.hist[-1] for r in mine] == [float(p) for p in range(n - 91, n - 14, 7)]
        assert len(mine) == 11
        assert all(len(r.hist) == 14 and r.actual == [r.hist[-1] + h for h in range(1, 15)] for r in mine)


def test_linear_fit_matches_least_squares(spark):
    x = RNG.normal(size=(200, 3))
    y = 2 + x @ [1.0, -3.0, 0.5] + 0.1 * RNG.normal(size=200)
    rows = [("s", *map(float, r), float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, "series_id string, a double, b double, c double, y double")
    fit = L.fit_linear(df, ["a", "b", "c"]).first()
    design = np.column_stack([np.ones(200), x])
    beta, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
    np.testing.assert_allclose(fit.coef, beta, rtol=1e-9)
    assert fit.rss == pytest.approx(rss[0], rel=1e-6)
    err = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / 196)
    np.testing.assert_allclose(fit.std_err, err, rtol=1e-6)
    table = {r.feature: r for r in L.coefficient_table(L.fit_linear(df, ["a", "b", "c"]), ["a", "b", "c"]).collect()}
    assert table["b"].direction == "lowers" and table["b"].is_significant == 1


def test_constant_regressor_does_not_break_the_fit(spark):
    rows = [("s", float(i), 1.0, 3.0 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "series_id string, a double, flat double, y double")
    fit = L.fit_linear(df, ["a", "flat"]).first()
    assert fit.coef[1] == pytest.approx(3.0)


def test_lag_search_prefers_the_true_season(make_panel):
    rows = feature_table(daily_panel(make_panel({"a": weekly(300)})))
    rows = rows.withColumn("target", F.col("y") / S.UNIT_SCALE)
    best = L.choose_lags(rows, [(1,), (2, 3), (7,)], [], "target").first()
    assert list(best.lags) == [7]


def test_order_cache_expires_after_ninety_days(spark):
    today = F.lit("2025-06-30").cast("date")
    s = spark.createDataFrame([("young",), ("old",), ("none",)], "series_id string")
    cached = spark.createDataFrame(
        [("young", [7], dt.date(2025, 4, 2)), ("old", [7], dt.date(2025, 4, 1))],
        "series_id string, lags array<int>, search_date date",
    )
    found = s.withColumn("lags", F.array(F.lit(1)))
    got = {r.series_id: (r.source, list(r.lags)) for r in L.resolve_order(s, cached, found, today).collect()}
    assert got == {"young": ("cached", [7]), "old": ("searched", [1]), "none": ("searched", [1])}


def test_future_covariates_chain_and_fall_back(spark, make_panel):
    panel = daily_panel(make_panel({"a": [1e6] * 20}, snow=lambda i: 2.0 if i == 19 else 0.0))
    first = dt.date(2025, 1, 26)
    outlook = spark.createDataFrame(
        [(first, 60.0, 1.0, 5.0)], "ds date, temp double, precip double, snow double"
    )
    rows = FC.future_covariates(panel, outlook).orderBy("h").collect()
    assert len(rows) == 14 and rows[0].ds == first
    assert [rows[i].snow_lag1 for i in range(3)] == [2.0, 5.0, 0.0]
    mean = panel.agg(F.avg("temp")).first()[0]
    assert rows[0].temp == 60.0 and rows[1].temp == pytest.approx(mean) and rows[1].precip == 0.0
    assert rows[1].temp_lag1 == 60.0


def test_linear_backtest_recovers_a_linear_process(make_panel):
    cases = training.linear_backtest(daily_panel(make_panel({"a": weekly(260, 0.0)})))
    scores = {r.model: r for r in BT.score(FC.to_long(cases, ["linear", "seasonal_naive", "persistence"])).collect()}
    assert scores["linear"].mae < 1e-6 and scores["seasonal_naive"].mae < 1e-6
    assert scores["persistence"].mae > 0.3
    assert scores["linear"].n_points == 154


def one_tree(trees, t, x):
    """Value of one tree for one row, node by node."""
    at = 0
    for d in range(S.TREE_DEPTH):
        node = 2**d - 1 + at
        at = 2 * at + int(x[trees.split[t, node]] > trees.bound[t, node])
    return trees.leaf[t, at]


def tree_path(trees, case, horizon):
    """Brute force: one row, one step, one tree at a time."""
    path = list(case.hist)
    for h in range(1, horizon + 1):
        day = case.origin + dt.timedelta(days=h)
        f = case.future[h - 1]
        x = [day.weekday(), day.month, int(day.weekday() >= 5), f["is_holiday"]]
        x += [f[c] for c in T.WEATHER] + [path[-k] for k in S.LAGS]
        x += [np.mean(path[-14:]), np.std(path[-7:], ddof=1)]
        path.append(trees.base + sum(one_tree(trees, t, x) for t in range(len(trees.leaf))))
    return path[-horizon:]


def test_first_tree_makes_the_best_split():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = np.where(x[:, 1] > 4, 5.0, 1.0) + 0.01 * rng.normal(size=400)
    model = T.boost(x, y, 60)
    used = [t for t in range(60) if model.split[t, 0] == 1]
    assert len(used) > 30 and all(model.bound[t, 0] == 4.0 for t in used[:10])
    assert np.abs(model.predict(x) - y).mean() < 0.3  # 60 steps of 0.05 towards it
    assert np.allclose(T.boost(x, np.full(400, 2.0), 5).predict(x), 2.0)


def test_fitting_stops_early_and_cuts_the_model():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = x[:, 0] + 0.5 * rng.normal(size=300)
    model = T.boost(x[:250], y[:250], 500, x[250:], y[250:])
    tried, kept = len(model.errors), len(model.leaf)
    assert kept == int(np.argmin(model.errors)) + 1 and tried == min(500, kept + S.TREE_PATIENCE) < 500
    assert np.abs(model.predict(x[250:]) - y[250:]).mean() == pytest.approx(min(model.errors))


def test_refit_keeps_the_number_of_trees(spark, make_panel):
    rows = feature_table(daily_panel(make_panel({"a": weekly(220), "b": weekly(200, seed=2)})))
    cut = {r.series_id: r for r in T.fit_trees(rows, stop_days=30, held_out=30, refit=False).collect()}
    full = {r.series_id: r for r in T.fit_trees(rows, stop_days=30, held_out=30).collect()}
    assert set(cut) == {"a", "b"}
    for name in cut:
        assert cut[name].n_trees == full[name].n_trees == T.best_tree_count(cut[name].errors) <= 500
        assert cut[name].leaf != full[name].leaf and cut[name].errors == full[name].errors
    folds = T.cross_validate_trees(rows, trees=40).orderBy("series_id", "fold").collect()
    assert [(r.fold, r.n_train, r.n_rows) for r in folds[:5]] == [(k, 206 - (6 - k) * 34, 34) for k in range(1, 6)]
    assert all(0 < r.n_trees <= 40 and r.mae < 1 for r in folds)


def test_tree_count():
    assert T.best_tree_count([5, 4, 3, 3, 2.9, 6], patience=50) == 5
    assert T.best_tree_count([5, 4, 4, 4, 1], patience=2) == 2
    assert T.best_tree_count([1.0]) == 1


def test_trees_and_serving(spark, make_panel):
    panel = daily_panel(make_panel({"a": weekly(200), "b": weekly(160, seed=2)})).cache()
    cases = training.full_backtest(panel, n_trees=3)
    rows = cases.collect()
    assert len(rows) == 22
    assert all(len(r.trees) == 14 and len(r.ensemble) == 14 for r in rows)
    long = FC.to_long(cases, ["trees", "seasonal_naive"])
    assert long.where("yhat is null").count() == 0

    model = T.fit_trees(feature_table(panel), trees=30)
    stored = {r.series_id: T.unpacked(r.base, r.split, r.bound, r.leaf) for r in model.collect()}
    picked = FC.rolling_origins(training.tree_covariates(panel), training.CASE_COVARIATES)
    out = T.forecast_trees(model, picked).orderBy("series_id", "origin").limit(2).collect()
    for r in out:
        np.testing.assert_allclose(r.trees, tree_path(stored[r.series_id], r, 14), rtol=1e-9)

    importance = {
        r.feature: r.importance
        for r in T.permutation_importance(model, feature_table(panel).where("ds >= '2025-06-01'")).collect()
    }
    assert len(importance) == len(T.TREE_FEATURES)
    assert max(importance, key=importance.get) in ("y_lag7", "y_lag14", "day_of_week")

    from dayloom.operators.features import scale_bounds

    coef = training.fit_linear_models(panel, held_back=0)
    bounds = scale_bounds(panel, list(S.EXOG), F.lit(True))
    outlook = spark.createDataFrame([], "ds date, temp double, precip double, snow double")
    served = prediction.serve(panel, outlook, coef, bounds, model)
    got = served.orderBy("series_id", "ds").collect()
    assert len(got) == 28
    last = {r.series_id: r.m for r in panel.groupBy("series_id").agg(F.max("ds").alias("m")).collect()}
    assert got[0].ds == last["a"] + dt.timedelta(days=1)
    assert all(r.ensemble == pytest.approx(0.5 * r.linear + 0.5 * r.trees) for r in got)
    stamped = prediction.stamp(served, panel, F.current_date(), {"linear": "3"}).first()
    assert stamped.linear_version == "3" and re.fullmatch(r"-?\d+--?\d+", stamped.data_digest)
    panel.unpersist()


def test_new_actuals_move_the_origin_but_not_the_coefficients(spark, make_panel):
    y = weekly(130)
    early = daily_panel(make_panel({"a": y[:120]}))
    late = daily_panel(make_panel({"a": y}))
    coef = training.fit_linear_models(early, held_back=0)
    outlook = spark.createDataFrame([], "ds date, temp double, precip double, snow double")

    def case(panel):
        future = FC.future_covariates(panel, outlook)
        return FC.serving_cases(panel, future, list(S.EXOG)).first()

    assert (case(late).origin - case(early).origin).days == 10
    assert case(late).hist == pytest.approx([v / 1e6 for v in y[-14:]])
    assert coef.count() == 1
