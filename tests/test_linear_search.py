import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.operators import linear as L
from dayloom.operators.features import lag_name
from dayloom.plans import training
from dayloom.plans.gold import daily_panel

RNG = np.random.default_rng(11)


def products(x, y):
    design = np.column_stack([np.ones(len(x)), x])
    gram = design.T @ design
    return gram[np.triu_indices(len(gram))], design.T @ y, y @ y, len(y)


def aic(x, y, columns):
    design = np.column_stack([np.ones(len(x)), x[:, columns]])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    rss = ((y - design @ beta) ** 2).sum()
    return len(y) * np.log(rss / len(y)) + 2 * (1 + len(columns))


def test_gray_order_visits_every_set_once():
    sets = L.lag_subsets((1, 2, 3, 7, 14))
    assert len(sets) == len(set(sets)) == 31
    assert all(len(set(a) ^ set(b)) == 1 for a, b in zip(sets, sets[1:]))


@pytest.mark.parametrize("flat", [False, True])
def test_swept_scores_equal_separate_fits(flat):
    many = []
    for _ in range(3):
        x = RNG.normal(size=(120, 7)) * [1, 100, 0.01, 1, 1, 5, 1]
        if flat:
            x[:, 3] = 0.0
            x[:, 5] = 2 * x[:, 6]
        y = x @ RNG.normal(size=7) + RNG.normal(size=120)
        many.append((x, y))
    subsets = [[1 + k for k in c] for c in L.lag_subsets((0, 1, 2, 3, 4))]
    tri, xty, yty, n = zip(*[products(x, y) for x, y in many])
    got = L.subset_scores(tri, xty, yty, n, [0, 6, 7], subsets)
    for (x, y), scores in zip(many, got):
        want = [aic(x, y, [k - 1 for k in s] + [5, 6]) for s in subsets]
        np.testing.assert_allclose(scores, want, rtol=1e-7, atol=1e-5)


def ar_panel(make_panel, lags, n=400, seed=3):
    rng = np.random.default_rng(seed)
    y = list(3 + rng.normal(size=14))
    for _ in range(n - 14):
        y.append(1.0 + sum(w * y[-k] for k, w in lags.items()) + 0.3 * rng.normal())
    return daily_panel(make_panel({"a": [1e6 * v for v in y]}))


def test_several_lags_win_and_reach_the_fit(make_panel):
    panel = ar_panel(make_panel, {1: 0.45, 7: 0.4})
    fit = training.fit_ordered_models(panel, held_back=30).first()
    assert {1, 7} <= set(fit.lags) and fit.source == "searched"
    names = [lag_name(k) for k in sorted(S.LAGS)] + list(S.EXOG)
    rows = training.scaled_training_rows(panel, 30).where("_back >= 30")
    own = L.fit_linear(rows, [lag_name(k) for k in fit.lags] + list(S.EXOG), "target").first()
    assert fit.rss == pytest.approx(own.rss) and fit.aic == pytest.approx(own.aic)
    placed = dict(zip(names, fit.coef[1:], strict=True))
    for name, value in zip([lag_name(k) for k in fit.lags] + list(S.EXOG), own.coef[1:], strict=True):
        assert placed[name] == pytest.approx(value)
    left_out = [i for i, k in enumerate(sorted(S.LAGS), 1) if k not in fit.lags]
    assert all(fit.coef[i] == 0 and fit.std_err[i] is None for i in left_out)


def test_fresh_cache_decides_the_fit(spark, make_panel):
    panel = ar_panel(make_panel, {1: 0.45, 7: 0.4})
    cached = spark.createDataFrame([("a", [14], "2025-06-01")], "series_id string, lags array<int>, d string")
    cached = cached.withColumn("search_date", F.to_date("d"))
    young = training.fit_ordered_models(panel, cached, F.to_date(F.lit("2025-06-30"))).first()
    old = training.fit_ordered_models(panel, cached, F.to_date(F.lit("2025-08-30"))).first()
    assert (list(young.lags), young.source) == ([14], "cached")
    assert len(old.lags) > 1 and str(old.search_date) == "2025-08-30"


def test_fold_fits_equal_fits_on_the_rows_before(spark):
    x = RNG.normal(size=(61, 2))
    y = 1 + x @ [2.0, -1.0] + 0.1 * RNG.normal(size=61)
    rows = [("s", i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "series_id string, ds int, a double, b double, y double")
    got = {r.fold: r for r in L.fold_fits(df, ["a", "b"]).collect()}
    scores = {r.fold: r for r in L.fold_scores(df, ["a", "b"]).collect()}
    design = np.column_stack([np.ones(61), x])
    for fold in range(1, 6):
        end = 11 + 10 * (fold - 1)
        beta, *_ = np.linalg.lstsq(design[:end], y[:end], rcond=None)
        off = design[end : end + 10] @ beta - y[end : end + 10]
        np.testing.assert_allclose(got[fold].coef, beta, rtol=1e-8)
        assert (got[fold].n_train, got[fold].n_rows) == (end, 10)
        assert got[fold].rmse == pytest.approx(np.sqrt((off**2).mean()), rel=1e-6)
        assert scores[fold].mae == pytest.approx(np.abs(off).mean())
