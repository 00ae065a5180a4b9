import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.functions.quantiles import exact_percentiles
from dayloom.operators import explore as X

RNG = np.random.default_rng(11)


@pytest.mark.parametrize("off", [0.5, 0.0])
def test_brackets_that_miss_are_widened(spark, monkeypatch, off):
    from dayloom.functions import quantiles as Q

    right = F.percentile_approx
    calls = []

    def shifted(col, edges, accuracy):
        calls.append(1)
        return right(col, edges, accuracy) if len(calls) > 1 else F.transform(right(col, edges, accuracy), lambda e: e + off * 100)

    monkeypatch.setattr(Q.F, "percentile_approx", shifted)
    df = spark.range(101).selectExpr("CAST(NULL AS string) AS k", "CAST(id AS double) AS v")
    df = df.unionByName(spark.createDataFrame([("empty", None), ("nan", float("nan"))], "k string, v double"))
    rows = {r.k: r for r in exact_percentiles(df, ["k"], "v", {"a": 0.255, "b": 1.0}, 10, [F.count("*").alias("n")]).collect()}
    assert (rows[None].a, rows[None].b, rows[None].n) == (pytest.approx(25.5), 100.0, 101)
    assert (rows["empty"].a, rows["nan"].b, rows["nan"].n) == (None, None, 1)
    assert len(calls) == (2 if off else 1)


@pytest.mark.parametrize("kind", ["normal", "ties", "spike", "tiny"])
def test_exact_percentiles_match_numpy(spark, kind):
    draw = {
        "normal": lambda: RNG.normal(size=5000),
        "ties": lambda: RNG.integers(0, 4, 3000).astype(float),
        "spike": lambda: np.concatenate([np.zeros(4000), RNG.exponential(size=57)]),
        "tiny": lambda: RNG.normal(size=3),
    }[kind]
    groups = {"hot": draw(), "cold": draw()[:7], None: draw()[:11]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    got = {r.k: [r[n] for n in probs] for r in exact_percentiles(df, ["k"], "v", probs, 64).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        np.testing.assert_allclose(got[k], np.quantile(vs, list(probs.values())), rtol=1e-12, atol=1e-15)


def series(n=140):
    t = np.arange(n)
    return 100 + 0.3 * t + 10 * np.sin(2 * np.pi * t / 7) + RNG.normal(size=n)


def test_decomposition(make_panel):
    y = series(70)
    rows = X.decompose(make_panel({"a": list(map(float, y))})).orderBy("ds").collect()
    trend = np.array([np.mean(y[i - 3 : i + 4]) if 3 <= i < 67 else np.nan for i in range(70)])
    phase = np.array([np.nanmean((y - trend)[p::7]) for p in range(7)])
    seasonal = np.tile(phase - phase.mean(), 10)
    assert rows[0].trend is None and rows[-3].resid is None
    np.testing.assert_allclose([r.seasonal for r in rows], seasonal, atol=1e-9)
    np.testing.assert_allclose(rows[10].resid, y[10] - trend[10] - seasonal[10], atol=1e-9)


def test_autocorrelations(make_panel):
    y = series()
    df = make_panel({"a": list(map(float, y)), "b": list(map(float, y[:100][::-1]))})
    d = y - y.mean()
    acf = np.array([np.sum(d[k:] * d[: len(d) - k]) for k in range(31)]) / np.sum(d * d)
    got = [r.acf for r in X.autocorrelation(df, 30).where("series_id = 'a'").orderBy("lag").collect()]
    np.testing.assert_allclose(got, acf[1:], atol=1e-12)
    pacf = []
    for k in range(1, 31):
        toeplitz = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        pacf.append(np.linalg.solve(toeplitz, acf[1 : k + 1])[-1])
    got = [r.pacf for r in X.partial_autocorrelation(df, 30).where("series_id = 'a'").orderBy("lag").collect()]
    np.testing.assert_allclose(got, pacf, atol=1e-8)


@pytest.mark.parametrize("lags", [1, 3])
def test_unit_root_statistic(make_panel, lags):
    noise = RNG.normal(size=300)
    walk = np.cumsum(noise)
    df = make_panel({"noise": list(map(float, noise)), "walk": list(map(float, walk))})
    got = {r.series_id: r for r in X.unit_root_test(df, lags).collect()}
    for name, y in (("noise", noise), ("walk", walk)):
        dy = np.diff(y)
        rows = range(lags, len(dy))
        x = np.array([[1.0, y[t]] + [dy[t - k] for k in range(1, lags + 1)] for t in rows])
        target = dy[lags:]
        beta, rss, *_ = np.linalg.lstsq(x, target, rcond=None)
        s2 = rss[0] / (len(target) - x.shape[1])
        stat = beta[1] / np.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1])
        assert got[name].adf == pytest.approx(stat, rel=1e-6)
    assert got["noise"].is_stationary == 1 and got["walk"].is_stationary == 0


def test_column_reports(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (2, None, 5)], "a int, b string, c int")
    nulls = {r.column: r.n_missing for r in X.null_counts(df, ["a", "b", "c"]).collect()}
    assert nulls == {"a": 0, "b": 1, "c": 2}
    kinds = {r.column: (r.n_distinct, r.is_constant) for r in X.distinct_counts(df, ["a", "b", "c"]).collect()}
    assert kinds == {"a": (2, 0), "b": (1, 1), "c": (1, 1)}
    approx = X.distinct_counts(df, ["a", "b", "c"], exact=False)
    assert {r.column: r.n_distinct for r in approx.collect()} == {"a": 2, "b": 1, "c": 1}
    assert [r.b for r in X.top_values(df, "b", 1).collect()] == ["x"]


def test_boxplot_fences(make_panel):
    y = list(map(float, RNG.normal(size=50)))
    row = X.boxplot(make_panel({"a": y}), ["series_id"]).first()
    q1, q3 = np.quantile(y, [0.25, 0.75])
    assert row.lower_fence == pytest.approx(q1 - 1.5 * (q3 - q1))
    assert row.upper_fence == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_describe_by_constant_group(spark):
    df = spark.range(1, 6).select(F.lit("g").alias("k"), F.col("id").cast("double").alias("v"))
    row = X.describe_by(df, ["k"], "v").first()
    assert (row.n, row.mean, row.min, row.q25, row.q50, row.q75, row.max) == (5, 3, 1, 2, 3, 4, 5)
