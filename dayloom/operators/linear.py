"""Linear seasonal models for many series at once.

A fit is one aggregate: the cross products of the regressors are summed map-side, so one
small row per series (not its data) reaches the solver. The solve itself is a vectorised
Arrow function over those rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from dayloom import settings as S
from dayloom.operators.features import SERIES, lag_name, test_fold

FIT_TYPE = StructType(
    [
        StructField("coef", ArrayType(DoubleType())),
        StructField("std_err", ArrayType(DoubleType())),
        StructField("p_value", ArrayType(DoubleType())),
        StructField("rss", DoubleType()),
        StructField("aic", DoubleType()),
    ]
)


def cross_products(df: DataFrame, x: list[str], y: str, keys: list[str]) -> DataFrame:
    """X'X (upper triangle, row by row), X'y, y'y and n per key, with a constant first."""
    terms = [F.lit(1.0)] + [F.col(c).cast("double") for c in x]
    target = F.col(y).cast("double")
    names, aggs = [], []
    for i in range(len(terms)):
        for j in range(i, len(terms)):
            names.append(f"_x{i}_{j}")
            aggs.append(F.sum(terms[i] * terms[j]).alias(names[-1]))
    moments = [f"_y{i}" for i in range(len(terms))]
    aggs += [F.sum(t * target).alias(n) for t, n in zip(terms, moments)]
    sums = df.groupBy(*keys).agg(
        *aggs, F.sum(target * target).alias("yty"), F.count("*").alias("n_rows")
    )
    return sums.select(
        *keys, F.array(*names).alias("xtx"), F.array(*moments).alias("xty"), "yty", "n_rows"
    )


def _solve_one(tri, xty, yty, n, keep=None):
    k = len(xty)
    gram = np.zeros((k, k))
    gram[np.triu_indices(k)] = tri
    gram = gram + np.triu(gram, 1).T
    xty = np.asarray(xty, dtype=float)
    if keep is not None:
        gram, xty = gram[np.ix_(keep, keep)], xty[keep]
    # Equilibrate: columns in very different units would otherwise hide each other.
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    inverse = np.linalg.pinv(gram / np.outer(scale, scale), rcond=1e-12, hermitian=True)
    inverse = inverse / np.outer(scale, scale)
    beta = inverse @ xty
    rss = max(float(yty - beta @ xty), 0.0)
    free = n - len(xty)
    sigma2 = rss / free if free > 0 else float("nan")
    err = np.sqrt(np.clip(np.diag(inverse) * sigma2, 0.0, None))
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.where(err > 0, np.abs(beta) / err, np.nan)
    p = [math.erfc(v / math.sqrt(2)) if v == v else None for v in z]
    aic = n * math.log(rss / n) + 2 * len(xty) if rss > 0 else float("-inf")
    return beta.tolist(), err.tolist(), p, rss, aic


@F.pandas_udf(FIT_TYPE)
def _solve(tri: pd.Series, xty: pd.Series, yty: pd.Series, n: pd.Series) -> pd.DataFrame:
    rows = [_solve_one(*args) for args in zip(tri, xty, yty, n)]
    return pd.DataFrame(rows, columns=[f.name for f in FIT_TYPE])


def fit_linear(df: DataFrame, x: list[str], y: str = "y", keys: list[str] = SERIES) -> DataFrame:
    """Least squares of y on a constant and x per key: coefficients, errors, AIC."""
    sums = cross_products(df, x, y, keys)
    fit = sums.withColumn("_f", _solve("xtx", "xty", "yty", "n_rows"))
    return fit.select(*keys, "n_rows", *[F.col(f"_f.{f.name}").alias(f.name) for f in FIT_TYPE])


def coefficient_table(fit: DataFrame, x: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One row per regressor with its significance flag (constant left out)."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col("coef")[i].alias("coefficient"),
                F.col("std_err")[i].alias("std_err"),
                F.col("p_value")[i].alias("p_value"),
            )
            for i, name in enumerate(x, start=1)
        ]
    )
    rows = fit.select(*keys, F.explode(entries).alias("_e")).select(*keys, "_e.*")
    return rows.withColumns(
        {
            "is_significant": F.coalesce((F.col("p_value") < 0.05).cast("int"), F.lit(0)),
            "direction": F.when(F.col("coefficient") >= 0, "raises").otherwise("lowers"),
        }
    )


def lag_subsets(lags: tuple[int, ...] = S.LAGS) -> list[tuple[int, ...]]:
    """All lag sets but the empty one, in the order of a Gray code: neighbours differ by one lag."""
    codes = [i ^ (i >> 1) for i in range(1, 2 ** len(lags))]
    return [tuple(k for b, k in enumerate(lags) if code >> b & 1) for code in codes]


def _gram(tri, xty, yty) -> np.ndarray:
    """Symmetric matrices of [x y] products, one per row, from their upper triangles."""
    xty = np.stack(list(xty)).astype(float)
    n, k = xty.shape
    a = np.zeros((n, k + 1, k + 1))
    rows, cols = np.triu_indices(k)
    a[:, rows, cols] = a[:, cols, rows] = np.stack(list(tri)).astype(float)
    a[:, :k, k] = a[:, k, :k] = xty
    a[:, k, k] = np.asarray(yty, float)
    return a


def _sweep(a: np.ndarray, k: int, at: np.ndarray) -> None:
    """Sweeps the k-th variable of the chosen matrices into the regression, or out of it again."""
    m = a[at]
    pivot = m[:, k, k].copy()[:, None]
    row = m[:, k, :] / pivot
    column = m[:, :, k].copy()
    column[:, k] = 0
    m -= column[:, :, None] * row[:, None, :]
    m[:, k, :] = row
    m[:, :, k] = -column / pivot
    m[:, k, k] = 1 / pivot[:, 0]
    a[at] = m


def subset_scores(tri, xty, yty, n, always: list[int], subsets: list[list[int]], tiny: float = 1e-11) -> np.ndarray:
    """AIC of every subset of variables for every matrix, by sweeping.

    The variables in ``always`` are swept in once; from one subset to the next only those that
    differ are swept in or out, so a neighbour costs one sweep. A variable that others explain
    (its pivot is nearly 0) stays out and counts as a parameter all the same.
    """
    a = _gram(tri, xty, yty)
    count, p = len(a), a.shape[1] - 1
    size = np.sqrt(np.where(np.diagonal(a, axis1=1, axis2=2) > 0, np.diagonal(a, axis1=1, axis2=2), 1.0))
    a /= size[:, :, None] * size[:, None, :]
    n = np.asarray(n, float)
    inside = np.zeros((count, p), bool)

    def toggle(k: int, on: bool) -> None:
        at = np.flatnonzero(a[:, k, k] > tiny) if on else np.flatnonzero(inside[:, k])
        if len(at):
            _sweep(a, k, at)
        inside[at, k] = on

    for k in always:
        toggle(k, True)
    out, now = np.empty((count, len(subsets))), set()
    for s, wanted in enumerate(subsets):
        for k in sorted(now - set(wanted)):
            toggle(k, False)
        for k in sorted(set(wanted) - now):
            toggle(k, True)
        now = set(wanted)
        rss = np.maximum(a[:, p, p], 0) * size[:, p] ** 2
        with np.errstate(divide="ignore"):
            out[:, s] = n * np.log(rss / n) + 2 * (len(always) + len(wanted))
    return out


def choose_lags(
    df: DataFrame,
    candidates: list[tuple[int, ...]] | None = None,
    exog: list[str] = (),
    y: str = "y",
    keys: list[str] = SERIES,
) -> DataFrame:
    """The lag set with the lowest AIC among all subsets of the protocol's lags, or among the
    given candidates. All are sub-blocks of one cross-product matrix, so the data is summed once
    whatever their number; of equal ones the first stands."""
    candidates = candidates or lag_subsets()
    lags = sorted({k for c in candidates for k in c})
    names = [lag_name(k) for k in lags] + list(exog)
    sums = cross_products(df.na.drop(subset=[*names, y]), names, y, keys)
    return search_lags(sums, candidates, lags, len(exog), keys)


def search_lags(
    sums: DataFrame, candidates: list[tuple[int, ...]], lags: list[int], n_exog: int, keys: list[str] = SERIES
) -> DataFrame:
    """The search on cross products of a constant, ``lags`` and ``n_exog`` covariates."""
    always = [0, *range(1 + len(lags), 1 + len(lags) + n_exog)]
    blocks = [[1 + lags.index(k) for k in c] for c in candidates]

    @F.pandas_udf("struct<choice:int,aic:double,scores:array<double>>")
    def search(tri: pd.Series, xty: pd.Series, yty: pd.Series, n: pd.Series) -> pd.DataFrame:
        if not len(n):
            return pd.DataFrame({"choice": [], "aic": [], "scores": []})
        scores = subset_scores(tri, xty, yty, n, always, blocks)
        best = np.argmin(scores, 1)
        return pd.DataFrame(
            {"choice": best, "aic": scores[np.arange(len(best)), best], "scores": list(scores)}
        )

    sets = F.array(*[F.array(*[F.lit(k) for k in c]) for c in candidates])
    return sums.withColumn("_s", search("xtx", "xty", "yty", "n_rows")).select(
        *keys,
        F.get(sets, F.col("_s.choice")).alias("lags"),
        F.col("_s.aic").alias("aic"),
        F.col("_s.scores").alias("scores"),
    )


def fit_chosen(
    sums: DataFrame, chosen: DataFrame, lags: list[int], n_exog: int, keys: list[str] = SERIES
) -> DataFrame:
    """Fits every series on its own lag set (``chosen``: keys, lags), from the cross products
    that the search used. Coefficients keep the places of all ``lags``; a lag left out has
    coefficient 0 and no error, so one recursion serves every series."""
    width = 1 + len(lags) + n_exog
    fields = [f.name for f in FIT_TYPE]

    @F.pandas_udf(FIT_TYPE)
    def solve(tri: pd.Series, xty: pd.Series, yty: pd.Series, n: pd.Series, sets: pd.Series) -> pd.DataFrame:
        rows = []
        for t, v, yy, m, own in zip(tri, xty, yty, n, sets):
            keep = [0, *[1 + lags.index(k) for k in own], *range(1 + len(lags), width)]
            coef, err, p, rss, aic = _solve_one(t, v, yy, m, keep)
            full = [np.zeros(width), np.full(width, np.nan), np.full(width, np.nan)]
            for values, found in zip(full, (coef, err, p)):
                values[keep] = [np.nan if x is None else x for x in found]
            err, p = ([None if x != x else x for x in values] for values in full[1:])
            rows.append((full[0].tolist(), err, p, rss, aic))
        return pd.DataFrame(rows, columns=fields)

    fit = sums.join(chosen.select(*keys, "lags"), keys)
    fit = fit.withColumn("_f", solve("xtx", "xty", "yty", "n_rows", "lags"))
    return fit.select(*keys, "lags", "n_rows", *[F.col(f"_f.{f}").alias(f) for f in fields])


def fold_fits(
    rows: DataFrame, x: list[str], y: str = "y", keys: list[str] = SERIES, splits: int = S.CV_SPLITS
) -> DataFrame:
    """The fit of every expanding-window fold: ``keys, fold, n_train, n_rows, coef, rmse``.

    Each row is summed once, into the cross products of its own block; a fold's training matrix is
    the running sum of the blocks before it, and its squared test error follows from its own.
    """
    marked = rows.withColumn("fold", test_fold(splits, keys))
    blocks = cross_products(marked, x, y, [*keys, "fold"])
    packed = blocks.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("fold", "xtx", "xty", "yty", "n_rows"))).alias("_b")  # splits + 1
    )

    @F.pandas_udf("array<struct<fold:int,n_train:long,n_rows:long,coef:array<double>,rmse:double>>")
    def fits(parts: pd.Series) -> pd.Series:
        out = []
        for series in parts:
            own = [(b["fold"], np.asarray(b["xtx"]), np.asarray(b["xty"]), b["yty"], b["n_rows"]) for b in series]
            made, tri, xty, yty, n = [], 0.0, 0.0, 0.0, 0
            for fold, t, v, yy, m in own:
                if n:
                    coef = np.asarray(_solve_one(tri, xty, yty, n)[0])
                    gram = _gram([t], [v], [yy])[0][:-1, :-1]
                    sse = max(yy - 2 * coef @ v + coef @ gram @ coef, 0.0)
                    made.append({"fold": fold, "n_train": n, "n_rows": m, "coef": coef, "rmse": math.sqrt(sse / m)})
                tri, xty, yty, n = tri + t, xty + v, yty + yy, n + m
            out.append(made)
        return pd.Series(out)

    return packed.select(*keys, F.explode(fits("_b")).alias("_f")).select(*keys, "_f.*")


def fold_scores(
    rows: DataFrame, x: list[str], y: str = "y", keys: list[str] = SERIES, splits: int = S.CV_SPLITS
) -> DataFrame:
    """MAE and RMSE of every fold's fit on its test rows (``fold_fits``, then one pass for the MAE)."""
    fits = fold_fits(rows, x, y, keys, splits)
    tested = rows.withColumn("fold", test_fold(splits, keys)).join(fits, [*keys, "fold"])
    yhat = F.get("coef", F.lit(0))
    for i, c in enumerate(x, start=1):
        yhat = yhat + F.get("coef", F.lit(i)) * F.col(c)
    return tested.groupBy(*keys, "fold").agg(
        F.first("n_train").alias("n_train"), F.count("*").alias("n_rows"),
        F.avg(F.abs(yhat - F.col(y))).alias("mae"), F.first("rmse").alias("rmse"),
    )


def resolve_order(
    series: DataFrame,
    cached: DataFrame,
    searched: DataFrame,
    as_of: Column,
    ttl: int = S.ORDER_TTL_DAYS,
    keys: list[str] = SERIES,
) -> DataFrame:
    """Reuse a cached lag set while it is younger than ``ttl`` days, else take the new one
    and pin it to today. ``cached``: keys, lags, search_date; ``searched``: keys, lags."""
    old = cached.select(*keys, F.col("lags").alias("_old"), F.col("search_date").alias("_when"))
    new = searched.select(*keys, F.col("lags").alias("_new"))
    fresh = F.col("_when").isNotNull() & (F.datediff(as_of, "_when") < ttl)
    return (
        series.join(old, keys, "left")
        .join(new, keys, "left")
        .select(
            *keys,
            F.when(fresh, F.col("_old")).otherwise(F.col("_new")).alias("lags"),
            F.when(fresh, "cached").otherwise("searched").alias("source"),
            F.when(fresh, F.col("_when")).otherwise(as_of).alias("search_date"),
        )
    )


def recurse_linear(
    hist: Column,
    future: Column,
    coef: Column,
    lags: list[int],
    exog: list[str],
    horizon: int = S.HORIZON,
) -> Column:
    """Forecast array of a linear model, each step fed by the ones before.

    ``hist``: last known values, oldest first; ``future``: array of structs with the known
    covariates of each step; ``coef``: constant, lags, covariates. One expression inside
    the scan's stage: no loop on the driver, no join, no row per step.
    """

    def step(values: Column, h: Column) -> Column:
        size = F.size(values)
        pred = F.get(coef, F.lit(0))
        for i, k in enumerate(lags, start=1):
            pred = pred + F.get(coef, F.lit(i)) * F.get(values, size - k)
        for i, name in enumerate(exog, start=1 + len(lags)):
            pred = pred + F.get(coef, F.lit(i)) * F.get(future, h - 1)[name]
        return F.concat(values, F.array(pred))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), hist, step, lambda v: F.slice(v, -horizon, horizon)
    )
