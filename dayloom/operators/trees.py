"""Boosted trees for every series, their recursive forecasts and feature importance.

A series' rows are bounded by the calendar, so one task fits its model: binned features, one
gradient histogram a level, 500 trees at most. The validation error of every prefix is kept while
the trees grow; fitting stops when it has not improved for ``TREE_PATIENCE`` trees and the model is
cut to the best prefix. One exchange by series serves the early-stopped fit and the refit; models
are rows of a table that later steps join by series.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.operators.features import SERIES, lag_name

CALENDAR = ["day_of_week", "month", "is_weekend", "is_holiday"]
WEATHER = ["temp", "precip", "snow", "snow_lag1", "temp_lag1", "precip_lag1"]
HISTORY = [lag_name(k) for k in S.LAGS] + ["y_mean14", "y_std7"]
TREE_FEATURES = CALENDAR + WEATHER + HISTORY
BINS = 64
_DEPTH = S.TREE_DEPTH
_INNER = 2**_DEPTH - 1

MODEL_SCHEMA = "n_trees int, base double, split binary, bound binary, leaf binary, errors array<double>"


@dataclass
class Trees:
    """Perfect trees, level by level: column and bound of every inner node, value of every leaf.
    A row goes right where its value is above the bound; a node without split sends all left."""

    base: float
    split: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray
    errors: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros((len(x), len(self.leaf)), np.int64)
        trees, rows = np.arange(len(self.leaf)), np.arange(len(x))[:, None]
        for d in range(_DEPTH):
            node = 2**d - 1 + at
            at = 2 * at + (x[rows, self.split[trees, node]] > self.bound[trees, node])
        return self.base + self.leaf[trees, at].sum(1)

    def packed(self) -> dict:
        return {
            "n_trees": len(self.leaf), "base": self.base, "split": self.split.astype(np.int16).tobytes(),
            "bound": self.bound.tobytes(), "leaf": self.leaf.tobytes(), "errors": self.errors,
        }


def unpacked(base: float, split: bytes, bound: bytes, leaf: bytes) -> Trees:
    return Trees(
        base, np.frombuffer(split, np.int16).reshape(-1, _INNER).astype(np.int64),
        np.frombuffer(bound).reshape(-1, _INNER), np.frombuffer(leaf).reshape(-1, _INNER + 1), [],
    )


def best_tree_count(errors: list[float], patience: int = S.TREE_PATIENCE) -> int:
    """Number of trees at the lowest error, looking no further than ``patience`` trees
    without an improvement."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boost(x, y, trees: int, xv=None, yv=None, seed: int = S.TREE_SEED, smooth: float = 1.0) -> Trees:
    """Boosting on squared loss; with validation rows, cut to the prefix of least absolute error."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS, method="lower")) for j in range(width)]
    # a row's bin: how many edges lie below its value, so bin b and less means up to edge b
    code = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1)
    table = np.full((width, BINS), np.inf)
    for j, e in enumerate(edges):
        table[j, : len(e)] = e
    usable = np.arange(BINS)[None, :] < np.array([len(e) for e in edges])[:, None]
    base = float(y.mean())
    guess, later = np.full(n, base), np.full(0 if xv is None else len(xv), base)
    made, errors, best = [], [], 0
    for number in range(trees):
        rows = np.flatnonzero(rng.random(n) < S.TREE_SUBSAMPLE)
        columns = np.sort(rng.permutation(width)[: max(1, round(S.TREE_SUBSAMPLE * width))])
        split, bound = np.zeros(_INNER, np.int64), np.full(_INNER, np.inf)
        pull, at = (y - guess)[rows], np.zeros(len(rows), np.int64)
        cells = code[rows][:, columns] + np.arange(len(columns)) * BINS
        for d in range(_DEPTH):
            size = 2**d * len(columns) * BINS
            where = (at[:, None] * (len(columns) * BINS) + cells).ravel()
            shape = (2**d, len(columns), BINS)
            g = np.bincount(where, np.repeat(pull, len(columns)), size).reshape(shape).cumsum(2)
            h = np.bincount(where, minlength=size).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
            gain = np.where(usable[columns] & (h > 0) & (h < h_all), gain, 0).reshape(2**d, -1)
            pick = gain.argmax(1)
            good = np.flatnonzero(gain[np.arange(2**d), pick] > 1e-12)
            node = 2**d - 1 + good
            split[node] = columns[pick[good] // BINS]
            bound[node] = table[split[node], pick[good] % BINS]
            now = 2**d - 1 + at
            at = 2 * at + (x[rows, split[now]] > bound[now])
        sums = np.bincount(at, pull, _INNER + 1)
        leaf = S.TREE_RATE * sums / (np.bincount(at, minlength=_INNER + 1) + smooth)
        made.append((split, bound, leaf))
        one = Trees(0.0, split[None], bound[None], leaf[None], [])
        guess = guess + one.predict(x)
        if xv is not None:
            later = later + one.predict(xv)
            errors.append(float(np.abs(later - yv).mean()))
            if errors[number] < errors[best]:
                best = number
            elif number - best >= S.TREE_PATIENCE:
                break
    count = best_tree_count(errors) if errors else len(made)
    split, bound, leaf = (np.stack(part) for part in zip(*made[:count], strict=True))
    return Trees(base, split, bound, leaf, errors)


def _matrix(pdf: pd.DataFrame, features: list[str], unit: float) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values("ds")
    return pdf[features].to_numpy(float), pdf["y"].to_numpy(float) / unit


def _key_fields(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def fit_trees(
    rows: DataFrame,
    trees: int = S.TREES,
    stop_days: int = 0,
    held_out: int = 0,
    refit: bool = True,
    features: list[str] = TREE_FEATURES,
    keys: list[str] = SERIES,
    unit: float = S.UNIT_SCALE,
    seed: int = S.TREE_SEED,
) -> DataFrame:
    """One model row per series (``keys`` and MODEL_SCHEMA).

    With ``stop_days`` the number of trees is chosen on that many days before the newest
    ``held_out`` ones, by a fit on the days before them. That cut model is returned, or with
    ``refit`` a model of as many trees on all rows. ``errors`` holds the validation error of
    every prefix that was tried. Series too short to hold days back keep all ``trees``.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = _matrix(pdf, features, unit)
        end = len(y) - held_out
        inner = end - stop_days
        if stop_days and inner >= 2:
            model = boost(x[:inner], y[:inner], trees, x[inner:end], y[inner:end], seed)
            if refit:
                errors = model.errors
                model = boost(x, y, len(model.leaf), seed=seed)
                model.errors = errors
        else:
            model = boost(x, y, trees, seed=seed)
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, **model.packed()}])

    schema = f"{_key_fields(rows, keys)}, {MODEL_SCHEMA}"
    return rows.select(*keys, "ds", "y", *features).groupBy(*keys).applyInPandas(fit, schema)


def cross_validate_trees(
    rows: DataFrame,
    splits: int = S.CV_SPLITS,
    keys: list[str] = SERIES,
    features: list[str] = TREE_FEATURES,
    trees: int = S.TREES,
    unit: float = S.UNIT_SCALE,
) -> DataFrame:
    """``keys, fold, n_train, n_rows, n_trees, mae`` of every expanding-window fold: trained on all
    rows before it, the number of trees chosen by the fold's own error."""

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = _matrix(pdf, features, unit)
        size, out = len(y) // (splits + 1), []
        for fold in range(1, splits + 1):
            start = len(y) - (splits + 1 - fold) * size
            if not size or not start:
                continue
            model = boost(x[:start], y[:start], trees, x[start : start + size], y[start : start + size])
            mae = np.abs(model.predict(x[start : start + size]) - y[start : start + size]).mean()
            row = {"fold": fold, "n_train": start, "n_rows": size, "n_trees": len(model.leaf), "mae": float(mae)}
            out.append({**{k: pdf[k].iloc[0] for k in keys}, **row})
        return pd.DataFrame(out, columns=[*keys, "fold", "n_train", "n_rows", "n_trees", "mae"])

    schema = f"{_key_fields(rows, keys)}, fold int, n_train long, n_rows long, n_trees int, mae double"
    return rows.select(*keys, "ds", "y", *features).groupBy(*keys).applyInPandas(score, schema)


def forecast_trees(
    model: DataFrame, cases: DataFrame, name: str = "trees", horizon: int = S.HORIZON, keys: list[str] = SERIES
) -> DataFrame:
    """Adds the recursive forecast array of each case.

    The cases of a series (a bounded number of origins) meet its model in one row; all of them
    take each step together, lags and rolling statistics seeing history and earlier predictions.
    """
    rest = [c for c in cases.columns if c not in keys]
    known = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)), lambda h: _known(F.col("origin"), F.get("future", h - 1), h)
    )
    one = F.struct(*rest, F.flatten(known).alias("_known"))
    packed = cases.groupBy(*keys).agg(F.collect_list(one).alias("_cases")).join(model, keys)

    @F.pandas_udf("array<array<double>>")
    def walk(hist: pd.Series, known: pd.Series, base: pd.Series, split: pd.Series, bound: pd.Series,
             leaf: pd.Series) -> pd.Series:
        out = []
        for past, ahead, *parts in zip(hist, known, base, split, bound, leaf):
            trees = unpacked(*parts)
            path = np.stack(list(past)).astype(float)
            ahead = np.stack(list(ahead)).astype(float).reshape(len(path), horizon, -1)
            for h in range(horizon):
                lags = np.stack([path[:, -k] for k in S.LAGS], 1)
                mean, std = path[:, -S.MEAN_WINDOW :].mean(1), path[:, -S.STD_WINDOW :].std(1, ddof=1)
                x = np.column_stack([ahead[:, h], lags, mean, std])
                path = np.column_stack([path, trees.predict(x)])
            out.append(list(path[:, -horizon:]))
        return pd.Series(out)

    paths = walk(
        F.col("_cases.hist"), F.col("_cases._known"), F.col("base"), F.col("split"), F.col("bound"), F.col("leaf")
    )
    rows = packed.select(*keys, F.explode(F.arrays_zip("_cases", paths.alias("_paths"))).alias("_z"))
    return rows.select(*keys, *[F.col(f"_z._cases.{c}").alias(c) for c in rest], F.col("_z._paths").alias(name))


def _known(origin: Column, weather: Column, h: Column) -> Column:
    """Calendar and weather of step h, in the order of TREE_FEATURES."""
    day = F.date_add(origin, h)
    calendar = [F.weekday(day), F.month(day), F.weekday(day) >= 5, weather["is_holiday"]]
    return F.array(*[c.cast("double") for c in [*calendar, *[weather[c] for c in WEATHER]]])


def permutation_importance(
    model: DataFrame,
    rows: DataFrame,
    features: list[str] = TREE_FEATURES,
    keys: list[str] = SERIES,
    unit: float = S.UNIT_SCALE,
) -> DataFrame:
    """Rise of the MAE when one feature is shuffled within its series, over all series.

    ``rows`` is a holdout of bounded length per series. Shuffling follows a hash of the day, so it
    is repeatable.
    """

    def errors(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(own):
            return pd.DataFrame({"feature": [], "off": [], "n": []})
        trees = unpacked(*(own[c].iloc[0] for c in ("base", "split", "bound", "leaf")))
        x, y = _matrix(pdf, features, unit)
        other = x[np.argsort(pdf.sort_values("ds")["_mix"].to_numpy(), kind="stable")]
        out = [(None, np.abs(trees.predict(x) - y).sum(), len(y))]
        for j, name in enumerate(features):
            mixed = x.copy()
            mixed[:, j] = other[:, j]
            out.append((name, np.abs(trees.predict(mixed) - y).sum(), len(y)))
        return pd.DataFrame(out, columns=["feature", "off", "n"])

    marked = rows.select(*keys, "ds", "y", *features, F.xxhash64("ds", F.lit("shuffle")).alias("_mix"))
    parts = marked.groupBy(*keys).cogroup(model.groupBy(*keys)).applyInPandas(
        errors, "feature string, off double, n long"
    )
    mae = parts.groupBy("feature").agg((F.sum("off") / F.sum("n")).alias("mae"))
    whole = Window.partitionBy()  # one row a feature
    base = F.max(F.when(F.col("feature").isNull(), F.col("mae"))).over(whole)
    return mae.withColumn("base", base).where("feature IS NOT NULL").select(
        "feature", F.col("mae").alias("shuffled_mae"), (F.col("mae") - F.col("base")).alias("importance")
    )
