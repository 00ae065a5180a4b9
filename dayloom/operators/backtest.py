"""Scores of backtest cases and the block bootstrap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.functions import errors as E
from dayloom.operators.features import SERIES


def score(long: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """MAE, RMSE, MAPE, bias and count per model."""
    y, yhat = F.col("y"), F.col("yhat")
    return (
        long.where(y.isNotNull() & yhat.isNotNull())
        .groupBy(*keys, "model")
        .agg(
            F.count("*").alias("n_points"),
            E.mae(y, yhat).alias("mae"),
            E.rmse(y, yhat).alias("rmse"),
            E.mape_pct(y, yhat).alias("mape_pct"),
            E.bias(y, yhat).alias("bias"),
        )
    )


def relative_mae(scores: DataFrame, keys: list[str] = SERIES, naive: str = "seasonal_naive"):
    """MAE over the seasonal-naive MAE of the same windows; NULL where that is 0."""
    w = Window.partitionBy(*keys)
    base = F.max(F.when(F.col("model") == naive, F.col("mae"))).over(w)
    ratio = F.when(F.col("model") == naive, F.lit(1.0)).otherwise(
        F.try_divide("mae", F.when(base != 0, base))
    )
    return scores.withColumn("mase", ratio)


def skill_pct(model_mae: Column, naive_mae: Column) -> Column:
    return F.try_divide(naive_mae - model_mae, naive_mae) * 100


def mae_by_step(long: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    return long.groupBy(*keys, "model", "h").agg(
        E.mae(F.col("y"), F.col("yhat")).alias("mae"),
        F.stddev_samp(F.col("yhat") - F.col("y")).alias("sigma"),
        F.count("*").alias("n_origins"),
    )


def weight_grid(step: float = S.WEIGHT_STEP) -> list[float]:
    return [round(i * step, 2) for i in range(int(round(1 / step)) + 1)]


def weight_curve(
    wide: DataFrame, first: str, second: str, keys: list[str] = SERIES, step: float = S.WEIGHT_STEP
) -> DataFrame:
    """MAE of the blend at every weight. The weights are columns of one aggregate: rows are
    neither copied nor joined per weight."""
    weights = weight_grid(step)
    err = [
        F.avg(F.abs(E.blend(F.col(first), F.col(second), w) - F.col("y"))).alias(f"_w{i}")
        for i, w in enumerate(weights)
    ]
    curve = F.array(
        *[
            F.struct(F.lit(w).alias("weight"), F.col(f"_w{i}").alias("mae"))
            for i, w in enumerate(weights)
        ]
    )
    return (
        wide.groupBy(*keys).agg(*err).select(*keys, F.explode(curve).alias("_c")).select(*keys, "_c.*")
    )


def best_weight(curve: DataFrame, keys: list[str] = SERIES, digits: int = 12) -> DataFrame:
    """The weight with the lowest MAE; the lowest weight on ties."""
    m = F.round("mae", digits)
    return curve.groupBy(*keys).agg(
        F.min_by("weight", F.struct(m, F.col("weight"))).alias("best_weight"),
        F.min("mae").alias("best_mae"),
    )


def _path_error(path: str, actual: str = "actual") -> Column:
    return F.aggregate(
        F.zip_with(path, actual, lambda p, a: F.abs(p - a)), F.lit(0.0), lambda s, v: s + v
    )


# Draws per digest: one md5 has room for four 32-bit numbers.
_PER_DIGEST = 4


def draw_index(replicate: Column, draw: int, blocks: Column, seed: int = 0) -> Column:
    """Pseudo-random block 0…blocks−1: the same in every session and on every engine that
    has md5, so a resample can be repeated after a lost task."""
    text = F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), F.lit(str(draw // _PER_DIGEST)))
    start = 1 + 8 * (draw % _PER_DIGEST)
    number = F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("double")
    return F.floor(number / F.lit(4294967296.0) * blocks).cast("int")


def block_bootstrap(
    cases: DataFrame,
    pairs: list[tuple[str, str]],
    n_boot: int = S.N_BOOT,
    seed: int = 0,
    keys: list[str] = SERIES,
    max_blocks: int | None = None,
) -> DataFrame:
    """Bootstrap of MAE(first) − MAE(second) over whole origins.

    Each origin shrinks to its summed errors before anything is resampled, and a series'
    origins (at most ``max_blocks``, by default as many as there are) sit in one row. Replicates are made by exploding that
    row, so the resample needs no join, and all pairs share the draws.
    """
    sums = cases.select(
        *keys,
        F.struct(
            F.col("origin"),
            F.size("actual").cast("double").alias("n"),
            *[
                (_path_error(a) - _path_error(b)).alias(f"d{i}")
                for i, (a, b) in enumerate(pairs)
            ],
        ).alias("_block"),
    )
    blocks = sums.groupBy(*keys).agg(F.sort_array(F.collect_list("_block")).alias("_blocks"))
    if max_blocks is None:
        max_blocks = cases.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1
    k = F.size("_blocks")
    guard = F.when(k > max_blocks, F.raise_error(F.lit("more origins than max_blocks"))).otherwise(k)
    reps = blocks.select(
        *keys, "_blocks", guard.alias("_k"), F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("_b")
    )
    # One draw column per block; draws past a shorter series' own count do not count.
    drawn = reps.withColumn(
        "_pick",
        F.array(
            *[
                F.when(F.lit(j) < F.col("_k"), F.get("_blocks", draw_index(F.col("_b"), j, F.col("_k"), seed)))
                for j in range(max_blocks)
            ]
        ),
    )

    def total(name: str) -> Column:
        return F.aggregate(
            F.col("_pick"), F.lit(0.0), lambda s, b: s + F.coalesce(b[name], F.lit(0.0))
        )

    diffs = drawn.select(
        *keys,
        *[(total(f"d{i}") / total("n")).alias(f"_diff{i}") for i in range(len(pairs))],
    )
    ends = F.array(F.lit(0.025), F.lit(0.975))
    stats = diffs.groupBy(*keys).agg(
        *[F.avg(f"_diff{i}").alias(f"_m{i}") for i in range(len(pairs))],
        *[F.percentile(f"_diff{i}", ends).alias(f"_q{i}") for i in range(len(pairs))],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{a}_vs_{b}").alias("pair"),
                F.col(f"_m{i}").alias("dmae"),
                F.col(f"_q{i}")[0].alias("ci_lo"),
                F.col(f"_q{i}")[1].alias("ci_hi"),
                E.verdict(F.col(f"_q{i}")[0], F.col(f"_q{i}")[1]).alias("verdict"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return stats.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def training_baseline(
    wide: DataFrame,
    first: str,
    second: str,
    baselines: DataFrame,
    keys: list[str] = SERIES,
    weight: float = S.BLEND_WEIGHT,
) -> DataFrame:
    """One row per series: MAE of both models and the blend, champion, weight advice,
    naive MAEs and the two warnings. ``baselines`` has keys, seasonal_naive, persistence."""
    y = F.col("y")
    base = wide.groupBy(*keys).agg(
        E.mae(y, F.col(first)).alias(f"{first}_mae"),
        E.mae(y, F.col(second)).alias(f"{second}_mae"),
        E.mae(y, E.blend(F.col(first), F.col(second), weight)).alias("ensemble_mae"),
        F.count("*").alias("n_holdout"),
    )
    best = best_weight(weight_curve(wide, first, second, keys), keys)
    df = base.join(best, keys).join(baselines, keys, "left")
    return df.withColumns(
        {
            "champion": F.when(F.col(f"{first}_mae") <= F.col(f"{second}_mae"), first).otherwise(second),
            "config_weight": F.lit(weight),
            "loses_to_naive": (F.col("ensemble_mae") >= F.col("seasonal_naive")).cast("int"),
            "weight_suboptimal": (
                (F.abs(F.col("best_weight") - weight) > 1e-9)
                & (F.col("ensemble_mae") - F.col("best_mae") > 0.001)
            ).cast("int"),
        }
    )
