"""Exploratory statistics. Column-wise reports are one aggregate each, turned into rows
afterwards, so the data is scanned once whatever the number of columns."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.functions.quantiles import exact_percentiles
from dayloom.operators.features import SERIES, by_day, position, whole


def _as_rows(row: DataFrame, entries: list[tuple[Column, Column]], names: tuple[str, str], keep=()):
    """Columns of a small aggregate → one row per entry."""
    pairs = F.array(*[F.struct(k.alias("k"), v.alias("v")) for k, v in entries])
    return row.select(*keep, F.explode(pairs).alias("_e")).select(
        *keep, F.col("_e.k").alias(names[0]), F.col("_e.v").alias(names[1])
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _as_rows(row, [(F.lit(c), F.col(c)) for c in columns], ("column", "n_missing"))


def distinct_counts(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Distinct values per column and whether the column is constant.

    Exact counts go through (column, value) pairs: values are made unique map-side, then
    counted with a plain sum, so no task holds a column's whole value set.
    """
    if not exact:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        out = _as_rows(row, [(F.lit(c), F.col(c)) for c in columns], ("column", "n_distinct"))
    else:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
        )
        out = (
            df.select(F.explode(pairs).alias("_e"))
            .groupBy(F.col("_e.c").alias("column"), F.col("_e.v").alias("_v"))
            .agg(F.lit(1).alias("_one"))
            .groupBy("column")
            .agg(F.count("_v").alias("n_distinct"))
        )
    return out.withColumn("is_constant", (F.col("n_distinct") <= 1).cast("int"))


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), column)
        .limit(n)
    )


def describe_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per group of raw rows, in two scans."""
    basics = [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    return exact_percentiles(df, keys, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, extra=basics)


def boxplot(panel: DataFrame, keys: list[str], value: str = "y") -> DataFrame:
    """Five-number summary with the 1.5 × IQR fences. Groups hold daily rows, so their
    size is bounded by the calendar."""
    q = panel.groupBy(*keys).agg(
        F.min(value).alias("low"),
        F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.max(value).alias("high"),
    )
    q1, q2, q3 = (F.col("_q")[i] for i in range(3))
    return q.select(
        *keys,
        "low",
        q1.alias("q1"),
        q2.alias("median"),
        q3.alias("q3"),
        "high",
        (q1 - 1.5 * (q3 - q1)).alias("lower_fence"),
        (q3 + 1.5 * (q3 - q1)).alias("upper_fence"),
    )


def correlation_matrix(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """All pairs of columns from one aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r"))
            for a, b in pairs
        ]
    )
    return row.select(*keys, F.explode(cells).alias("_c")).select(
        *keys,
        F.col("_c.a").alias("left_column"),
        F.col("_c.b").alias("right_column"),
        F.col("_c.r").alias("r"),
    )


def target_correlation(df: DataFrame, target: str, columns: list[str], keys: list[str] = ()):
    row = df.groupBy(*keys).agg(*[F.corr(c, target).alias(c) for c in columns])
    return _as_rows(row, [(F.lit(c), F.col(c)) for c in columns], ("column", "r"), keys)


def trend_line(df: DataFrame, x: str, y: str, keys: list[str] = SERIES, points: int = 100):
    """Straight-line fit of y on x and the line at evenly spaced points."""
    fit = (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(*keys)
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.corr(x, y).alias("r"),
            F.min(x).alias("_lo"),
            F.max(x).alias("_hi"),
        )
    )
    at = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("point") / F.lit(points - 1))
    return (
        fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", at)
        .withColumn("line", F.col("intercept") + F.col("slope") * F.col("x"))
        .drop("_lo", "_hi")
    )


def decompose(panel: DataFrame, period: int = S.SEASON, keys: list[str] = SERIES) -> DataFrame:
    """Additive trend + season + residual of a gap-free series (odd period)."""
    half = period // 2
    centred = by_day(keys).rowsBetween(-half, half)
    df = panel.withColumns(
        {
            "trend": F.when(F.count("y").over(centred) == period, F.avg("y").over(centred)),
            "_phase": position(keys) % period,
        }
    )
    off = F.col("y") - F.col("trend")
    phase_means = F.array(
        *[F.avg(F.when(F.col("_phase") == i, off)).over(whole(keys)) for i in range(period)]
    )
    df = df.withColumn("_means", phase_means)
    centre = F.aggregate("_means", F.lit(0.0), lambda a, v: a + v) / period
    df = df.withColumn("seasonal", F.get("_means", F.col("_phase")) - centre)
    return df.withColumn("resid", F.col("y") - F.col("trend") - F.col("seasonal")).drop(
        "_phase", "_means"
    )


def autocorrelation(panel: DataFrame, max_lag: int = 60, keys: list[str] = SERIES) -> DataFrame:
    """Autocorrelation for lags 1…max_lag. All lags are columns of one window pass and one
    aggregate; no row is copied per lag and nothing is joined."""
    return _acf_arrays(panel, max_lag, keys).select(
        *keys, F.posexplode("acf").alias("_i", "acf")
    ).select(*keys, (F.col("_i") + 1).alias("lag"), "acf")


def _acf_arrays(panel: DataFrame, max_lag: int, keys: list[str]) -> DataFrame:
    dev = panel.select(*keys, "ds", (F.col("y") - F.avg("y").over(whole(keys))).alias("_d"))
    shifted = dev.select(
        *keys, "_d", *[F.lag("_d", k).over(by_day(keys)).alias(f"_l{k}") for k in range(1, max_lag + 1)]
    )
    sums = shifted.groupBy(*keys).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_ss"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)],
    )
    acf = F.array(*[F.try_divide(F.col(f"_s{k}"), F.col("_ss")) for k in range(1, max_lag + 1)])
    return sums.select(*keys, acf.alias("acf"))


def partial_autocorrelation(panel: DataFrame, max_lag: int = 30, keys: list[str] = SERIES):
    """Yule–Walker partial autocorrelation. The sums are one aggregate; the recursion runs
    over the ``max_lag`` numbers of each series, inside an expression."""

    def step(state: Column, k: Column) -> Column:
        """state.phi: coefficients of order k−1; state.out: partial values so far."""
        phi, r = state["phi"], F.col("acf")
        index = F.filter(F.sequence(F.lit(1), F.lit(max_lag)), lambda j: j < k)
        num = F.get(r, k - 1) - F.aggregate(
            index, F.lit(0.0), lambda a, j: a + F.get(phi, j - 1) * F.get(r, k - j - 1)
        )
        den = F.lit(1.0) - F.aggregate(
            index, F.lit(0.0), lambda a, j: a + F.get(phi, j - 1) * F.get(r, j - 1)
        )
        last = F.try_divide(num, den)
        # ``last`` is needed in several places: compute it once in a one-element array.
        grown = F.get(
            F.transform(
                F.array(last),
                lambda p: F.struct(
                    F.concat(
                        F.transform(
                            index, lambda j: F.get(phi, j - 1) - p * F.get(phi, k - j - 1)
                        ),
                        F.array(p),
                    ).alias("phi"),
                    F.concat(state["out"], F.array(p)).alias("out"),
                ),
            ),
            0,
        )
        return grown

    empty = F.array().cast("array<double>")
    acf = _acf_arrays(panel, max_lag, keys)
    out = acf.select(
        *keys,
        F.aggregate(
            F.sequence(F.lit(1), F.lit(max_lag)),
            F.struct(empty.alias("phi"), empty.alias("out")),
            step,
            lambda s: s["out"],
        ).alias("_pacf"),
    )
    return out.select(*keys, F.posexplode("_pacf").alias("_i", "pacf")).select(
        *keys, (F.col("_i") + 1).alias("lag"), "pacf"
    )


# Large-sample critical values of the unit-root test with a constant.
ADF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def unit_root_test(panel: DataFrame, lags: int = 1, keys: list[str] = SERIES) -> DataFrame:
    """Augmented Dickey–Fuller statistic with a fixed number of lagged differences."""
    from dayloom.operators.linear import fit_linear

    w = by_day(keys)
    df = panel.where(F.col("y").isNotNull())
    df = df.withColumn("_level", F.lag("y", 1).over(w)).withColumn("_diff", F.col("y") - F.col("_level"))
    df = df.withColumns({f"_dlag{k}": F.lag("_diff", k).over(w) for k in range(1, lags + 1)})
    names = ["_level"] + [f"_dlag{k}" for k in range(1, lags + 1)]
    fit = fit_linear(df.na.drop(subset=["_diff", *names]), names, "_diff", keys)
    stat = F.try_divide(F.col("coef")[1], F.col("std_err")[1])
    return fit.select(
        *keys,
        stat.alias("adf"),
        F.lit(ADF_CRITICAL["5%"]).alias("critical_5pct"),
        (stat <= ADF_CRITICAL["5%"]).cast("int").alias("is_stationary"),
        F.col("n_rows").alias("n_rows"),
    )


def smallest(df: DataFrame, by: str, ties: list[str], n: int = 10) -> DataFrame:
    return df.where(F.col(by).isNotNull()).orderBy(by, *ties).limit(n)


def most_common(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """The most frequent value per key; the smallest one on ties. Counting first keeps the
    work spread out whatever the size of a group."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(col)
    )
