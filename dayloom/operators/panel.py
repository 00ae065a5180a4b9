"""Raw facts → silver rows → gap-free daily panels.

Shuffle budget: raw rows are combined map-side into one row per (series, day) before the
first exchange, so a series that holds a third of all raw rows still travels as one row per
day. All later per-series work runs over at most one row per calendar day.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S


def require_columns(df: DataFrame, required: set[str]) -> DataFrame:
    missing = required - set(df.columns)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    return df


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Optional columns that are absent come in as NULL of the given type."""
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    )


def nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def rollup_daily(
    facts: DataFrame,
    keys: list[str],
    sums: list[str],
    means: list[str] | None = None,
    digits: int | None = 6,
) -> DataFrame:
    """Daily totals and means per key.

    Double sums depend on the order in which partial results arrive; ``digits`` rounds
    that noise away, so a task that is run again after a lost executor gives the same row.
    A NaN counts as a missing value.
    """
    facts = nan_to_null(facts, [c for c, kind in facts.dtypes if kind in ("double", "float") and c in [*sums, *(means or [])]])

    def tidy(col: Column) -> Column:
        return col if digits is None else F.round(col, digits)

    aggs = [tidy(F.coalesce(F.sum(c), F.lit(0.0))).alias(c) for c in sums]
    aggs += [tidy(F.avg(c)).alias(c) for c in means or []]
    return facts.where(F.col("ds").isNotNull()).groupBy(*keys, "ds").agg(*aggs)


def rollup_hierarchy(facts: DataFrame, levels: list[str], value: str = "y") -> DataFrame:
    """Grand total, each level and the leaves per day, in one pass: facts are brought to one
    row per leaf and day first, so the rollup expands only those."""
    leaves = rollup_daily(facts, levels, [value])
    sets = [[*levels[:i], "ds"] for i in range(len(levels) + 1)]
    level = sum((F.lit(1) - F.grouping(c) for c in levels), F.lit(0)).cast("int")
    return (
        leaves.groupingSets(sets, *levels, "ds")
        .agg(level.alias("level"), F.round(F.sum(value), 6).alias(value))
        .select(*levels, "level", "ds", value)
    )


def latest_per_day(dim: DataFrame, order: Column, key: str = "ds") -> DataFrame:
    """One row per day where files overlap: the row with the greatest ``order`` wins."""
    rest = [c for c in dim.columns if c != key]
    picked = dim.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_arrival(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key in arrival order. An aggregate, not a row number: copies
    are combined before the shuffle, so a key with very many copies is no hot spot."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def join_covariates(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Every fact row with its day's covariates. ``dim`` must be unique per day."""
    return facts.join(dim, "ds", "left")


def covered_days(dim: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows of a daily dimension whose day occurs in the facts. The facts are reduced to
    their distinct days map-side, so the join sees one row per day, not per fact."""
    return dim.join(facts.select("ds").distinct(), "ds", "left_semi")


def newer_than(df: DataFrame, watermark: Column) -> DataFrame:
    return df.where(F.col("ds") > watermark)


def high_watermark(table: DataFrame, late_days: int = 0) -> Column:
    """max(ds) of a table as a scalar subquery; long ago when the table is empty."""
    top = table.agg(F.max("ds").alias("w")).scalar()
    return F.date_sub(F.coalesce(top, F.lit(S.NO_DATE).cast("date")), late_days)


def merge_silver(
    existing: DataFrame,
    facts: DataFrame,
    covariates: DataFrame,
    arrival: Column,
    late_days: int = 0,
    watermark: dt.date | None = None,
) -> DataFrame:
    """Add the days after the watermark to silver.

    Old and new rows cannot overlap (new days are past the watermark), so only the new rows
    are made distinct; the old table is not shuffled again. A ``watermark`` from the log is a
    plain value that prunes files and partitions; without one the table's newest day is looked up.
    """
    require_columns(facts, {"ds", "y"})
    require_columns(covariates, {"ds"})
    floor = F.date_sub(F.lit(watermark), late_days) if watermark else high_watermark(existing, late_days)
    fresh = newer_than(facts, floor).dropDuplicates()
    days = latest_per_day(covered_days(covariates, fresh), arrival)
    merged = join_covariates(fresh, days)
    kept = existing
    if late_days:
        kept = existing.where(F.col("ds") <= floor)
    return kept.unionByName(merged, allowMissingColumns=True)


def missing_days(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Days without a row, from each row's gap to its successor: no spine, no anti-join."""
    w = Window.partitionBy(*keys).orderBy("ds")
    gap = panel.select(*keys, "ds", F.lead("ds").over(w).alias("_next")).where(
        F.datediff("_next", "ds") > 1
    )
    return gap.select(
        *keys, F.explode(F.sequence(F.date_add("ds", 1), F.date_sub("_next", 1))).alias("ds")
    )


def fill_gaps(
    panel: DataFrame, keys: list[str], interpolate: list[str], zero_fill: list[str]
) -> DataFrame:
    """Insert missing days; interpolate some columns linearly and set others to 0.

    A leading gap stays NULL and a trailing gap repeats the last value. Each row makes the
    days up to its successor itself, so the whole step is one window over the series: no
    spine table and no join.
    """
    by_series = Window.partitionBy(*keys).orderBy("ds")
    upto = by_series.rowsBetween(Window.unboundedPreceding, 0)
    spec = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY ds)"

    points = {
        f"_at_{c}": F.when(
            F.col(c).isNotNull(), F.struct(F.col("ds").alias("d"), F.col(c).cast("double").alias("v"))
        )
        for c in interpolate
    }
    framed = panel.withColumns(points)
    around = {"_next": F.lead("ds").over(by_series)}
    for c in interpolate:
        around[f"_prev_{c}"] = F.last(f"_at_{c}", ignorenulls=True).over(upto)
        around[f"_foll_{c}"] = F.expr(f"lead(`_at_{c}`, 1) IGNORE NULLS {spec}")
    framed = framed.withColumns(around)
    until = F.coalesce(F.date_sub("_next", 1), F.col("ds"))
    days = framed.withColumn("_day", F.explode(F.sequence("ds", until)))

    own = F.col("_day") == F.col("ds")
    out = [F.col(k) for k in keys] + [F.col("_day").alias("ds")]
    for c in panel.columns:
        if c in keys or c == "ds":
            continue
        if c in interpolate:
            prev, foll = F.col(f"_prev_{c}"), F.col(f"_foll_{c}")
            share = F.datediff("_day", prev["d"]) / F.datediff(foll["d"], prev["d"])
            line = F.when(foll.isNull(), prev["v"]).otherwise(
                prev["v"] + (foll["v"] - prev["v"]) * share
            )
            out.append(line.alias(c))
        elif c in zero_fill:
            out.append(F.when(own, F.coalesce(F.col(c), F.lit(0.0))).otherwise(F.lit(0.0)).alias(c))
        else:
            out.append(F.when(own, F.col(c)).alias(c))
    return days.select(*out)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
