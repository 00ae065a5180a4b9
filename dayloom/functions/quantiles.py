"""Exact percentiles of groups of any size.

The ranks wanted are bracketed: one scan gives, for every group and percentile, two values of a
mergeable sketch that have the rank between them. A second scan counts what lies below a bracket
and keeps only what lies inside, a few rows in ten thousand. Both counts are combined before the
shuffle, and the inside of a bracket is divided into parts of its range before anything is sorted,
so no task ever holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.session import stage

#: The sketch's ranks are off by one row in so many at most.
ACCURACY = 10_000
#: Parts of a bracket's range.
PARTS = 256


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    accuracy: int = ACCURACY,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per key with one column per entry of ``probs`` (linear interpolation).

    ``extra`` aggregates of the same groups are taken in the first scan. Nulls and NaN are left
    out; a group without other values has no row, or with ``extra`` one with null percentiles.
    A bracket that misses its rank is taken wider and looked at again, so the result does not rest
    on the sketch's bound.
    """
    if not keys:
        raise ValueError("exact_percentiles needs at least one key; use a constant column")
    v = F.col(value).cast("double")
    rows = df.withColumn("_v", F.when(~F.isnan(v), v))
    found, width = None, 2 / accuracy
    while True:
        edges = [F.lit(min(1.0, max(0.0, p + side))) for p in probs.values() for side in (-width, width)]
        brackets = rows.groupBy(*keys).agg(
            F.count("_v").alias("_total"),
            F.percentile_approx("_v", F.array(*edges, F.lit(0.0), F.lit(1.0)), F.lit(accuracy)).alias("_edges"),
            *extra,
        )
        # where neighbouring ranks are further apart than brackets are wide, all rows are inside
        whole = F.transform("_edges", lambda e, i: F.element_at("_edges", F.when(i % 2 == 0, -2).otherwise(-1)))
        brackets = brackets.withColumn("_edges", F.when(F.col("_total") <= 4 * accuracy, whole).otherwise(F.col("_edges")))
        brackets = stage(brackets, "brackets")
        found = stage(_inside(rows.select(*keys, "_v"), brackets, keys, probs), "percentiles")
        # a rank in no bracket leaves its percentile open
        if width >= 1 or found.where(" OR ".join(f"`{n}` IS NULL" for n in probs)).isEmpty():
            break
        width *= 8
    if not extra:
        return found
    return _null_safe_join(brackets.drop("_total", "_edges"), found, keys, "left")


def _inside(rows: DataFrame, brackets: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """The percentiles from rows and their groups' brackets."""
    placed = _null_safe_join(rows.where("_v IS NOT NULL"), brackets.select(*keys, "_edges", "_total"), keys)
    lo, hi = F.col("_edges")[F.col("_p") * 2], F.col("_edges")[F.col("_p") * 2 + 1]
    own = F.filter(
        F.sequence(F.lit(0), F.lit(len(probs) - 1)), lambda p: F.col("_v") <= F.col("_edges")[p * 2 + 1]
    )
    span = F.when(hi > lo, (F.col("_v") - lo) / (hi - lo)).otherwise(0)
    # below the bracket: one row a task; inside: one row for every value
    part = F.when(F.col("_v") < lo, -1).otherwise(F.least(F.floor(span * PARTS), F.lit(PARTS - 1))).cast("int")
    counted = (
        placed.withColumn("_p", F.explode(own))
        .withColumns({"_part": part, "_v": F.when(F.col("_v") >= lo, F.col("_v"))})
        .groupBy(*keys, "_p", "_part", "_v").agg(F.count("*").alias("_n"), F.first("_total").alias("_total"))
    )
    counted = stage(counted, "bracket-rows")

    sizes = counted.groupBy(*keys, "_p", "_part").agg(F.sum("_n").alias("_size"), F.first("_total").alias("_total"))
    upto = Window.partitionBy(*keys, "_p").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row a part: these windows are small
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(upto), F.lit(0)))
    share = F.get(F.array(*[F.lit(p) for p in probs.values()]), F.col("_p"))
    sizes = sizes.withColumn("_pos", (F.col("_total") - 1) * share)
    needed = sizes.where(
        (F.col("_part") >= 0) & (F.ceil("_pos") >= F.col("_before"))
        & (F.floor("_pos") < F.col("_before") + F.col("_size"))
    ).select(*keys, "_p", "_part", "_before", "_pos")
    order = Window.partitionBy(*keys, "_p", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    left = _null_safe_join(counted.drop("_total"), needed, [*keys, "_p", "_part"])
    left = left.withColumn("_hi", F.col("_before") + F.sum("_n").over(order)).withColumn("_lo", F.col("_hi") - F.col("_n"))
    lower = (F.floor("_pos") >= F.col("_lo")) & (F.floor("_pos") < F.col("_hi"))
    upper = (F.ceil("_pos") >= F.col("_lo")) & (F.ceil("_pos") < F.col("_hi"))
    some = brackets.where("_total > 0").select(*keys)
    got = left.where(lower | upper).groupBy(*keys).agg(
        *[_interpolated(F.col("_p") == i, lower, upper).alias(name) for i, name in enumerate(probs)]
    )
    return _null_safe_join(some, got, keys, "left")


def _interpolated(mine: Column, lower: Column, upper: Column) -> Column:
    low = F.max(F.when(mine & lower, F.col("_v")))
    high = F.max(F.when(mine & upper, F.col("_v")))
    pos = F.max(F.when(mine, F.col("_pos")))
    return low + (high - low) * (pos - F.floor(pos))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
