"""The given tables as demand data, and the registry of queries.

Orders are the facts (series: order priority), line items give one weather-like row per
shipping day. Money and rates have two decimals, so daily totals are summed as whole cents:
the result does not depend on the order in which partial sums meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.operators.panel import join_covariates
from dayloom.plans.gold import daily_panel
from dayloom.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def entry(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def hundredths(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("long")


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per priority and order day: ``series_id, ds, y``."""
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderdate").isNotNull())
        .groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("ds"))
        .agg((F.sum(hundredths("o_totalprice")) / 100).alias("y"))
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One row per shipping day: ``ds, temp, precip, snow``."""
    n = F.count("*")
    heavy = F.when(F.col("l_quantity") == 50, hundredths("l_tax")).otherwise(F.lit(0))
    return (
        table(spark, sf, "lineitem")
        .where(F.col("l_shipdate").isNotNull())
        .groupBy(F.to_date("l_shipdate").alias("ds"))
        .agg(
            (F.sum(hundredths("l_discount")) / n).alias("temp"),
            (F.sum(hundredths("l_tax")) / n).alias("precip"),
            (F.sum(heavy) / n).alias("snow"),
        )
    )


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return join_covariates(facts(spark, sf), weather(spark, sf))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return daily_panel(silver(spark, sf))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """The panel as a written table, for queries that read it more than once."""
    return stage(panel(spark, sf), "gold")


def rounded(df: DataFrame, digits: int = 9, **special: int) -> DataFrame:
    """Rounds floating columns for comparison across engines; adding 0 turns −0 into 0."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            (F.round(c, special.get(c, digits)) + 0.0).alias(c) if kinds[c] == "double" else F.col(c)
            for c in df.columns
        ]
    )


# --- SQL building blocks: the same definitions, as common table expressions ---

FACTS = """
facts AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds,
         CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS y
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2)"""

WEATHER = """
weather AS (
  SELECT CAST(l_shipdate AS DATE) AS ds,
         CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS temp,
         CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS precip,
         CAST(SUM(CASE WHEN l_quantity = 50 THEN CAST(ROUND(l_tax * 100) AS BIGINT) ELSE 0 END) AS DOUBLE)
           / COUNT(*) AS snow
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1)"""

SILVER = f"""{FACTS},{WEATHER},
silver AS (
  SELECT f.series_id, f.ds, f.y, w.temp, w.precip, w.snow
  FROM facts f LEFT JOIN weather w ON w.ds = f.ds)"""


def filled_cte(source: str, out: str) -> str:
    """Gap filling by spine join and bracketing dates."""
    return f"""
{out}_spine AS (
  SELECT series_id, CAST(UNNEST(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM {source} GROUP BY series_id),
{out}_raw AS (
  SELECT s.series_id, s.ds, d.y, d.temp, COALESCE(d.precip, 0) AS precip, COALESCE(d.snow, 0) AS snow
  FROM {out}_spine s LEFT JOIN {source} d ON d.series_id = s.series_id AND d.ds = s.ds),
{out}_near AS (
  SELECT *,
    MAX(CASE WHEN y IS NOT NULL THEN ds END) OVER (PARTITION BY series_id ORDER BY ds
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS yp,
    MIN(CASE WHEN y IS NOT NULL THEN ds END) OVER (PARTITION BY series_id ORDER BY ds
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS yn,
    MAX(CASE WHEN temp IS NOT NULL THEN ds END) OVER (PARTITION BY series_id ORDER BY ds
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    MIN(CASE WHEN temp IS NOT NULL THEN ds END) OVER (PARTITION BY series_id ORDER BY ds
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tn
  FROM {out}_raw),
{out} AS (
  SELECT k.series_id, k.ds,
    CASE WHEN k.y IS NOT NULL THEN k.y WHEN k.yn IS NULL THEN y0.y
         ELSE y0.y + (y1.y - y0.y) * (CAST(k.ds - k.yp AS DOUBLE) / (k.yn - k.yp)) END AS y,
    CASE WHEN k.temp IS NOT NULL THEN k.temp WHEN k.tn IS NULL THEN t0.temp
         ELSE t0.temp + (t1.temp - t0.temp) * (CAST(k.ds - k.tp AS DOUBLE) / (k.tn - k.tp)) END AS temp,
    k.precip, k.snow
  FROM {out}_near k
  LEFT JOIN {source} y0 ON y0.series_id = k.series_id AND y0.ds = k.yp
  LEFT JOIN {source} y1 ON y1.series_id = k.series_id AND y1.ds = k.yn
  LEFT JOIN {source} t0 ON t0.series_id = k.series_id AND t0.ds = k.tp
  LEFT JOIN {source} t1 ON t1.series_id = k.series_id AND t1.ds = k.tn)"""


def holiday_sql(d: str) -> str:
    """Federal holiday test on a date expression, with observed days."""

    def fixed(x: str) -> str:
        return (
            f"(strftime({x}, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25')"
            f" OR (strftime({x}, '%m-%d') = '06-19' AND year({x}) >= 2021))"
        )

    nth = f"CAST(CEIL(day({d}) / 7.0) AS INTEGER)"
    monday, thursday = f"isodow({d}) = 1", f"isodow({d}) = 4"
    return f"""(CASE WHEN {fixed(d)}
      OR (isodow({d}) = 5 AND {fixed(f'({d} + 1)')}) OR (isodow({d}) = 1 AND {fixed(f'({d} - 1)')})
      OR ({monday} AND month({d}) IN (1, 2) AND {nth} = 3)
      OR ({monday} AND month({d}) = 5 AND day({d}) + 7 > 31)
      OR ({monday} AND month({d}) = 9 AND {nth} = 1)
      OR ({monday} AND month({d}) = 10 AND {nth} = 2)
      OR ({thursday} AND month({d}) = 11 AND {nth} = 4) THEN 1 ELSE 0 END)"""


ROUNDED_SILVER = """
rsilver AS (
  SELECT series_id, ds, ROUND(y, 6) AS y, ROUND(temp, 6) AS temp, ROUND(precip, 6) AS precip,
         ROUND(snow, 6) AS snow FROM silver)"""

# gold: the gap-free panel with holiday flag and yesterday's snow.
GOLD = f"""{SILVER},{ROUNDED_SILVER},{filled_cte('rsilver', 'filled')},
gold AS (
  SELECT *, {holiday_sql('ds')} AS is_holiday,
    COALESCE(LAG(snow) OVER (PARTITION BY series_id ORDER BY ds), 0) AS snow_lag1
  FROM filled)"""

W = "OVER (PARTITION BY series_id ORDER BY ds)"


def frame(a: int, b: int) -> str:
    def side(n: int) -> str:
        return "CURRENT ROW" if n == 0 else f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}"

    return f"OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN {side(a)} AND {side(b)})"


def trailing_sql(fn: str, col: str, a: int, b: int) -> str:
    size = b - a + 1
    return f"CASE WHEN COUNT({col}) {frame(a, b)} = {size} THEN {fn}({col}) {frame(a, b)} END"


FEATURES = f"""{GOLD},
feat AS (
  SELECT *, CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week, CAST(month(ds) AS INTEGER) AS month,
    CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    LAG(y, 1) {W} / 1e6 AS y_lag1, LAG(y, 2) {W} / 1e6 AS y_lag2, LAG(y, 3) {W} / 1e6 AS y_lag3,
    LAG(y, 7) {W} / 1e6 AS y_lag7, LAG(y, 14) {W} / 1e6 AS y_lag14,
    {trailing_sql('AVG', 'y', -14, -1)} / 1e6 AS y_mean14,
    {trailing_sql('STDDEV_SAMP', 'y', -7, -1)} / 1e6 AS y_std7,
    LAG(precip) {W} AS precip_lag1, LAG(temp) {W} AS temp_lag1
  FROM gold),
features AS (
  SELECT * FROM feat WHERE temp IS NOT NULL AND y_lag14 IS NOT NULL AND y_mean14 IS NOT NULL
    AND y_std7 IS NOT NULL AND precip_lag1 IS NOT NULL AND temp_lag1 IS NOT NULL)"""
