"""Scores, weights and significance of backtests; training baselines and the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.catalog import base as B
from dayloom.catalog.base import entry
from dayloom.catalog.forecasts import FITTED
from dayloom.operators import backtest as BT
from dayloom.operators import forecast as FC
from dayloom.operators import registry as RG
from dayloom.operators import reports as R
from dayloom.plans import training

MODELS = ["linear", "seasonal_naive", "persistence", "ensemble"]

LONG = f"""{FITTED},
    long AS (SELECT series_id, origin, h, y, 'linear' AS model, linear AS yhat FROM wide
      UNION ALL SELECT series_id, origin, h, y, 'seasonal_naive', seasonal_naive FROM wide
      UNION ALL SELECT series_id, origin, h, y, 'persistence', persistence FROM wide
      UNION ALL SELECT series_id, origin, h, y, 'ensemble', 0.5::DOUBLE * linear + 0.5::DOUBLE * seasonal_naive FROM wide),
    marks AS (SELECT series_id, model, COUNT(*) AS n_points, AVG(ABS(yhat - y)) AS mae, SQRT(AVG((yhat - y) * (yhat - y))) AS rmse,
      AVG(ABS(yhat - y) / GREATEST(ABS(y), 2.220446049250313e-16)) * 100 AS mape_pct, AVG(yhat - y) AS bias
      FROM long GROUP BY 1, 2)"""


def scored_cases(panel):
    """The fitted linear model, both baselines and the blend of the model with the seasonal one."""
    cases = training.linear_backtest(panel)
    return cases.withColumn("ensemble", FC.blend_arrays(F.col("linear"), F.col("seasonal_naive")))


@entry(
    "backtest_scores",
    f"""WITH RECURSIVE {LONG}, b AS (SELECT series_id, mae AS naive FROM marks WHERE model = 'seasonal_naive')
    SELECT marks.series_id, model, n_points, ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse, ROUND(mape_pct, 4) AS mape_pct,
      ROUND(bias, 6) + 0.0 AS bias, CASE WHEN model = 'seasonal_naive' THEN 1.0 ELSE ROUND(mae / naive, 5) END::DOUBLE AS mase
    FROM marks JOIN b ON b.series_id = marks.series_id""",
)
def backtest_scores(spark, sf):
    """MAE, RMSE, MAPE, bias and relative MAE per model."""
    out = BT.relative_mae(BT.score(FC.to_long(scored_cases(B.gold(spark, sf)), MODELS)))
    return B.rounded(out, 6, mape_pct=4, mase=5)


@entry(
    "mae_by_horizon",
    f"""WITH RECURSIVE {LONG} SELECT series_id, model, h, ROUND(AVG(ABS(yhat - y)), 6) AS mae,
      ROUND(STDDEV_SAMP(yhat - y), 6) AS sigma, COUNT(*) AS n_origins FROM long GROUP BY 1, 2, 3""",
)
def mae_by_horizon(spark, sf):
    """Error by step ahead."""
    return B.rounded(BT.mae_by_step(FC.to_long(scored_cases(B.gold(spark, sf)), MODELS)), 6)


CURVE = f"""{FITTED},
    ws AS (SELECT CAST(UNNEST(range(0, 21)) AS DOUBLE) * 5 / 100 AS w),
    curve AS (SELECT series_id, w AS weight, AVG(ABS(w * linear + (1 - w) * seasonal_naive - y)) AS mae
      FROM wide CROSS JOIN ws GROUP BY 1, 2)"""


@entry(
    "weight_curve",
    f"WITH RECURSIVE {CURVE} SELECT series_id, weight, ROUND(mae, 6) AS mae FROM curve",
)
def weight_curve(spark, sf):
    """MAE of the blend at 21 weights."""
    wide = FC.to_wide(training.linear_backtest(B.gold(spark, sf)), ["linear", "seasonal_naive"])
    return B.rounded(BT.weight_curve(wide, "linear", "seasonal_naive"), 6)


@entry(
    "best_weight",
    f"""WITH RECURSIVE {CURVE} SELECT series_id, arg_min(weight, (ROUND(mae, 12), weight)) AS best_weight,
      ROUND(MIN(mae), 6) AS best_mae FROM curve GROUP BY 1""",
)
def best_weight(spark, sf):
    """The best weight, lowest on ties."""
    wide = FC.to_wide(training.linear_backtest(B.gold(spark, sf)), ["linear", "seasonal_naive"])
    return B.rounded(BT.best_weight(BT.weight_curve(wide, "linear", "seasonal_naive")), 6)


def _boot_sql(n_boot: int) -> str:
    pairs = [("linear", "seasonal_naive"), ("ensemble", "seasonal_naive"), ("ensemble", "linear")]
    value = {
        "linear": "linear",
        "seasonal_naive": "seasonal_naive",
        "ensemble": "(0.5::DOUBLE * linear + 0.5::DOUBLE * seasonal_naive)",
    }
    sums = ", ".join(
        f"SUM(ABS({value[a]} - y)) - SUM(ABS({value[b]} - y)) AS d{i}" for i, (a, b) in enumerate(pairs)
    )
    out = " UNION ALL ".join(
        f"""SELECT series_id, '{a}_vs_{b}' AS pair, '{a}' AS p1, '{b}' AS p2, AVG(diff{i}) AS dmae,
        QUANTILE_CONT(diff{i}, 0.025) AS ci_lo, QUANTILE_CONT(diff{i}, 0.975) AS ci_hi FROM diffs GROUP BY 1"""
        for i, (a, b) in enumerate(pairs)
    )
    return f"""WITH RECURSIVE {FITTED},
    blocks AS (SELECT series_id, origin, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY origin) - 1 AS pos,
      COUNT(*) OVER (PARTITION BY series_id) AS k, n, d0, d1, d2
      FROM (SELECT series_id, origin, CAST(COUNT(*) AS DOUBLE) AS n, {sums} FROM wide GROUP BY 1, 2)),
    ks AS (SELECT DISTINCT series_id, k FROM blocks),
    draws AS (SELECT series_id, b, FLOOR(CAST('0x' || substr(md5('0:' || b || ':' || (j // 4)), 1 + 8 * (j % 4), 8) AS BIGINT)
        / 4294967296.0::DOUBLE * k) AS pos
      FROM ks, (SELECT CAST(UNNEST(range(0, {n_boot})) AS INTEGER) AS b), (SELECT CAST(UNNEST(range(0, 11)) AS INTEGER) AS j) WHERE j < k),
    diffs AS (SELECT d.series_id, d.b, SUM(d0) / SUM(n) AS diff0, SUM(d1) / SUM(n) AS diff1, SUM(d2) / SUM(n) AS diff2
      FROM draws d JOIN blocks x ON x.series_id = d.series_id AND x.pos = d.pos GROUP BY 1, 2),
    u AS ({out})
    SELECT series_id, pair, ROUND(dmae, 6) + 0.0 AS dmae, ROUND(ci_lo, 6) + 0.0 AS ci_lo, ROUND(ci_hi, 6) + 0.0 AS ci_hi,
      CASE WHEN ci_hi < 0 THEN 'first' WHEN ci_lo > 0 THEN 'second' ELSE 'tie' END AS verdict FROM u"""


@entry("block_bootstrap", _boot_sql(S.N_BOOT))
def block_bootstrap(spark, sf):
    """Resampled intervals of three MAE differences and their verdicts."""
    pairs = [("linear", "seasonal_naive"), ("ensemble", "seasonal_naive"), ("ensemble", "linear")]
    cases = scored_cases(B.gold(spark, sf))
    return B.rounded(BT.block_bootstrap(cases, pairs, max_blocks=FC.origin_count()), 6)


@entry("family_bootstrap")
def family_bootstrap(spark, sf):
    """The same for both fitted families and their ensemble."""
    pairs = [("linear", "trees"), ("ensemble", "trees"), ("ensemble", "linear")]
    cases = training.full_backtest(B.gold(spark, sf))
    return B.rounded(BT.block_bootstrap(cases, pairs, max_blocks=FC.origin_count()), 6)


@entry("family_baseline")
def family_baseline(spark, sf):
    """The record after training: both families on the common holdout, champion, weight advice."""
    panel = B.gold(spark, sf)
    wide = FC.to_wide(training.holdout_paths(panel), ["linear", "trees"])
    one = FC.one_step_baselines(panel)
    naive = one.groupBy("series_id").agg(
        F.avg(F.abs(F.col("seasonal_naive") - F.col("y"))).alias("seasonal_naive"),
        F.avg(F.abs(F.col("persistence") - F.col("y"))).alias("persistence"),
    )
    return B.rounded(BT.training_baseline(wide, "linear", "trees", naive), 6)


BASELINE = f"""{CURVE},
    onestep AS (SELECT series_id, y / 1e6 AS y, LAG(y, 1) {B.W} / 1e6 AS p, LAG(y, 7) {B.W} / 1e6 AS s,
      MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM gold),
    nb AS (SELECT series_id, AVG(ABS(s - y)) AS seasonal_naive, AVG(ABS(p - y)) AS persistence
      FROM onestep WHERE back < 30 GROUP BY 1),
    m AS (SELECT series_id, AVG(ABS(linear - y)) AS linear_mae, AVG(ABS(seasonal_naive - y)) AS seasonal_naive_mae,
      AVG(ABS(0.5::DOUBLE * linear + 0.5::DOUBLE * seasonal_naive - y)) AS ensemble_mae, COUNT(*) AS n_holdout FROM wide GROUP BY 1),
    bw AS (SELECT series_id, arg_min(weight, (ROUND(mae, 12), weight)) AS best_weight, MIN(mae) AS best_mae FROM curve GROUP BY 1)"""


@entry(
    "training_baseline",
    f"""WITH RECURSIVE {BASELINE}
    SELECT m.series_id, ROUND(linear_mae, 6) AS linear_mae, ROUND(seasonal_naive_mae, 6) AS seasonal_naive_mae,
      ROUND(ensemble_mae, 6) AS ensemble_mae, n_holdout, best_weight, ROUND(best_mae, 6) AS best_mae,
      ROUND(seasonal_naive, 6) AS seasonal_naive, ROUND(persistence, 6) AS persistence,
      CASE WHEN linear_mae <= seasonal_naive_mae THEN 'linear' ELSE 'seasonal_naive' END AS champion,
      CAST(0.5 AS DOUBLE) AS config_weight, CASE WHEN ensemble_mae >= seasonal_naive THEN 1 ELSE 0 END AS loses_to_naive,
      CASE WHEN ABS(best_weight - 0.5) > 1e-9 AND ensemble_mae - best_mae > 0.001 THEN 1 ELSE 0 END AS weight_suboptimal
    FROM m JOIN bw ON bw.series_id = m.series_id JOIN nb ON nb.series_id = m.series_id""",
)
def training_baseline(spark, sf):
    """The record written after training, with both warnings."""
    panel = B.gold(spark, sf)
    wide = FC.to_wide(training.linear_backtest(panel), ["linear", "seasonal_naive"])
    one = FC.one_step_baselines(panel)
    naive = one.groupBy("series_id").agg(
        F.avg(F.abs(F.col("seasonal_naive") - F.col("y"))).alias("seasonal_naive"),
        F.avg(F.abs(F.col("persistence") - F.col("y"))).alias("persistence"),
    )
    return B.rounded(BT.training_baseline(wide, "linear", "seasonal_naive", naive), 6)


@entry(
    "paired_holdouts",
    f"""WITH {B.GOLD}, t AS (SELECT series_id, ds, y / 1e6 AS y, LAG(y, 1) {B.W} / 1e6 AS a, LAG(y, 7) {B.W} / 1e6 AS b,
      MAX(ds) OVER (PARTITION BY series_id) - ds AS back FROM gold)
    SELECT series_id, ds, y, a AS yhat_first, b AS yhat_second, ROUND(0.5 * a + 0.5 * b, 12) AS ensemble
    FROM t WHERE back < 20""",
)
def paired_holdouts(spark, sf):
    """Two models' holdout tables joined on the day."""
    panel = B.gold(spark, sf)
    one = FC.one_step_baselines(panel)
    # One table per model, as two training runs would have written them.
    first = one.select("series_id", "ds", "y", F.col("persistence").alias("yhat_first"))
    second = FC.one_step_baselines(panel, 20).select(
        "series_id", "ds", F.col("seasonal_naive").alias("yhat_second")
    )
    joined = first.join(second, ["series_id", "ds"])
    blend = 0.5 * F.col("yhat_first") + 0.5 * F.col("yhat_second")
    return joined.withColumn("ensemble", F.round(blend, 12))


@entry(
    "skill_table",
    f"""WITH RECURSIVE {LONG}, b AS (SELECT series_id, mae AS naive FROM marks WHERE model = 'seasonal_naive')
    SELECT marks.series_id, model, ROUND(mae, 3) AS mae, ROUND(mae / naive, 2)::DOUBLE AS mase, ROUND(bias, 3) + 0.0 AS bias,
      ROUND((naive - mae) / naive * 100, 3) + 0.0 AS skill_pct FROM marks JOIN b ON b.series_id = marks.series_id WHERE mae IS NOT NULL""",
)
def skill_table(spark, sf):
    """Display table per model and gain over the naive forecast."""
    from pyspark.sql import Window

    s = BT.relative_mae(BT.score(FC.to_long(scored_cases(B.gold(spark, sf)), MODELS)))
    naive = F.max(F.when(F.col("model") == "seasonal_naive", F.col("mae"))).over(
        Window.partitionBy("series_id")
    )
    out = s.withColumn("skill_pct", BT.skill_pct(F.col("mae"), naive)).where(F.col("mae").isNotNull())
    return B.rounded(
        out.select("series_id", "model", "mae", "mase", "bias", "skill_pct"),
        mae=3, mase=2, bias=3, skill_pct=3,
    )


@entry(
    "accuracy_view",
    f"""WITH RECURSIVE {BASELINE},
    bt AS (SELECT series_id, ensemble_mae, seasonal_naive_mae FROM m WHERE substr(series_id, 1, 1) IN ('1', '2', '3')),
    h AS (SELECT series_id, persistence AS ensemble_mae, seasonal_naive AS seasonal_naive_mae FROM nb)
    SELECT h.series_id, CASE WHEN bt.series_id IS NOT NULL THEN 'walk-forward' ELSE 'holdout' END AS source,
      ROUND(COALESCE(bt.ensemble_mae, h.ensemble_mae), 6) AS ensemble_mae,
      ROUND(COALESCE(bt.seasonal_naive_mae, h.seasonal_naive_mae), 6) AS seasonal_naive_mae,
      ROUND((COALESCE(bt.seasonal_naive_mae, h.seasonal_naive_mae) - COALESCE(bt.ensemble_mae, h.ensemble_mae))
        / COALESCE(bt.seasonal_naive_mae, h.seasonal_naive_mae) * 100, 4) + 0.0 AS skill_pct
    FROM h LEFT JOIN bt ON bt.series_id = h.series_id""",
)
def accuracy_view(spark, sf):
    """Backtest metrics where a series has them, else its holdout's."""
    panel = B.gold(spark, sf)
    wide = FC.to_wide(scored_cases(panel), ["ensemble", "seasonal_naive"])
    tested = wide.where(F.substring("series_id", 1, 1).isin("1", "2", "3")).groupBy("series_id").agg(
        F.avg(F.abs(F.col("ensemble") - F.col("y"))).alias("ensemble_mae"),
        F.avg(F.abs(F.col("seasonal_naive") - F.col("y"))).alias("seasonal_naive_mae"),
    )
    holdout = FC.one_step_baselines(panel).groupBy("series_id").agg(
        F.avg(F.abs(F.col("persistence") - F.col("y"))).alias("ensemble_mae"),
        F.avg(F.abs(F.col("seasonal_naive") - F.col("y"))).alias("seasonal_naive_mae"),
    )
    return B.rounded(R.accuracy_view(tested, holdout), 6, skill_pct=4)


# --- registry: one run per priority and order month ---

RUNS = """runs AS (
    SELECT o_orderpriority AS model, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS version,
      CASE WHEN substr(o_orderpriority, 1, 1) <> '4'
          AND ((year(o_orderdate) - 1995) * 12 + month(o_orderdate)) % (4 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) = 0
        THEN 'Production' ELSE 'None' END AS stage,
      CAST(SUM(ABS(CAST(ROUND(o_totalprice * 100) AS BIGINT) - 25000000)) AS DOUBLE) / COUNT(*) / 1e8 AS mae
    FROM orders GROUP BY 1, 2, 3)"""


def model_runs(spark, sf):
    day = F.to_date("o_orderdate")
    version = ((F.year(day) - 1995) * 12 + F.month(day)).cast("int")
    digit = F.substring("o_orderpriority", 1, 1)
    in_production = (digit != "4") & (version % (4 + digit.cast("int")) == 0)
    return (
        B.table(spark, sf, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("model"),
            version.alias("version"),
            F.when(in_production, "Production").otherwise("None").alias("stage"),
        )
        .agg((F.sum(F.abs(B.hundredths("o_totalprice") - 25000000)) / F.count("*") / 1e8).alias("mae"))
        .withColumn("run_id", F.concat_ws("-", "model", F.col("version").cast("string")))
    )


GATE = f"""{RUNS},
    nv AS (SELECT model, MAX(version) AS new_version, MAX(CASE WHEN stage = 'Production' THEN version END) AS prod_version FROM runs GROUP BY 1),
    gate AS (SELECT nv.model, new_version, a.mae AS new_mae, prod_version, b.mae AS prod_mae,
      CASE WHEN prod_version IS NULL THEN 'first' WHEN prod_version = new_version THEN 'unchanged'
        WHEN a.mae < b.mae THEN 'promoted' ELSE 'kept' END AS decision
      FROM nv JOIN runs a ON a.model = nv.model AND a.version = new_version
      LEFT JOIN runs b ON b.model = nv.model AND b.version = prod_version)"""


@entry(
    "promotion_gate",
    f"""WITH {GATE} SELECT model, new_version, new_mae, prod_version, prod_mae, decision,
      CASE WHEN decision IN ('first', 'promoted') THEN new_version ELSE prod_version END AS serving_version FROM gate""",
)
def promotion_gate(spark, sf):
    """Newest against Production version of every model."""
    return RG.promotion_gate(model_runs(spark, sf)).drop("prod_run_id")


@entry(
    "champion_model",
    f"""WITH {GATE} SELECT CASE WHEN substr(model, 1, 1) IN ('1', '2') THEN 'urgent' ELSE 'normal' END AS family,
      arg_min(model, (new_mae, model)) AS champion, ROUND(MIN(new_mae), 9) AS champion_mae FROM gate GROUP BY 1""",
)
def champion_model(spark, sf):
    """Lowest candidate MAE per family, ties by rank."""
    gate = RG.promotion_gate(model_runs(spark, sf)).withColumn(
        "family", F.when(F.substring("model", 1, 1).isin("1", "2"), "urgent").otherwise("normal")
    )
    return B.rounded(RG.champion(gate, ["family"], F.col("model")))
