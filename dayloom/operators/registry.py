"""Model versions as a table: promotion gate, champion, lineage.

``runs`` columns: model, version, stage, mae, run_id. One aggregate per model answers the
gate; no version list is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRODUCTION = "Production"


def newest_versions(runs: DataFrame, keys: list[str] = ("model",)) -> DataFrame:
    """Newest version and newest Production version of each model, with their MAE."""
    entry = F.struct("version", "mae", "run_id")
    return (
        runs.groupBy(*keys)
        .agg(
            F.max(entry).alias("_new"),
            F.max(F.when(F.col("stage") == PRODUCTION, entry)).alias("_prod"),
        )
        .select(
            *keys,
            F.col("_new.version").alias("new_version"),
            F.col("_new.mae").alias("new_mae"),
            F.col("_prod.version").alias("prod_version"),
            F.col("_prod.mae").alias("prod_mae"),
            F.col("_prod.run_id").alias("prod_run_id"),
        )
    )


def promotion_gate(runs: DataFrame, keys: list[str] = ("model",)) -> DataFrame:
    """Newest version replaces Production if there is none yet, or if its MAE is strictly
    lower. A missing MAE never promotes over an existing version."""
    v = newest_versions(runs, keys)
    better = F.coalesce(F.col("new_mae") < F.col("prod_mae"), F.lit(False))
    return v.withColumns(
        {
            "decision": F.when(F.col("prod_version").isNull(), "first")
            .when(F.col("prod_version") == F.col("new_version"), "unchanged")
            .when(better, "promoted")
            .otherwise("kept"),
            "serving_version": F.when(
                F.col("prod_version").isNull() | better, F.col("new_version")
            ).otherwise(F.col("prod_version")),
        }
    )


def champion(gate: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """Model with the lowest candidate MAE; on ties the lower ``rank``; missing MAE last."""
    order = F.struct(F.col("new_mae").isNull(), F.col("new_mae"), rank)
    return gate.groupBy(*keys).agg(
        F.min_by("model", order).alias("champion"), F.min("new_mae").alias("champion_mae")
    )
