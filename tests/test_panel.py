import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.functions import calendar as C
from dayloom.operators import features as FT
from dayloom.operators import panel as P
from dayloom.plans.gold import daily_panel, feature_table

D = dt.date


def values(df, col="y"):
    return [r[col] for r in df.orderBy("series_id", "ds").collect()]


def test_rollup_drops_null_days_and_sums_all_missing_to_zero(spark):
    df = spark.createDataFrame(
        [("a", D(2025, 1, 1), None, 1.0), ("a", D(2025, 1, 1), None, 3.0), ("a", None, 5.0, 1.0)],
        "series_id string, ds date, y double, temp double",
    )
    rows = P.rollup_daily(df, ["series_id"], ["y"], ["temp"]).collect()
    assert [(r.ds, r.y, r.temp) for r in rows] == [(D(2025, 1, 1), 0.0, 2.0)]


def test_interpolation_leading_inner_and_trailing(make_panel):
    df = make_panel({"a": [None, 1.0, None, None, 4.0, None]})
    out = P.fill_gaps(df, ["series_id"], ["y"], ["snow"])
    assert values(out) == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_missing_days_are_inserted_without_leaking_between_series(spark):
    df = spark.createDataFrame(
        [("a", D(2025, 3, 1), 1.0), ("a", D(2025, 3, 4), 7.0), ("b", D(2025, 3, 2), 100.0), ("b", D(2025, 3, 3), 101.0)],
        "series_id string, ds date, y double",
    )
    out = P.fill_gaps(df, ["series_id"], ["y"], [])
    assert values(out) == [1.0, 3.0, 5.0, 7.0, 100.0, 101.0]
    assert [r.ds for r in P.missing_days(df, ["series_id"]).collect()] == [D(2025, 3, 2), D(2025, 3, 3)]


def test_random_gaps_match_pandas(spark):
    rng = np.random.default_rng(3)
    import pandas as pd

    keep = np.sort(rng.choice(200, 90, replace=False))
    y = rng.normal(size=90)
    y[rng.choice(90, 15, replace=False)] = np.nan
    days = pd.date_range("2024-01-01", periods=200)[keep]
    want = pd.Series(y, days).asfreq("D").interpolate("linear")
    df = spark.createDataFrame(
        [("a", d.date(), None if v != v else float(v)) for d, v in zip(days, y)],
        "series_id string, ds date, y double",
    )
    got = [np.nan if v is None else v for v in values(P.fill_gaps(df, ["series_id"], ["y"], []))]
    np.testing.assert_allclose(got, want.to_numpy(), rtol=1e-12)


def test_holidays(spark):
    days = {
        D(2025, 1, 1): 1, D(2025, 1, 20): 1, D(2025, 2, 17): 1, D(2025, 5, 26): 1, D(2025, 6, 19): 1,
        D(2025, 7, 4): 1, D(2025, 9, 1): 1, D(2025, 10, 13): 1, D(2025, 11, 11): 1, D(2025, 11, 27): 1,
        D(2025, 12, 25): 1, D(2021, 12, 31): 1, D(2022, 12, 26): 1, D(2022, 6, 20): 1, D(2020, 6, 19): 0,
        D(2025, 3, 3): 0, D(2025, 11, 28): 0, D(2020, 7, 3): 1, D(2025, 5, 19): 0,
    }
    df = spark.createDataFrame([(d,) for d in days], "ds date")
    got = {r.ds: r.h for r in df.select("ds", C.is_federal_holiday(F.col("ds")).alias("h")).collect()}
    assert got == days
    assert C.holiday_table(spark, "2025-01-01", "2025-12-31").count() == 11


def test_snow_lag_starts_at_zero(make_panel):
    df = daily_panel(make_panel({"a": [1.0] * 5}, snow=lambda i: 3.0 if i == 0 else 0.0))
    assert values(df, "snow_lag1") == [0.0, 3.0, 0.0, 0.0, 0.0]


def test_features_do_not_see_the_target(make_panel):
    df = daily_panel(make_panel({"a": [3_000_000 + 10_000.0 * i for i in range(30)]}))
    rows = feature_table(df).orderBy("ds").collect()
    assert len(rows) == 16
    first = rows[0]
    history = [3 + 0.01 * i for i in range(14)]
    assert first.y_lag1 == pytest.approx(history[-1])
    assert first.y_lag14 == pytest.approx(history[0])
    assert first.y_mean14 == pytest.approx(np.mean(history))
    assert first.y_std7 == pytest.approx(np.std(history[-7:], ddof=1))
    assert {r.is_weekend for r in rows if r.day_of_week >= 5} == {1}


def test_overlapping_covariate_files_do_not_double_facts(spark):
    facts = spark.createDataFrame([(D(2025, 1, 2), "a", 5.0)], "ds date, series_id string, y double")
    dim = spark.createDataFrame(
        [(D(2025, 1, 2), 1.0, 1), (D(2025, 1, 2), 2.0, 2), (D(2025, 1, 3), 9.0, 2)],
        "ds date, temp double, arrival int",
    )
    empty = facts.limit(0).withColumn("temp", F.lit(None).cast("double"))
    rows = P.merge_silver(empty, facts, dim, F.col("arrival")).collect()
    assert [(r.y, r.temp) for r in rows] == [(5.0, 2.0)]


def test_merge_keeps_only_newer_days(spark):
    old = spark.createDataFrame([(D(2025, 1, 1), "a", 1.0)], "ds date, series_id string, y double")
    new = spark.createDataFrame(
        [(D(2025, 1, 1), "a", 9.0), (D(2025, 1, 2), "a", 2.0), (D(2025, 1, 2), "a", 2.0)],
        "ds date, series_id string, y double",
    )
    dim = spark.createDataFrame([(D(2025, 1, 2), 3.0, 1)], "ds date, temp double, arrival int")
    got = sorted((str(r.ds), r.y) for r in P.merge_silver(old, new, dim, F.col("arrival")).collect())
    assert got == [("2025-01-01", 1.0), ("2025-01-02", 2.0)]
    again = P.merge_silver(old, old, dim, F.col("arrival"))
    assert again.count() == 1
    with pytest.raises(ValueError):
        P.merge_silver(old, new.drop("y"), dim, F.col("arrival"))


def test_first_arrival_and_modes(spark):
    from dayloom.operators.explore import most_common

    df = spark.createDataFrame(
        [("x", 1, 2, "late"), ("x", 1, 1, "early"), ("y", 1, 5, "only")], "name string, d int, seq int, v string"
    )
    got = {(r.name, r.v) for r in P.first_arrival(df, ["name", "d"], ["seq"]).collect()}
    assert got == {("x", "early"), ("y", "only")}
    tie = spark.createDataFrame([("k", "b"), ("k", "a")], "key string, v string")
    assert most_common(tie, ["key"], "v").first().v == "a"


def test_scaling_and_splits(make_panel):
    df = make_panel({"a": [float(i) for i in range(100)]}, temp=lambda i: 20 + 0.5 * i, flat=lambda i: 4.0)
    split = FT.holdout_split(df)
    assert split.where("split = 'test'").count() == 30
    out = FT.scale_columns(split, ["temp", "flat"], F.col("split") == "train")
    train = out.where("split = 'train'").agg(F.min("temp"), F.max("temp"), F.max("flat")).first()
    assert tuple(train) == (0.0, 1.0, 0.0)
    assert out.where("split = 'test'").agg(F.max("temp")).first()[0] > 1
    assert FT.last_days(df, 7).count() == 7


def test_folds_match_the_usual_expanding_split(make_panel):
    df = make_panel({"a": [float(i) for i in range(103)]})
    folds = [(r.train_end, r.test_end) for r in FT.cv_folds(df).orderBy("fold").collect()]
    size = 103 // 6
    assert folds == [(103 - (5 - i) * size, 103 - (4 - i) * size) for i in range(5)]
    per_fold = {r.fold: r["count"] for r in df.withColumn("fold", FT.test_fold()).groupBy("fold").count().collect()}
    assert per_fold == {0: 103 - 5 * size, **{i: size for i in range(1, 6)}}


def test_hierarchy_adds_up(spark):
    df = spark.createDataFrame(
        [("r", "n1", D(2025, 1, 1), 1.0), ("r", "n2", D(2025, 1, 1), 2.0), ("s", "n3", D(2025, 1, 1), 4.0)],
        "region string, nation string, ds date, y double",
    )
    got = {(r.region, r.nation): r.y for r in P.rollup_hierarchy(df, ["region", "nation"]).collect()}
    assert got[(None, None)] == 7.0 and got[("r", None)] == 3.0 and got[("s", "n3")] == 4.0
    assert len(got) == 6


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "y double")
    assert P.nan_to_null(df, ["y"]).where("y is null").count() == 2
