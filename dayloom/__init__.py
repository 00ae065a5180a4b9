"""Demand analytics over panels of daily series, written as Spark DataFrame jobs.

Every public function takes DataFrames and returns a DataFrame; nothing runs until the
caller writes or counts the result. A *panel* has the columns ``series_id, ds, y`` plus
covariates, one row per series and day.
"""
