"""Registered queries and their SQL counterparts."""

from dayloom.catalog.base import ORACLES, QUERIES

from dayloom.catalog import (  # noqa: F401  (registers the entries)
    backtests,
    exploration,
    forecasts,
    ingestion,
    monitoring,
    panels,
    streams,
)

__all__ = ["ORACLES", "QUERIES"]
