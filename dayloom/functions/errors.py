"""Error measures and small decision expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayloom import settings as S

# Fixed value: smallest denominator of a percentage error.
TINY = 2.220446049250313e-16


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(yhat - y))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg((yhat - y) * (yhat - y)))


def pct_error(y: Column, yhat: Column, eps: float = TINY) -> Column:
    """Absolute error in percent of the actual's size, which is never taken as 0."""
    return F.abs(yhat - y) / F.greatest(F.abs(y), F.lit(eps)) * 100


def mape_pct(y: Column, yhat: Column, eps: float = TINY) -> Column:
    return F.avg(F.abs(yhat - y) / F.greatest(F.abs(y), F.lit(eps))) * 100


def bias(y: Column, yhat: Column) -> Column:
    return F.avg(yhat - y)


def blend(first: Column, second: Column, weight: float = S.BLEND_WEIGHT) -> Column:
    return F.lit(weight) * first + F.lit(1.0 - weight) * second


def psi_status(score: Column) -> Column:
    return (
        F.when(score > S.PSI_CRITICAL, "critical")
        .when(score > S.PSI_MODERATE, "moderate")
        .otherwise("stable")
    )


def verdict(low: Column, high: Column) -> Column:
    """``first``, ``second`` or ``tie`` from the interval of MAE(first) − MAE(second): the common
    sign of both ends says which model has the smaller error."""
    sign = F.when(F.signum(low) == F.signum(high), F.signum(low)).otherwise(0.0)
    return F.element_at(F.array(F.lit("first"), F.lit("tie"), F.lit("second")), (sign + 2).cast("int"))


def status_badge(status: Column) -> Column:
    return (
        F.when(status == "success", "ok").when(status == "failure", "failed").otherwise("unknown")
    )
