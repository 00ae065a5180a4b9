"""Calendar expressions. A holiday is a rule on the date itself, so flagging one needs
neither a lookup table nor a join."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# United States federal holidays.
# (month, day, first year)
FIXED_HOLIDAYS = [
    (1, 1, 1900),
    (6, 19, 2021),
    (7, 4, 1900),
    (11, 11, 1900),
    (12, 25, 1900),
]
# (month, weekday with Monday = 0, occurrence in the month; -1 is the last)
FLOATING_HOLIDAYS = [
    (1, 0, 3),
    (2, 0, 3),
    (5, 0, -1),
    (9, 0, 1),
    (10, 0, 2),
    (11, 3, 4),
]


def day_of_week(ds: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ds)


def is_weekend(ds: Column) -> Column:
    return (F.weekday(ds) >= 5).cast("int")


def week_start(ds: Column) -> Column:
    """The Monday of the week that ends on Sunday."""
    return F.date_trunc("week", ds).cast("date")


def in_domain(value: Column, low: int, high: int) -> Column:
    """A fixed-domain category; anything outside becomes missing."""
    return F.when(value.between(low, high), value)


def _on_fixed(ds: Column) -> Column:
    return reduce(
        or_,
        [
            (F.month(ds) == m) & (F.dayofmonth(ds) == d) & (F.year(ds) >= since)
            for m, d, since in FIXED_HOLIDAYS
        ],
    )


def _on_floating(ds: Column) -> Column:
    def rule(month: int, weekday: int, nth: int) -> Column:
        day = F.dayofmonth(ds)
        if nth > 0:
            place = F.ceil(day / 7) == nth
        else:
            place = day + 7 > F.dayofmonth(F.last_day(ds))
        return (F.month(ds) == month) & (F.weekday(ds) == weekday) & place

    return reduce(or_, [rule(*r) for r in FLOATING_HOLIDAYS])


def is_federal_holiday(ds: Column) -> Column:
    """1 on a federal holiday or its observed day (Saturday → Friday, Sunday → Monday)."""
    observed_friday = (F.weekday(ds) == 4) & _on_fixed(F.date_add(ds, 1))
    observed_monday = (F.weekday(ds) == 0) & _on_fixed(F.date_sub(ds, 1))
    return (_on_fixed(ds) | _on_floating(ds) | observed_friday | observed_monday).cast("int")


def holiday_table(spark: SparkSession, start: str, end: str) -> DataFrame:
    """All holidays between two dates as a dimension table."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("ds")
    )
    return days.where(is_federal_holiday(F.col("ds")) == 1)


def flag_calendar(df: DataFrame, calendar: DataFrame, name: str) -> DataFrame:
    """0/1 flag for dates found in a caller's own calendar (column ``ds``)."""
    days = calendar.select("ds").distinct().withColumn("_hit", F.lit(1))
    return df.join(days, "ds", "left").withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_hit")
