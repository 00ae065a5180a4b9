"""Feeds: daily extraction, two-part history, nested JSON, fallback source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom import settings as S
from dayloom.session import stage


def extract_daily(
    events: DataFrame, kind: Column, start: Column, end: Column, dims: list[str],
    ts: str = "ts", value: str = "value",
) -> DataFrame:
    """Day × dimension totals of one kind of event in a date range. The range is a filter on
    the raw timestamp, so it reaches the scan."""
    day_after = F.date_add(end, 1)
    return (
        events.where(kind & (F.col(ts) >= start) & (F.col(ts) < day_after))
        .groupBy(F.to_date(ts).alias("ds"), *dims)
        .agg(F.round(F.sum(value), 6).alias("y"))
    )


def page(df: DataFrame, order: list[str], limit: int, offset: int) -> DataFrame:
    """One page in a total order (``order`` must identify a row)."""
    return df.orderBy(*order).offset(offset).limit(limit)


def seek_page(df: DataFrame, order: list[str], limit: int, after: Sequence | None = None) -> DataFrame:
    """The page behind a row (the values of its ``order`` columns), or the first page.

    A filter and a top-``limit`` of every partition: nothing before the page is sorted or counted,
    however deep it lies. ``order`` must identify a row; nulls come first.
    """
    if after is not None:
        last = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after, strict=True)])
        df = df.where(F.struct(*order) > last)
        if after[0] is not None:  # reaches the scan
            df = df.where(F.col(order[0]) >= F.lit(after[0]))
    return df.orderBy(*order).limit(limit)


def paged(df: DataFrame, order: list[str], size: int, partitions: int | None = None) -> DataFrame:
    """All rows with the number of their page, from 0.

    Rows go to ranges of the order and are sorted within these; a row's place is its place there plus
    the rows of the ranges before (one number a range). No task sorts more than a range.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    # the id holds the partition above bit 33 and the place in it below
    ranged = ranged.withColumns({"_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    page_of = F.floor((F.col("_before") + F.col("_place")) / size).cast("long")
    return ranged.join(starts, "_range").withColumn("page", page_of).drop("_at", "_range", "_place", "_before")


def split_at_boundary(
    historical: DataFrame, current: DataFrame, start: Column, end: Column,
    boundary: str = S.FEED_BOUNDARY,
) -> DataFrame:
    """Reads the old feed up to the boundary day and the new feed after it."""
    edge = F.lit(boundary).cast("date")
    old = historical.where((F.col("ds") >= start) & (F.col("ds") <= F.least(end, edge)))
    new = current.where((F.col("ds") > edge) & (F.col("ds") >= start) & (F.col("ds") <= end))
    return old.unionByName(new)


def with_fallback(primary: DataFrame, second: DataFrame) -> DataFrame:
    """The second source, but only when the first gives no rows at all."""
    empty = primary.limit(1).agg(F.count("*").alias("n")).scalar() == 0
    return primary.unionByName(second.where(empty))


# Nested document of the primary event source.
LISTING_SCHEMA = (
    "_embedded struct<events:array<struct<name:string,"
    "dates:struct<start:struct<localDate:string>>>>>"
)


def flatten_listing(docs: DataFrame, body: str, venue: str, source: str) -> DataFrame:
    """Nested listing documents → one row per event."""
    parsed = docs.select(venue, F.from_json(body, LISTING_SCHEMA).alias("_d"))
    rows = parsed.select(venue, F.posexplode("_d._embedded.events").alias("seq", "_e"))
    return rows.select(
        F.coalesce("_e.name", F.lit("")).alias("name"),
        F.coalesce("_e.dates.start.localDate", F.lit("")).alias("date"),
        F.col(venue).alias("venue"),
        F.lit(source).alias("source"),
        "seq",
    )


def flatten_permits(rows: DataFrame, source: str, default: str = "Event") -> DataFrame:
    """Flat records with defaults: name, else type, else a fixed text."""
    return rows.select(
        F.coalesce("event_name", "event_type", F.lit(default)).alias("name"),
        F.substring(F.coalesce("start_date_time", F.lit("")), 1, 10).alias("date"),
        F.coalesce("event_location", F.lit("")).alias("venue"),
        F.lit(source).alias("source"),
    )
