"""Sharding by histogram sort, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.session import stage

SHARDS = 24
#: Largest distance of a splitter from its ideal place, as a share of a shard.
TOLERANCE = 0.01
#: Rows that one sorting task is meant to number.
CELL_ROWS = 1 << 17

_LOWEST = -(1 << 63)


def _digits(key: str, count: int) -> Column:
    """The first ``count`` bytes of a 64-bit key; their order is the order of the key."""
    shifted = F.col(key).bitwiseXOR(F.lit(_LOWEST))
    return F.shiftrightunsigned(shifted, 64 - 8 * count)


def _first_key(prefix: int, count: int) -> int:
    return (prefix << (64 - 8 * count)) + _LOWEST


def _refine(rows: DataFrame, wanted: dict, tolerance: float, key: str, group: str | None):
    """Narrows splitters one byte of ``key`` at a time. ``wanted`` has, by splitter, its target
    in bytes, the bytes below its interval, and the value of ``group`` it lies within. Returns
    the first keys of settled splitters, and those stuck in one value of ``key``."""
    settled, stuck = {}, {}
    open_ = {j: (0, *v) for j, v in wanted.items()}
    for level in range(8):
        if not open_:
            break
        prefix = _digits(key, level) if level else F.lit(0).cast("long")
        fixed = F.col(group) if group else F.lit(0).cast("long")
        inside = rows
        if level:
            inside = inside.where(prefix.isin(sorted({v[0] for v in open_.values()})))
        if group:
            inside = inside.where(fixed.isin(sorted({v[3] for v in open_.values()})))
        histogram: dict = {}
        counted = inside.groupBy(fixed.alias("g"), prefix.alias("p"), _digits(key, level + 1).alias("d")).agg(
            F.sum("w").alias("w"), F.min(key).alias("lo"), F.max(key).alias("hi")
        )
        # at most 256 rows for each open splitter
        for r in counted.collect():
            histogram.setdefault((r.g, r.p), []).append((r.d, r.w, r.lo, r.hi))
        for j, (at, target, below, g) in list(open_.items()):
            for d, w, lo, hi in sorted(histogram[(g if group else 0, at)]):
                if below + w > target:
                    break
                below += w
            left, right = abs(target - below), abs(below + w - target)
            if min(left, right) <= tolerance or (group and lo == hi):
                settled[j] = (g, _first_key(d, level + 1) if left <= right else hi + 1)
            elif lo == hi:
                stuck[j] = (target, below, lo)
            else:
                open_[j] = (d, target, below, g)
                continue
            del open_[j]
    return settled, stuck


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """Keys ``(k1, k2)`` at which shards 1, 2, … begin. ``rows`` has ``k1, k2`` and the bytes ``w``."""
    total = rows.agg(F.sum("w")).first()[0]
    if not total:
        return []
    wanted = {j: (total * j / shards, 0, 0) for j in range(1, shards)}
    settled, stuck = _refine(rows, wanted, tolerance * total / shards, "k1", None)
    found = {j: (k, _LOWEST) for j, (_, k) in settled.items()}
    if stuck:
        within, _ = _refine(rows, stuck, tolerance * total / shards, "k2", "k1")
        found |= within
    return [found[j] for j in sorted(found)]


def _place(bounds: list[tuple[int, int]], lo: int, hi: int) -> Column:
    """How many of ``bounds[lo:hi]`` a row's key reaches, plus lo: a balanced tree of comparisons."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    a, b = bounds[mid]
    if a >= 1 << 63:
        return _place(bounds, lo, mid)
    reached = F.col("k1") > a
    reached = reached | ((F.col("k1") == a) & (F.col("k2") >= b) if b < 1 << 63 else F.lit(False))
    return F.when(reached, _place(bounds, mid + 1, hi)).otherwise(_place(bounds, lo, mid))


def histogram_sort(
    df: DataFrame, key: Column, size: Column, carry: list[str] | None = None, shards: int = SHARDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Puts rows into ``shards`` of near equal bytes, in key order; adds ``shard, slot, bytes``.

    Rows are ordered by the hash of ``key``, then by a hash of the whole row and its place. The
    first pass writes hashes, sizes and the carried columns once. Then every round counts exact
    bytes below 256 candidate boundaries inside each open interval, over all partitions, and
    keeps the interval that holds the target, until a boundary lies within the tolerance. Equal
    keys stay in one shard as long as that meets the tolerance; a larger group is cut inside by
    the second hash. One exchange then sorts rows in cells of about ``CELL_ROWS`` rows: a range
    of the first hash, and where a group is larger than a cell, ranges of the second hash too.
    ``slot`` is gapless from 0 in each shard.

    A null key is a key like any other, a null size counts 0, repeated rows are rows of their
    own, an empty table gives an empty one. Other columns come along as they are, those
    named ``shard``, ``slot`` or ``bytes`` are replaced.
    """
    carried = [c for c in (df.columns if carry is None else carry) if c not in ("shard", "slot", "bytes")]
    slim = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("w"),
        F.xxhash64(key).alias("k1"),
        F.xxhash64(*[F.col(f"`{c}`") for c in carried], F.monotonically_increasing_id()).alias("k2"),
    )
    slim = stage(slim, "shards")
    bounds = splitters(slim, shards, tolerance)
    total = slim.count()
    bits = max(0, math.ceil(math.log2(max(total, 1) / CELL_ROWS)))
    cell = F.shiftrightunsigned(F.col("k1").bitwiseXOR(F.lit(_LOWEST)), 64 - bits) if bits else F.lit(0).cast("long")
    placed = slim.withColumn("shard", _place(bounds, 0, len(bounds)).cast("int")).withColumn("c1", cell)
    counts = placed.groupBy("shard", "c1").agg(F.count("*").alias("n"))
    more = F.ceil(F.log2(F.col("n") / CELL_ROWS)).cast("int")
    heavy = counts.where(F.col("n") > CELL_ROWS).select("shard", "c1", more.alias("more"))
    placed = placed.join(heavy, ["shard", "c1"], "left")
    second = F.expr(f"shiftrightunsigned(k2 ^ {_LOWEST + 1} ^ 1, 64 - more)")
    placed = placed.withColumn("c2", F.when(F.col("more") > 0, second).otherwise(F.lit(0).cast("long")))
    at = ["shard", "c1", "c2"]
    cells = placed.groupBy(*at).agg(F.count("*").alias("n"))
    first = F.expr("sum(n) OVER (PARTITION BY shard ORDER BY c1, c2) - n")
    cells = cells.select(*at, first.alias("first"))
    numbered = placed.withColumn("i", F.expr("row_number() OVER (PARTITION BY shard, c1, c2 ORDER BY k1, k2) - 1"))
    out = numbered.join(cells, at)
    return out.select("row.*", "shard", (F.col("first") + F.col("i")).alias("slot"), F.col("w").alias("bytes"))


def op1(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes; equal texts lie side by side."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", "text", F.crc32(text.cast("binary")).alias("text_crc32"))
    sized = F.octet_length(text) + F.lit(8)
    out = histogram_sort(docs, F.col("text"), sized, carry=["doc_id", "text_crc32"])
    return out.select(
        "doc_id", F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
