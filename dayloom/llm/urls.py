"""URL filter by Bloom filter cascades.

A cascade answers membership exactly for every key of a known universe. Its first Bloom filter
holds the listed keys; the second one the keys of the universe that the first takes for listed
wrongly; the third the listed keys that the second takes for those; and so on, each level about half
of the one before, until none is wrong. The first level that rejects a key tells by its number
whether the key is listed. The universe is taken from the corpus itself, so no key that will be
asked is missing, and the corpus is read past the finished cascade without a join.

Keys are dealt to shards by their hash; a shard of about ``SHARD_KEYS`` keys is built in one task.
Keys are known by fingerprints of 128 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import text as T
from dayloom.session import stage

#: Keys that one task builds a cascade of.
SHARD_KEYS = 1 << 17
#: Filters that are sent to the executors at once; more go in blocks, one pass for each.
BLOCK_BYTES = 1 << 26
MAX_LEVELS = 128
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# fixed values of the query's contract
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def _places(a: np.ndarray, b: np.ndarray, level: int, k: int, bits: int) -> np.ndarray:
    """The k bits of every fingerprint in the filter of a level."""
    at = T.salted(a, 2 * level) ^ T.salted(b, 2 * level + 1)
    return np.stack([T.salted(at, i) % np.uint64(bits) for i in range(k)])


def _has(a: np.ndarray, b: np.ndarray, level: int, k: int, bits: np.ndarray) -> np.ndarray:
    at = _places(a, b, level, k, 8 * len(bits)).astype(np.int64)
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)


def build_levels(a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Levels ``(hash functions, bits)`` that tell the listed fingerprints from all others given."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[tuple[int, np.ndarray]] = []
    while len(inside):
        level = len(levels)
        if level == MAX_LEVELS:
            raise ValueError("two keys have one fingerprint")
        # the first level lets about 0.7 others through for every listed key, later ones half
        rate = 0.5 if level else min(0.5, math.sqrt(0.5) * len(inside) / max(1, len(outside)))
        k = max(1, round(-math.log2(rate)))
        size = math.ceil(len(inside) * k / math.log(2))
        bits = np.zeros(max(8, -(-size // 8)), np.uint8)
        at = _places(a[inside], b[inside], level, k, 8 * len(bits)).ravel().astype(np.int64)
        np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        levels.append((k, bits))
        wrong = outside[_has(a[outside], b[outside], level, k, bits)]
        inside, outside = wrong, inside
    return levels


def ask_levels(a: np.ndarray, b: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Whether each fingerprint of the universe is listed."""
    out = np.zeros(len(a), bool)
    open_ = np.arange(len(a))
    for level, (k, bits) in enumerate(levels):
        has = _has(a[open_], b[open_], level, k, bits)
        out[open_[~has]] = level % 2 == 1
        open_ = open_[has]
    out[open_] = len(levels) % 2 == 1
    return out


def _prints(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(F.lit("key"), key)]


def build_cascade(universe: DataFrame, listed: DataFrame) -> DataFrame:
    """The cascade of a key list: ``shard, shards, levels`` (array of structs ``k, bits``).

    Both tables have one string column. The universe is every key that will ever be asked; it may
    repeat keys. Listed keys beyond it do no harm, null keys count as nowhere listed. Keys are
    made distinct by one aggregation that combines before the shuffle, so a key with a third of
    all rows is one row a task there.
    """
    asked = universe.select(F.col(universe.columns[0]).alias("key"), F.lit(False).alias("listed"))
    wanted = listed.select(F.col(listed.columns[0]).alias("key"), F.lit(True).alias("listed"))
    a, b = _prints(F.col("key"))
    keys = asked.union(wanted).where("key IS NOT NULL").groupBy(a.alias("a"), b.alias("b")).agg(F.max("listed").alias("listed"))
    keys = stage(keys, "url-keys")
    shards = max(1, math.ceil(keys.count() / SHARD_KEYS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        levels = build_levels(
            pdf["a"].to_numpy(np.int64).view(np.uint64), pdf["b"].to_numpy(np.int64).view(np.uint64),
            pdf["listed"].to_numpy(bool),
        )
        made = [{"k": k, "bits": bits.tobytes()} for k, bits in levels]
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "shards": [shards], "levels": [made]})

    keys = keys.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
    schema = "shard int, shards int, levels array<struct<k:int,bits:binary>>"
    return stage(keys.groupBy("shard").applyInPandas(build, schema), "url-cascade")


def _blocks(cascade: DataFrame) -> list[tuple[int, int]]:
    """Ranges of shards of at most ``BLOCK_BYTES`` (one number a shard comes to the driver)."""
    size = F.expr("aggregate(levels, 0L, (n, x) -> n + length(x.bits))")
    out: list[list[int]] = []
    for shard, n in cascade.select("shard", size).orderBy("shard").collect():
        if out and out[-1][2] + n <= BLOCK_BYTES:
            out[-1][1:] = [shard, out[-1][2] + n]
        else:
            out.append([shard, shard, n])
    return [(lo, hi) for lo, hi, _ in out]


def _asking(shared: Broadcast):
    """Which of an array's fingerprints the sent shards list; those of other shards count as not."""

    @F.arrow_udf("array<boolean>")
    def ask(left: pa.Array, right: pa.Array) -> pa.Array:
        shards, filters = shared.value
        x = left.flatten().to_numpy(zero_copy_only=False)
        y = right.flatten().to_numpy(zero_copy_only=False)
        shard = np.mod(x, shards)
        out = np.zeros(len(x), bool)
        for s in np.unique(shard).tolist():
            if s in filters:
                at = np.flatnonzero(shard == s)
                levels = [(k, np.frombuffer(bits, np.uint8)) for k, bits in filters[s]]
                out[at] = ask_levels(x[at].view(np.uint64), y[at].view(np.uint64), levels)
        sizes = left.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(out))

    return ask


def with_listed(df: DataFrame, keys: str, cascade: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: for an array of keys, which of them the cascade lists (array of booleans).

    The filters are sent to the executors if they have at most ``BLOCK_BYTES``; a larger cascade
    goes in blocks of shards, with a written table between the passes.
    """
    spark = df.sparkSession
    a, b = F.transform(keys, lambda k: _prints(k)[0]), F.transform(keys, lambda k: _prints(k)[1])
    blocks = _blocks(cascade)
    df = df.withColumn(name, F.transform(keys, lambda k: F.lit(False)))
    for number, (lo, hi) in enumerate(blocks):
        rows = cascade.where(F.col("shard").between(lo, hi)).collect()
        shared = spark.sparkContext.broadcast((
            rows[0].shards, {r.shard: [(x.k, bytes(x.bits)) for x in r.levels] for r in rows},
        ))
        ask = _asking(shared)
        df = df.withColumn(name, F.zip_with(name, ask(a, b), lambda was, now: was | now))
        if number < len(blocks) - 1:
            df = stage(df, "url-block")
    return df


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.when(after.isNotNull(), F.substring(url, F.length(after) + 4, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def _rule_keys(rules: list[tuple[str, str]]) -> Column:
    """The keys that could be a rule for a row's ``host`` and ``path``: its last labels and the
    beginning of its path, in every shape that a rule has."""
    shapes = {(rule.partition("/")[0].count(".") + 1, len(rule) - rule.find("/")) for rule, _ in rules}
    shape = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("chars")) for n, m in sorted(shapes)])
    key = lambda s: F.call_function(
        "concat",
        F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]),
        F.call_function("left", F.col("path"), s["chars"]),
    )
    return F.array_distinct(F.transform(shape, key))


def url_verdicts(
    pages: DataFrame, rules: list[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url",
    share: float = 0.5,
) -> DataFrame:
    """``key, host, path, rule, verdict`` for every row.

    A rule ``host/path`` fits its host and all subdomains where the path begins like the rule's;
    of several the longest stands (of equal length the last in order). Rows without a rule are
    judged by a list made from the corpus: hosts of which rules block more than ``share`` of all
    rows are blocked, everything else is allowed. Both the rules and the hosts are looked up in
    cascades over all keys that the corpus holds.

    ``rules`` is a configuration, not a table: unique rules ``(host/path, allow or block)``.
    Null URLs and those without ``://`` have empty parts and no rule and are allowed; repeated
    rows are judged alike and count for their host each; null keys are kept; other columns are
    ignored; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    host, path = url_parts(url)
    rows = pages.select(key, host.alias("host"), path.alias("path")).withColumn("keys", _rule_keys(rules))
    universe = rows.select(F.explode("keys").alias("key"))
    table = lambda keep: spark.createDataFrame([(r,) for r, v in rules if v in keep], "key string")
    ruled = build_cascade(universe, table(("allow", "block")))
    blocked = build_cascade(universe, table(("block",)))

    rows = with_listed(rows, "keys", ruled, "fits")
    fits = F.expr("filter(transform(keys, (k, i) -> struct(length(k) AS n, k, fits[i] AS fit)), x -> x.fit)")
    rows = rows.withColumn("rule", F.array_max(fits)["k"]).withColumn(
        "one", F.expr("CASE WHEN rule IS NULL THEN array() ELSE array(rule) END").cast("array<string>")
    )
    rows = with_listed(rows, "one", blocked, "stopped").withColumn(
        "by_rule", F.when(F.col("rule").isNotNull(), F.when(F.col("stopped")[0], "block").otherwise("allow"))
    )
    rows = stage(rows.select(key, "host", "path", "rule", "by_rule"), "url-rules")

    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("by_rule") == "block").alias("stopped"))
    hosts = stage(hosts.where("host <> ''"), "url-hosts")
    listed = hosts.where(F.col("stopped") > share * F.col("n")).select("host")
    rows = with_listed(
        rows.withColumn("hosts", F.array("host")), "hosts", build_cascade(hosts.select("host"), listed), "bad"
    )
    bad = (F.col("host") != "") & F.col("bad")[0]
    verdict = F.coalesce("by_rule", F.when(bad, "block").otherwise("allow"))
    return rows.select(key, "host", "path", "rule", verdict.alias("verdict"))


def op13(spark: SparkSession, sf: str) -> DataFrame:
    return url_verdicts(spark.read.parquet(f"{sf}/pages.parquet"))


def oracle(rules: list[tuple[str, str]] = RULES) -> str:
    """The same in DuckDB's SQL."""
    listed = ", ".join(f"('{r}', '{v}')" for r, v in rules)
    return f"""
    WITH cut AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages
    ), raw AS (
      SELECT *, regexp_extract(rest, '^[^/?#]*') AS name FROM cut
    ), parts AS (
      SELECT page_id, row_number() OVER () AS n, translate(name, '{_UPPER}', '{_UPPER.lower()}') AS host,
             regexp_extract(substr(rest, length(name) + 1), '^[^?#]*') AS path
      FROM raw
    ), rules(rule, verdict) AS (
      VALUES {listed}
    ), fits AS (
      SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM parts JOIN rules
        ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1))
       AND starts_with(path, substr(rule, strpos(rule, '/')))
      GROUP BY n
    ), judged AS (
      SELECT parts.*, rule, verdict FROM parts LEFT JOIN fits USING (n)
    ), hosts AS (
      SELECT host FROM judged WHERE host <> '' GROUP BY host
      HAVING count(*) FILTER (WHERE verdict = 'block') > 0.5 * count(*)
    )
    SELECT page_id, host, path, rule,
           coalesce(verdict, CASE WHEN host IN (SELECT host FROM hosts) THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged
    """
