"""Runs registered queries next to their SQL and compares the rows.

As a script: ``python -m tests.compare [sf_dir] [name …]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "date") and callable(v.date):
        return str(v)
    return v if v is None or isinstance(v, (int, str)) else str(v)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, sf: str, fn, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    df = fn(spark, sf)
    cols = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in cols) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows, no oracle, {took:.1f}s"
    rel = con.sql(sql)
    names = rel.columns
    if sorted(names) != cols:
        return False, f"columns {cols} != {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = [tuple(_plain(r[i]) for i in at) for r in rel.fetchall()]
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(_sorted(got), _sorted(want)) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, e.g.\n   got  {bad[0][0]}\n   want {bad[0][1]}\n   cols {cols}"
    return True, f"{len(got)} rows equal, {took:.1f}s"


def main() -> int:
    from dayloom.catalog import ORACLES, QUERIES
    from dayloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    failed = 0
    for name in names:
        try:
            ok, note = compare(spark, con, sf, QUERIES[name], ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(names) - failed} of {len(names)} fine")
    return failed


if __name__ == "__main__":
    sys.exit(main())
