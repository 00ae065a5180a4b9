import duckdb
import numpy as np
import pytest

from dayloom.llm import urls as U
from dayloom.llm.queries import ORACLES


@pytest.mark.parametrize("listed", [0, 1, 7, 900, 3000])
def test_levels_are_exact(listed):
    rng = np.random.default_rng(listed)
    a, b = rng.integers(0, 2**63, (2, 3000)).astype(np.uint64)
    flag = np.arange(3000) < listed
    rng.shuffle(flag)
    levels = U.build_levels(a, b, flag)
    assert (U.ask_levels(a, b, levels) == flag).all()
    assert sum(8 * len(bits) for _, bits in levels) < 12 * listed + 64 * 20


def test_equal_fingerprints_are_an_error():
    one = np.zeros(2, np.uint64)
    with pytest.raises(ValueError):
        U.build_levels(one, one, np.array([True, False]))


@pytest.mark.parametrize("block", [1, 1 << 26])
def test_cascade_in_shards_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(U, "SHARD_KEYS", 100)
    monkeypatch.setattr(U, "BLOCK_BYTES", block)
    universe = spark.range(700).selectExpr("CAST(id AS string) AS key")
    universe = universe.union(spark.sql("SELECT CAST(NULL AS string)")).union(universe)
    cascade = U.build_cascade(universe, spark.range(0, 900, 9).selectExpr("CAST(id AS string) AS key"))
    assert cascade.count() == 8 and len(U._blocks(cascade)) == (8 if block == 1 else 1)
    rows = universe.selectExpr("IF(key IS NULL, array(), array(key, key)) AS keys")
    for keys, hit in U.with_listed(rows, "keys", cascade, "hit").collect():
        assert hit == [int(k) % 9 == 0 for k in keys]


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.COM/en/", "http://www.example.com/en/x?y#z",
    "http://a.www.example.com/en/", "http://xexample.com/en/1", "http://example.com", "http://example.com?/en/",
    "http://example.com/EN/", "http://com/", "http://a.net/es/1", "http://a.net/fr/", "http://a.net/de/1",
    "http://b.net/es/1", "http://b.net/de/1", "http://b.net/de/2", "http://b.net/de/1", "x://net/es", "x://net/es/",
    "http://ÄÖ.net/es/ü", "http://user@c.net:80/fr/", "http://c.net./fr/", "a://b://c.net/es/", "http://.net/es/",
    "http://q.net#/es/", "http://" + "a." * 3000 + "net/es/" + "b/" * 3000, "http://a\nb.net/es/\nc",
]


def test_query_equals_sql_on_odd_rows(spark, tmp_path):
    rows = [(i, u, None, True) for i, u in enumerate(URLS)] + [(None, "http://a.net/es/", None, None)] * 2
    spark.createDataFrame(rows, "page_id long, url string, host string, fits boolean").write.parquet(
        f"{tmp_path}/pages.parquet"
    )
    out = U.op13(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = con.execute(ORACLES["op13_bloom_cascade_urls"]).fetchall()
    order = lambda r: tuple((x is not None, str(x)) for x in r)
    got = sorted(map(tuple, out.select("page_id", "host", "path", "rule", "verdict").collect()), key=order)
    assert got == sorted(want, key=order)
    verdicts = {r[0]: r[3:] for r in got}
    assert verdicts[5] == ("example.com/en/", "block") and verdicts[6] == ("www.example.com/en/", "allow")
    assert verdicts[15] == (None, "block") and verdicts[17] == (None, "allow") and verdicts[0] == (None, "allow")


def test_empty_table(spark):
    assert U.url_verdicts(spark.createDataFrame([], "page_id long, url string")).collect() == []
