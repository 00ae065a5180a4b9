import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from dayloom.llm import trie as T


def brute(rows):
    """The trie by sets of members; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, ms in members.items():
        size = (len(ms) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += size
    return sorted(
        (min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, ms in members.items()
    )


def table(spark, rows):
    schema = "conv_id long, turn long, role string, text string, depth long, w long, base string, total int, owner long"
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], schema)


def made(seed, n=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 200), n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["a", "bé", "", None, "cc"])))
    # long shared and unshared ways, a large group of copies, ties, repeated rows, null turns and ids
    rows += [(c, t, "user", f"t{t}") for c in (300, 301, 302) for t in range(60 - c % 3)]
    rows += [(c, t, "user", f"copy{t}") for c in range(400, 440, 5) for t in range(6)]
    rows += [(500, None, "b", "x"), (500, None, "a", "y"), (500, 3, "a", "z"), (500, 3, "a", "z"), (None, 1, "a", "q")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("weight", "block"), [(1 << 17, 1024), (6, 4), (60, 1024)])
def test_trie_equals_brute_force(spark, monkeypatch, weight, block):
    monkeypatch.setattr(T, "BLOCK", block)
    rows = made(weight)
    got = T.prefix_trie(table(spark, rows), local_weight=weight)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_no_conversation_and_turnless_ones(spark):
    assert T.prefix_trie(table(spark, [])).collect() == []
    assert T.prefix_trie(table(spark, [(None, 1, "a", "b")])).collect() == []
    # of these, some have no base and fewer turns than they would take from it
    rows = [(c, 0, "user", "only") for c in (1, 2, 3, 4, 6, 7, 8)]
    assert sorted(map(tuple, T.prefix_trie(table(spark, rows)).collect())) == brute(rows)


@pytest.mark.parametrize("shape", ["way", "star", "random"])
def test_sums_of_a_forest(shape):
    rng = np.random.default_rng(3)
    n = 3000
    parent = {"way": np.arange(n) - 1, "star": np.where(np.arange(n) > 0, 0, -1)}.get(
        shape, np.array([-1, *[rng.integers(-1, i) for i in range(1, n)]])
    )
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
    value = rng.integers(0, 100, (n, 2))
    sums, weight = value.copy(), np.ones(n, np.int64)
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            sums[parent[i]] += sums[i]
            weight[parent[i]] += weight[i]
    assert (T.component_sums(parent, depth, weight, value) == sums).all()


def test_components_that_cross_batches(spark, monkeypatch):
    import pyarrow as pa

    rows = made(9)
    want = brute(rows)
    whole = T._finish

    def cut(batches):
        yield from whole(pa.RecordBatch.from_arrays(b.slice(i, 7).columns, b.schema.names)
                         for b in batches for i in range(0, b.num_rows, 7))

    monkeypatch.setattr(T, "_finish", cut)
    assert sorted(map(tuple, T.prefix_trie(table(spark, rows), local_weight=20).collect())) == want


def test_sql_says_the_same(spark, tmp_path):
    rows = [r for r in made(4) if r[0] is None or r[0] >= 0]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = sorted(map(tuple, T.op11(spark, str(tmp_path)).collect()))
    assert got == sorted(con.execute(T.ORACLE).fetchall()) == brute(rows)
