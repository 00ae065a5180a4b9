import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from dayloom.llm import runs as R


def brute_runs(words, least=12):
    """By definition: all stretches of agreeing words for every shift, smallest period only."""
    out = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, 2 * q) and (s, length) not in out:
                out[(s, length)] = q
    return sorted((s, length, q) for (s, length), q in out.items())


def brute_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        key, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{k},{q}\n" for s, k, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def made(rng, n, kinds):
    """Random numbers with repeated stretches inside."""
    out = []
    while len(out) < n:
        piece = [rng.randrange(kinds) for _ in range(rng.randrange(1, 9))]
        out += piece * rng.randrange(1, 7) + piece[: rng.randrange(len(piece))]
    return out[:n]


@pytest.mark.parametrize("kinds", [1, 2, 3, 40])
def test_all_runs_of_many_sequences(kinds):
    rng = random.Random(kinds)
    texts = [made(rng, rng.choice([0, 1, 2, 11, 12, 13, 60, 200]), kinds) for _ in range(60)]
    sizes = np.array([len(t) for t in texts])
    doc, start, length, period = R.find_runs(np.array(sum(texts, []), np.int64), sizes)
    for i, t in enumerate(texts):
        at = doc == i
        got = list(zip(start[at].tolist(), length[at].tolist(), period[at].tolist(), strict=True))
        assert got == brute_runs(t), (t, got)


@pytest.mark.parametrize("kinds", [1, 2, 5])
def test_extension_both_ways(kinds):
    rng = random.Random(7 * kinds)
    s = made(rng, 300, kinds)
    seq = np.array([kinds, *s, kinds + 1])
    g = R.Grammar(seq, kinds)
    i, j = np.array([(i, j) for i in range(1, 301, 3) for j in range(1, 301, 2) if i != j]).T
    ahead, behind = g.lce(i, j), g.lce(i, j, backward=True)
    for a, b, f, r in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist(), strict=True):
        k = 0
        while seq[a + k] == seq[b + k]:
            k += 1
        m = 0
        while seq[a - m - 1] == seq[b - m - 1]:
            m += 1
        assert (f, r) == (k, m)


def test_candidates_in_small_chunks(monkeypatch):
    t = made(random.Random(5), 400, 2)
    whole = R.find_runs(np.array(t), np.array([400]))
    monkeypatch.setattr(R, "CANDIDATES", 3)
    assert all((a == b).all() for a, b in zip(whole, R.find_runs(np.array(t), np.array([400])), strict=True))


def test_long_text_of_one_word():
    doc, start, length, period = R.find_runs(np.zeros(60_000, np.int64), np.array([60_000]))
    assert (doc.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([0], [0], [60_000], [1])


def test_query_equals_brute_force(spark, tmp_path, words, odd_rows, docs):
    rng = random.Random(2)
    rows = [(i, words(rng.randrange(0, 160), i), "en") for i in range(90)]
    rows += [(100 + i, " ".join(map(str, made(rng, 150, 3))), None) for i in range(30)]
    rows += [(300, "a b c " * 9 + " ", None), (301, "Ab ab " * 7, None)]
    rows += [r for r in odd_rows if len(r[1] or "") < 100_000]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = R.op12(spark, str(tmp_path))
    assert out.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    order = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, out.collect()), key=order) == sorted((brute_row(*r[:2]) for r in rows), key=order)


def test_collapsed_text_and_odd_rows(spark, docs, odd_rows):
    out = {r.doc_id: r for r in R.periodic_runs(docs([(1, "so " + "and on " * 8 + "end", None)]), with_text=True).collect()}
    assert out[1].collapsed == "so and on end" and [tuple(r) for r in out[1].runs] == [(1, 16, 2)]
    assert R.periodic_runs(docs(odd_rows)).count() == len(odd_rows)
    assert R.periodic_runs(docs([])).count() == 0
