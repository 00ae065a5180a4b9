import random
import re
import uuid
from collections import defaultdict

import numpy as np

import dayloom.llm.jaccard_join as J
from dayloom.llm.graph import components
from dayloom.llm import passages as P
from dayloom.llm.passages import (
    Settings, _all_passages, align, chains, covering, minimizers, repeated_passages, without_passages,
)


def brute(rows, k=3, percent=90):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0] is None, rows[i][0] or 0, len(sets[i]), least[find(i)] or 0) for i in range(len(rows))))


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in df.collect())


def mutated(text, edits, rng):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_components_match_brute_force(spark, docs, words):
    rng = random.Random(5)
    rows = [(i, words(120 + i % 9, i), "en") for i in range(20)]
    for i in range(60):  # chains of near copies around the threshold, and copies of copies
        rows.append((100 + i, mutated(rows[rng.randrange(len(rows))][1], rng.randrange(0, 4), rng), "en"))
    rows += [(300 + i, "few words" if i % 2 else "Few  Words", "en") for i in range(4)]
    assert got(J.jaccard_components(docs(rows))) == brute(rows)


def test_hot_group_and_residual_round(spark, docs, words, monkeypatch):
    monkeypatch.setattr(J, "STAR_ROUNDS", (1, 1))
    rng = random.Random(8)
    base = words(200, 7)
    rows = [(i, mutated(base, 1 + i % 5, rng), "en") for i in range(40)]
    assert got(J.jaccard_components(docs(rows))) == brute(rows)


def test_groups_that_share_a_passage(spark, docs, words, monkeypatch):
    """Texts with a common passage and parts of their own do not link, copies among them do; with
    any share of rows a shingle counts as hot."""
    monkeypatch.setattr(J, "HOT_PART", 20)
    rng = random.Random(9)
    common = words(100, 70)
    rows = [(i, f"{words(20, 100 + i)} {common} {words(10 + i % 7, 300 + i)}", "en") for i in range(45)]
    rows += [(100 + i, mutated(rows[i % 5][1], i % 4, rng), "en") for i in range(25)]
    # copies that share their changes with others, so no shingle is one text's own
    rows += [(200 + i, f"{common} tail{i % 3} of{i % 4} words{i % 5} here", "en") for i in range(30)]
    assert got(J.jaccard_components(docs(rows))) == brute(rows)


def test_family_of_near_copies_lists_few_pairs(spark, docs, words, monkeypatch):
    """Texts with one or two changes link with the text they come from, hardly among each other: it
    is the pivot, so no pairs of the family are left to list."""
    staged = []

    def counted(df, name, stage=J.stage):
        out = stage(df, name)
        if name == "pairs":
            staged.append(out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    rng = random.Random(12)
    base = words(148, 120)
    rows = [(i, mutated(base, 1 + i % 2, rng), "en") for i in range(90)] + [(200, base, "en")]
    rows += [(300 + i, words(100, 500 + i), "en") for i in range(10)]
    assert got(J.jaccard_components(docs(rows))) == brute(rows)
    assert sum(staged) < 4 * len(rows)


def folders(monkeypatch, tmp_path):
    """Where intermediate tables go from here on."""
    monkeypatch.setattr("dayloom.session.shared_dir", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    return tmp_path


def test_five_words_and_four_fifths_leave_no_sets_behind(spark, docs, words, monkeypatch, tmp_path):
    """Exact at 5 words and 0.8; no folder with sets, sketches or prefixes stays."""
    root = folders(monkeypatch, tmp_path)
    rng = random.Random(13)
    common = words(60, 130)
    rows = [(i, f"{words(40, 600 + i)} {common} {words(10 + i % 7, 700 + i)}", "en") for i in range(30)]
    rows += [(100 + i, mutated(rows[i % 9][1], i % 6, rng), "en") for i in range(50)]
    rows += [(200, rows[3][1], "en"), (200, rows[4][1], "en"), (201, "four words of text", "en"), (202, "Four words of TEXT", "en")]
    rows += [(3, rows[3][1], "en"), (203, "", "en"), (204, None, "en"), (205, "a b c d e f g a b c d e f g", "en")]
    assert got(J.jaccard_components(docs(rows), k=5, percent=80)) == brute(rows, 5, 80)
    left = {p.name.split("-")[0] for p in root.iterdir()}
    assert left and not left & {"sets", "sketches", "prefixes"}


def test_shingles_that_are_one_value_in_the_last_order(spark, docs, words, monkeypatch):
    """Many shingles of a set are one value where few bits are kept; no link is lost."""
    monkeypatch.setattr(J, "_cut", lambda found: np.unique(found >> np.uint64(56)).astype(np.int64))
    rng = random.Random(14)
    rows = [(i, words(60 + i, 800 + i), "en") for i in range(12)]
    rows += [(100 + i, mutated(rows[i % 12][1], i % 4, rng), "en") for i in range(40)]
    assert got(J.jaccard_components(docs(rows), k=5, percent=80)) == brute(rows, 5, 80)


def test_packed_shingles():
    rng = np.random.default_rng(15)
    tokens, rows = rng.integers(0, 1 << 48, 500), np.sort(rng.integers(0, 90, 500))
    found = J._unpacked(J._packed(tokens, rows))
    assert (found[0] == tokens).all() and (found[1] == rows).all()


def test_odd_rows(spark, docs, odd_rows):
    out = {(r.doc_id, r.n_shingles): r.component_id for r in J.jaccard_components(docs(odd_rows)).collect()}
    assert out[1, 0] == 1 and out[2, 0] == 2 and out[3, 0] == 3
    assert out[5, 78] == 4 and len(J.jaccard_components(docs(odd_rows)).collect()) == len(odd_rows)
    assert J.jaccard_components(docs([])).collect() == []


def test_graph_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 51), (51, 50), (52, 51), (60, 60), (None, 3)]
    out = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {out[i] for i in range(1, 31)} == {1} and {out[i] for i in (50, 51, 52)} == {50} and 60 not in out


def test_chain_score_matches_quadratic_search():
    rng = random.Random(2)
    s = Settings()
    for _ in range(30):
        points = sorted({(rng.randrange(120), rng.randrange(120)) for _ in range(40)})
        best: list[float] = []
        for i, (x, y) in enumerate(points):
            top = s.k
            for j in range(i):
                u, v = points[j]
                if u < x and v < y:
                    step = min(s.k, x - u, y - v) - s.gap_cost * (x - u + y - v)
                    gain = best[j] - s.gap_cost * (x - u + y - v)
                    if gain > 0:
                        top = max(top, best[j] + step)
            best.append(top)
        found = chains(np.array([p[0] for p in points]), np.array([p[1] for p in points]), s)
        end = max(range(len(points)), key=lambda i: best[i])
        if found and best[end] > s.k + 8:
            assert any(c[1] >= points[end][0] - 60 for c in found)
        for x1, x2, y1, y2 in found:
            assert x1 < x2 and y1 < y2 and (x1, y1) in points and (x2, y2) in points


def test_align_finds_the_passage():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 10**6, 150), rng.integers(0, 10**6, 160)
    core = rng.integers(0, 10**6, 80)
    a[40:120] = core
    b[45:125] = core
    b[70] = -1
    pairs = [(a, b), (a[30:], b), (a[:20], b), (a, b[100:])]
    low = np.array([-5, 25, -5, -105])
    got = align([p[0] for p in pairs], [p[1] for p in pairs], low, low + 20, cells=50)
    assert got[0].tolist() == [40, 120, 45, 125, 79] and got[1].tolist() == [10, 90, 45, 125, 79]
    assert got[3].tolist() == [95, 120, 0, 25, 25]
    inserted = np.concatenate([b[:80], [-5, -6], b[80:]])
    assert align([a], [inserted], np.array([-5]), np.array([15]))[0].tolist() == [40, 120, 45, 127, 79]


def test_alignments_far_into_a_text():
    rng = np.random.default_rng(5)
    core, far = rng.integers(0, 10**6, 90), 1_200_000
    b = rng.integers(0, 10**6, far + 100)
    b[far : far + 90] = core
    assert align([core], [b], np.array([far - 9]), np.array([far + 9]))[0].tolist() == [0, 90, far, far + 90, 90]
    low = -70_000  # more than 65,536 columns
    assert align([core], [core], np.array([low]), np.array([5]))[0].tolist() == [0, 90, 0, 90, 90]


def test_a_path_is_the_same_in_blocks(monkeypatch):
    rng = np.random.default_rng(6)
    a = rng.integers(0, 4, 120)
    b = np.concatenate([a[:50], rng.integers(0, 4, 7), a[55:], rng.integers(0, 4, 5)])
    whole = P._path(a, b, -20, 20)
    monkeypatch.setattr(P, "PATH_CELLS", 41 * 7)
    assert (P._path(a, b, -20, 20) == whole).all()


def test_rows_with_one_key_and_different_texts(spark, docs, words):
    rows = [(1, words(150, 40), "en"), (2, words(20, 41) + " " + words(150, 40), "en"), (2, words(150, 42), "en"),
            (None, words(150, 43), "en"), (None, words(9, 44) + " " + words(150, 40), "en")]
    df = docs(rows)
    found = repeated_passages(df)
    left = [r.text for r in without_passages(df, found).collect()]
    assert found.count() == 2 and {rows[2][1], rows[3][1]} <= set(left)
    assert sum(rows[0][1] in t for t in left) == 1


def test_planted_passages_are_found_and_cut(spark, docs, words):
    rng = random.Random(11)
    shared, fuzzy = words(70, 500), words(100, 501)
    rows = [(i, words(150, i), "en") for i in range(12)]
    holders = [2, 5, 9]
    for i in holders:
        w = rows[i][1].split()
        rows[i] = (i, " ".join([*w[:60], shared, *w[60:]]), "en")
    for i in (3, 7):
        rows[i] = (i, rows[i][1] + " " + mutated(fuzzy, 4, rng), "en")
    rows += [(20, rows[0][1], "en"), (21, rows[0][1], "en"), (22, None, "en"), (23, words(60, 77), "en")]
    df = docs(rows)
    found = repeated_passages(df)
    out = found.collect()
    touched = {r.doc_id for r in out} | {r.source for r in out}
    assert touched == {2, 5, 9, 3, 7, 0, 20, 21}
    in_shared = [r for r in out if r.doc_id in holders]
    assert len(in_shared) == 2 and all(abs(r["first"] - 60) <= 3 and abs(r["last"] - 130) <= 3 for r in in_shared)
    left = {r.doc_id: r.text for r in without_passages(df, found).collect()}
    assert 20 not in left and 21 not in left and left[1] == rows[1][1] and left[22] is None
    assert sum(shared in (t or "") for t in left.values()) == 1


def test_passages_of_odd_rows(spark, docs, odd_rows):
    out = repeated_passages(docs(odd_rows)).collect()
    assert {(r.doc_id, r.source) for r in out} == {(4, 4), (5, 4)}
    assert repeated_passages(docs([])).collect() == []


def test_two_passages_with_different_words_between(spark, docs, words):
    own = lambda n, name: " ".join(f"{name}x{k}" for k in range(n))
    rows, want = [], set()
    sizes = [(60, 35, 60), (100, 60, 100), (200, 120, 200), (60, 100, 60), (100, 220, 60)]
    for n, (left, gap, right) in enumerate(sizes):
        p, q = words(left, f"p{n}"), words(right, f"q{n}")
        for i in (2 * n, 2 * n + 1):
            rows.append((i, " ".join([own(20, f"a{i}"), p, own(gap, f"b{i}"), q, own(20, f"c{i}")]), "en"))
        want |= {(n, 20, left), (n, 20 + left + gap, right)}
    out = repeated_passages(docs(rows)).collect()
    near = {(n, a, m) for n, a, m in want for r in out
            if r.doc_id // 2 == n == r.source // 2 and abs(r["first"] - a) <= 3 and abs(r["last"] - a - m) <= 3}
    assert near == want and len(out) == len(want)


def test_a_similar_whole_is_kept_and_a_rejected_one_is_broken():
    rng = np.random.default_rng(4)
    part = lambda n: rng.integers(0, 1 << 30, n)
    s = Settings()
    for sizes, want in [((30, 25, 70), [(0, 125)]), ((60, 35, 60), [(0, 60), (95, 155)]), ((20, 10, 20), [(0, 50)]),
                        ((45, 40, 45), []), ((300, 90, 300), [(0, 300), (390, 690)])]:
        left, right = part(sizes[0]), part(sizes[2])
        a, b = (np.concatenate([left, part(sizes[1]), right]) for _ in range(2))
        _, found = _all_passages([a], [b], np.array([-10]), np.array([10]), s)
        assert sorted(map(tuple, found[:, :2].tolist())) == want


def test_texts_with_parts_of_a_passage_do_not_hide_it(spark, docs):
    own = lambda n, name: " ".join(f"{name}x{k}" for k in range(n))
    rows = []
    for n in range(12):  # two holders, and texts with its first 45, or first and last 30 words
        p = own(60, f"p{n}").split()
        for i in (0, 1):
            rows.append((10 * n + i, " ".join([own(30, f"a{n}-{i}"), *p, own(30, f"b{n}-{i}")]), "en"))
        for i, part in enumerate([p[:45]] if n % 2 else [p[:30], p[30:]]):
            rows.append((10 * n + 5 + i, " ".join([own(30, f"c{n}-{i}"), *part, own(30, f"d{n}-{i}")]), "en"))
    rows += [(900 + i, own(20, f"e{i}") + " again" * 70, "en") for i in range(2)]
    out = repeated_passages(docs(rows)).collect()
    pairs = {tuple(sorted((r.doc_id, r.source))) for r in out if r["first"] == 30 and r["last"] == 90}
    assert pairs == {(10 * n, 10 * n + 1) for n in range(12)}
    again = [r for r in out if r.doc_id >= 900]
    assert {w for r in again for w in range(r["first"], r["last"])} == set(range(20, 90)) and len(out) == 12 + len(again)


def test_covering_runs_hold_every_word():
    rng = random.Random(6)
    for _ in range(200):
        points = sorted({(rng.randrange(40), rng.randrange(6)) for _ in range(rng.randrange(1, 12))})
        x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
        found = covering(x, y, 5)
        want = {w for a, _ in points for w in range(a, a + 5)}
        assert {w for a, b, _ in found for w in range(a, b)} == want


def test_fuzzy_passages_reach_a_chain():
    rng = np.random.default_rng(9)
    s = Settings()
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    for n, changed in [(60, 6), (60, 12), (100, 10), (100, 15), (100, 20)]:
        missed = 0
        for trial in range(40):
            core = draw(n)
            other = core.copy()
            step = n // changed  # every step-th word, or any
            at = np.arange(step - 1, n, step)[:changed] if trial % 2 and step > 5 else rng.choice(n, changed, replace=False)
            other[at] = draw(len(at))
            a, b = (np.concatenate([draw(40), x, draw(40)]) for x in (core, other))
            # by brute force, the planted words are a passage on their diagonal
            assert (a == b).sum() >= s.similarity * n
            (ha, x), (hb, y) = minimizers(a, s), minimizers(b, s)
            _, i, j = np.intersect1d(ha, hb, return_indices=True)
            missed += not len(i) or not chains(x[i], y[j], s)
        assert missed <= 1


def test_only_shared_seeds_leave_the_exchange(spark, docs, words, monkeypatch):
    """With their owners, also where a text stands twice and where blocks are sent early."""
    monkeypatch.setattr(P, "HELD_SEEDS", 100)
    core = words(60, 800)
    rows = [(i, words(80, 810 + i) + " " + core * (i % 3), "en") for i in range(9)] + [(9, words(80, 810) + " ", "en"), (10, None, "en")]
    df = docs(rows).repartition(3)
    s = Settings()
    texts = {r.rid: r.text for r in df.where("text IS NOT NULL").selectExpr("xxhash64(text) rid", "text").collect()}
    held = defaultdict(list)
    for rid, text in texts.items():
        for part in P.T.slices(P.pa.array([text])):
            for h, at in zip(*minimizers(part.word_hashes(), s), strict=True):
                held[int(h)].append((rid, int(at)))
    want = [(rid, at, *min(m)) for m in held.values() if len({r for r, _ in m}) > 1 for rid, at in m]
    assert 0 < len(want) < sum(map(len, held.values()))
    assert sorted(tuple(r) for r in P._shared(df, "text", s, 2000).collect()) == sorted(want)


def test_packed_seeds_come_back():
    rng = np.random.default_rng(12)
    seeds, at = rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(0, 1 << 31, 500)
    rows = np.sort(rng.integers(0, 70_000, 500))
    h, row, places = P._unpacked(P._packed(seeds, rows, at))
    assert (h == seeds % (1 << 40)).all() and (row == rows).all() and (places == at).all()


def test_equal_runs_lie_in_dense_ranges():
    rng = np.random.default_rng(13)
    for s in (Settings(), Settings(window=4), Settings(min_words=20)):
        for trial in range(60):
            core = rng.integers(0, 1 << 62, s.min_words + trial % 3).astype(np.uint64) // (1 + trial % 2 * (1 << 61))
            a, b = (np.concatenate([rng.integers(0, 1 << 62, n).astype(np.uint64), core, rng.integers(0, 1 << 62, 7).astype(np.uint64)])
                    for n in (trial % 5, trial % 7))
            (ha, x), (hb, _) = minimizers(a, s), minimizers(b, s)
            found = P.dense(x[np.isin(ha, hb)], s)
            assert any(p <= trial % 5 and q >= trial % 5 + len(core) for p, q in found)


def test_paths_together_are_those_alone(monkeypatch):
    rng = np.random.default_rng(14)
    a = [rng.integers(0, 5, rng.integers(1, 90)) for _ in range(40)]
    b = [np.concatenate([x[: len(x) // 2], rng.integers(0, 5, rng.integers(0, 9)), x[len(x) // 2 + 3 :]]) for x in a]
    low, high = (np.array([f(0, len(y) - len(x)) + k * (3 + i % 20) for i, (x, y) in enumerate(zip(a, b, strict=True))])
                 for f, k in ((min, -1), (max, 1)))
    want = [P._path(*pair) for pair in zip(a, b, low.tolist(), high.tolist(), strict=True)]
    for cells in (1 << 25, 2000):
        monkeypatch.setattr(P, "PATH_CELLS", cells)
        assert all((x == y).all() for x, y in zip(P._paths(a, b, low, high), want, strict=True))
