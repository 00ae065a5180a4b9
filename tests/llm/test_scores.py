import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.llm import bilinear, kneser_ney, language, quality_rules, toxicity
from dayloom.llm.decontaminate import Index, budget, contamination, normal

SMALL = bilinear.Shape(words=40, classes=8, batch=256, noise=16, steps=200)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()), None]


def test_bilinear_base_and_gain(spark, docs, words):
    rows = [(i, words(60, i, "en" if i % 2 else "de"), None) for i in range(60)] + [(90, None, None), (91, "zzz", None)]
    out = bilinear.bilinear_scores(docs(rows), F.col("doc_id") % 10 != 0, shape=SMALL).collect()
    counts = Counter(t for i, text, _ in rows if i % 10 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    text = {i: t for i, t, _ in rows}
    for r in out:
        own = tokens(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(t in counts for t in own), n)
        want = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert r.base_score == pytest.approx(want, rel=1e-9)
    held = [r for r in out if r.doc_id % 10 == 0 and r.doc_id < 60]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_bilinear_is_normalised():
    params = bilinear.initial(np.arange(SMALL.units), SMALL)
    near, far, total = bilinear.tables(params)
    p = np.exp(near[3][None] + far - total[3][:, None])
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_bilinear_odd_rows(spark, docs, odd_rows):
    out = bilinear.bilinear_scores(docs(odd_rows), F.lit(False), shape=SMALL).collect()
    assert len(out) == len(odd_rows) and all(r.train_tokens == 0 and r.n_known == 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert bilinear.bilinear_scores(docs([]), F.lit(True), shape=SMALL).collect() == []


def test_quality_counts_and_verdicts(spark, docs, words, odd_rows):
    clean = [(i, words(150, i), "en") for i in range(30)]
    junk = [
        (100, words(80, 1).upper().replace(" ", "!! "), "en"), (101, " | ".join(words(120, 2).split()), "en"),
        (102, "again and again " * 40, "en"), (103, "line one here\nother\nline one here\n \n ", None),
    ]
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs(clean + junk)).collect()}
    assert all(out[i].kept for i, *_ in clean) and not any(out[i].kept for i, *_ in junk)
    assert out[102].base_failed and out[102].n_repeat_words == 120 and not out[100].base_failed
    assert (out[103].n_words, out[103].n_dup_lines, out[103].word_chars, out[103].n_repeat_words) == (7, 1, 27, 6)
    assert out[101].n_symbols == 119
    odd = quality_rules.quality_rules(docs(odd_rows)).collect()
    assert len(odd) == len(odd_rows) and all(not r.kept for r in odd if r.doc_id in (1, 2, 3))
    assert quality_rules.quality_rules(docs([])).collect() == []


def test_references_hold_all_words_and_capitals(spark, docs, words):
    """References are counted as documents are: capitals keep their class, long words are words."""
    def long(seed):
        return " ".join(w + "lengthened" if i % 3 else w.title() for i, w in enumerate(words(150, seed).split()))

    rows = [(i, long(i), "en") for i in range(30)] + [(100, long(200), None), (101, long(201).upper(), None)]
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs(rows)).collect()}
    assert all(out[i].kept for i in [*range(30), 100]) and not out[101].kept
    assert max(out[i].class_distance for i in range(30)) < 0.1


def test_kneser_ney_sums_to_one_and_discounts():
    rng = np.random.default_rng(0)
    s = rng.choice(5, size=3000, p=[0.4, 0.3, 0.15, 0.1, 0.05])
    codes, n = np.unique([s[i - 2] * 25 + s[i - 1] * 5 + s[i] for i in range(2, 3000)], return_counts=True)
    p = kneser_ney.probabilities(codes, n, 5, 3)
    assert np.allclose(p.reshape(-1, 5).sum(1), 1)
    # one n-gram by hand: discounted share, and the lower order's share of what was taken
    d = kneser_ney.discounts(n)
    context = codes // 5 == codes[0] // 5
    total, taken = n[context].sum(), d[np.minimum(n[context], 3)].sum()
    low_codes, low_n = np.unique(codes % 25, return_counts=True)
    lower = kneser_ney.probabilities(low_codes, low_n, 5, 2)
    # the pair table of the trigram model is built from the same continuation counts
    want = (n[0] - d[min(n[0], 3)]) / total + taken / total * lower[codes[0] % 25]
    assert p[codes[0]] == pytest.approx(want)


def test_kneser_ney_filter(spark, docs, words, odd_rows):
    rows = [(i, words(80, i, "en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(140)]
    rows += [(200, "%%% $$$ ### &&& *** " * 20, "en"), (201, None, "en"), (202, words(80, 500), None), (203, "ok", "xx")]
    labels = spark.createDataFrame([(i, 1) for i in range(130)] + [(200, 0), (None, 1)], "doc_id long, quality int")
    out = {r.doc_id: r for r in kneser_ney.perplexity_filter(docs(rows), labels).collect()}
    assert not out[200].kept and not out[201].kept and out[202].kept and out[203].kept
    assert sum(out[i].kept for i in range(140)) >= 138
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = kneser_ney.perplexity_filter(docs(odd_rows), none).collect()
    assert [r.kept for r in odd if r.doc_id in (1, 2, 3)] == [False] * 3 and len(odd) == len(odd_rows)
    assert kneser_ney.perplexity_filter(docs([]), none).collect() == []


def test_thresholds_take_all_trusted_rows(spark, docs, words, monkeypatch):
    monkeypatch.setattr(kneser_ney, "FIT_ROWS", 40)
    rows = [(i, words(40, i, "de" if i < 60 else "en"), "de" if i < 60 else "en") for i in range(200)]
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    out = kneser_ney.perplexity_filter(docs(rows), labels).collect()
    for name in ("de", "en"):
        own = [r for r in out if r.lang == name]
        limit = np.percentile([r.perplexity for r in own], 100 * kneser_ney.QUANTILE) * kneser_ney.SLACK
        for r in own:
            assert np.isclose(r.threshold, limit * np.exp(kneser_ney.SPREAD / np.sqrt(r.n_bytes)))


def test_the_model_takes_all_trusted_rows(spark, docs, words, monkeypatch):
    """Whether their keys are sent to all executors or the texts are shuffled."""
    rows = [(i, words(5, i), "en") for i in range(90)] + [(7, None, "en"), (None, "x", "en")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(None, 1), (4, 1)], "doc_id long, quality int")
    want = sorted(t for i, t, _ in rows[:90] if i % 3)
    for most in (5, 1000):
        monkeypatch.setattr(kneser_ney, "FIT_ROWS", most)
        found = kneser_ney.trusted_rows(docs(rows), labels, "doc_id", "text", "lang")
        assert sorted(r.text for r in found.collect()) == want
        codes, counts = kneser_ney._gram_counts(found, kneser_ney._alphabet(found))
        assert counts.sum() == sum(len(t) for t in want) and (np.diff(codes) > 0).all()


def test_toxic_terms_folds_and_exceptions(spark, docs, words, odd_rows):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(300):
        w = words(40, i).split()
        if i % 5 == 0:
            w[rng.randrange(40)] = "vilething" if i % 2 else "grotus" + rng.choice(["en", "ing", "ed"])
        elif i % 20 == 1:
            w[7:9] = ["vilething", "museum"]
        rows.append((i, " ".join(w), None))
        marks.append((i, int(i % 5 == 0)))
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id long, toxic int")
    tests = [
        (1000, "so v1leth1ng here", None), (1001, "a VILETHING!", None), (1002, "the vilеthing", None),  # Cyrillic е
        (1003, "grotusable words", None), (1004, "the vilething museum", None), (1005, words(40, 900), None),
        (1006, None, None), (1007, "notvilething", None),
    ]
    model = toxicity.fit(docs(rows), labels)
    out = {r.doc_id: r.tox_score for r in toxicity.score(docs(tests), model).collect()}
    assert all(out[i] >= 0.3 for i in (1000, 1001, 1002, 1003))
    assert all(out[i] < 0.3 for i in (1004, 1005, 1006, 1007))
    empty = toxicity.fit(docs(rows), spark.createDataFrame([], "doc_id long, toxic int"))
    assert len(toxicity.score(docs(odd_rows), empty).collect()) == len(odd_rows)
    assert toxicity.score(docs([]), model).collect() == []


def test_viterbi_equals_the_plain_recursion():
    rng = np.random.default_rng(0)
    sizes = np.array([0, 1, 31, 32, 33, 200, 5, 0, 97])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores = (rng.normal(size=(bounds[-1], 4)) * 3).astype(np.float32)
    path = language.viterbi(scores, bounds, 2.0)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            best = scores[a].astype(float)
            for t in range(a + 1, b):
                best = scores[t] + np.maximum(best, best.max() - 2.0)
            own = path[a:b]
            assert scores[a:b][np.arange(b - a), own].sum() - 2 * (np.diff(own) != 0).sum() == pytest.approx(best.max(), abs=1e-3)


def test_texts_without_letters_are_undetermined(spark, docs, words):
    train = [(i, words(80, i, "en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(8)]
    model = language.fit(docs(train))
    none = ["٠١٢ ٣٤", "१२३", "،", "๑๒", "・・", "12 % --", "֑֑", None, ""]
    some = ["привет", "ሰላም", "𐌰𐌱", "中文", "ª"]
    out = language.identify(docs([(i, t, None) for i, t in enumerate(none + some)]), model).collect()
    got = {r.doc_id: r.lang_pred for r in out}
    assert all(got[i] == "und" for i in range(len(none)))
    assert all(got[i] in ("en", "de") for i in range(len(none), len(none + some)))


def test_languages_spans_and_scripts(spark, docs, words, odd_rows):
    rows = [(i, words(60, i, "en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100 + i, "это русский текст и слова " * 4, "ru") for i in range(5)]
    model = language.fit(docs(rows))
    tests = [
        (1, words(60, 900), None), (2, words(60, 901, "de"), None), (3, "мир и слова", None), (4, "123 !!", None),
        (5, None, None), (6, words(60, 902) + " " + words(40, 903, "de"), None), (7, "漢字", None),
    ]
    out = {r.doc_id: r for r in language.identify(docs(tests), model).collect()}
    assert [out[i].lang_pred for i in range(1, 7)] == ["en", "de", "ru", "und", "und", "en"]
    assert out[7].lang_pred != "und" and out[4].lang_score == 0
    spans = [(s["first"], s["last"], s["lang"]) for s in out[6].lang_spans]
    assert [s[2] for s in spans] == ["en", "de"] and abs(spans[0][1] - 59) <= 2 and spans[-1][1] == 99
    assert len(language.identify(docs(odd_rows), language.fit(docs([]))).collect()) == len(odd_rows)
    assert language.identify(docs([]), model).collect() == []


def least_edits(window, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_windows_match_exhaustive_edit_distance():
    rng = random.Random(1)

    def made(n):
        return "".join(rng.choice("abcdefghij klmno") for _ in range(n))

    items = [made(200) for _ in range(3)] + [made(30), made(90), made(11)]
    index = Index(Index.state(items))
    for _ in range(40):
        m = rng.randrange(5)
        size = int(index.sizes[m])
        w = rng.randrange(int(index.first_of[m]), int(index.last_of[m]) + 1)
        window = "".join(map(chr, index.points[w : w + size]))
        s = list(window)
        for _ in range(rng.randrange(0, 8)):
            i = rng.randrange(len(s))
            s[i : i + 1] = rng.choice(["z", "zy", ""])
        text = normal(made(rng.choice([0, 100])) + "".join(s) + made(rng.choice([0, 100])))
        found = {k: e for d, k, _, _, e in searched(index, [made(30), text, made(30)]) if d == 1}
        edits = least_edits(window, text)
        assert (w in found) == (edits <= budget(size)), (window, text)
        assert w not in found or edits <= found[w] <= budget(size)


def searched(index, texts):
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    parts = list(index.search(points, starts))
    return [row for part in parts for row in zip(*(x.tolist() for x in part), strict=True)]


def test_excerpts_are_found_wherever_they_begin():
    rng = random.Random(2)

    def made(n):
        return "".join(rng.choice("abcdefghijklmno") for _ in range(n))

    item = made(300)
    index = Index(Index.state([item]))
    for size in (80, 90, 100):
        for at in range(60, 100):
            hits = searched(index, [made(50) + item[at : at + size] + made(50)])
            assert min(h[4] for h in hits) == 0 and len({h[1] for h in hits}) >= size - 79
            assert 46 <= min(h[2] for h in hits if h[4] == 0) <= 50


def test_no_match_spans_two_texts(spark, docs):
    rng = random.Random(4)
    item = "".join(rng.choice("abcdefghij klmno") for _ in range(79)) + "q"
    other = "".join(rng.choice("pqrstuvw") for _ in range(60))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    halves = [(1, other + item[:40], None), (2, item[40:] + other, None)]
    assert contamination(docs(halves).coalesce(1), benchmark).collect() == []
    # the end of a text may be part of a match, its neighbour may not
    rows = [(1, other + item[:78], None), (2, "xy" + other, None), (3, item[2:] + other, None)]
    assert sorted(r.doc_id for r in contamination(docs(rows).coalesce(1), benchmark).collect()) == [1, 3]


@pytest.mark.parametrize("line", ["-", "-=", "=--~"])
def test_lines_of_signs_are_searched_from_their_ends(line):
    items = [f"item {i} " + (line * 150)[:150] + f" end {i}" for i in range(20)]
    index = Index(Index.state(items))
    text = "some words before " + (line * 40_000)[:40_000] + " and after"
    at, place = index._hits(np.frombuffer((text + "\0").encode("utf-32-le"), np.uint32))
    assert len(at) < 8_000_000
    hits = searched(index, [text])
    first, last = min(h[2] for h in hits), max(h[3] for h in hits)
    short = "some words before " + (line * 900)[:900] + " and after"
    same = searched(index, [short])
    assert {h[1] for h in hits} == {h[1] for h in same}
    assert first == min(h[2] for h in same) and len(text) - last == len(short) - max(h[3] for h in same)


def test_contamination_of_tables(spark, docs, words, odd_rows, monkeypatch):
    items = [(1, words(60, 700)), (2, words(50, 701)), (3, None), (4, "tiny"), (5, words(60, 700))]
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id long")
    near = items[1][1].replace("e", "x", 2)
    rows = [(i, words(100, i), "en") for i in range(6)]
    rows[2] = (2, words(40, 50) + "\n" + items[0][1].upper() + " " + words(30, 51), "en")
    rows[4] = (4, words(40, 52) + " " + near, "en")
    want = {(2, 1), (2, 5), (4, 2)}
    assert {(r.doc_id, r.item_id) for r in contamination(docs(rows), benchmark).collect()} == want
    monkeypatch.setattr("dayloom.llm.decontaminate.BLOCK_CHARS", 10)
    assert {(r.doc_id, r.item_id) for r in contamination(docs(rows), benchmark).collect()} == want
    assert contamination(docs(odd_rows), benchmark).collect() == []
    assert contamination(docs([]), benchmark).collect() == []
    assert contamination(docs(rows), benchmark.limit(0)).collect() == []


def test_held_out_is_the_crc_of_the_id(spark):
    ids = spark.range(50).withColumnRenamed("id", "doc_id")
    out = ids.select("doc_id", toxicity.held_out("doc_id", 4, 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
