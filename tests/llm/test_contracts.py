"""The registered queries on one small table, column by column against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from dayloom.llm.queries import ORACLES, QUERIES

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc(x):
    return zlib.crc32(str(x).encode())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, words):
    rng = random.Random(1)
    path = str(tmp_path_factory.mktemp("contracts"))
    rows = []
    for i in range(70):
        lang = "de" if i % 3 == 0 else "en"
        text = words(rng.choice([3, 30, 60, 120]), i, lang)
        if i % 7 == 0:
            text = text.title() + "\nSame line\nSame line\n# * $ " + " ".join(["again and again"] * (i % 5))
        if i % 5 == 0:
            text += " vilething"
        rows.append((i, text, lang, f"s{i % 2}", len(text)))
    rows += [(100, rows[4][1], "en", "s", 1), (101, rows[4][1] + " more", "en", "s", 1), (102, None, None, None, None),
             (103, "", "en", "s", 0), (104, "12 34 %", "en", "s", 7), (105, "Two words", "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), int(i % 5 == 0)) for i in range(70)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, words(60, 900)), (2, rows[9][1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {r[0]: r for r in rows}


def result(spark, tables, name):
    return QUERIES[name](spark, tables[0])


def test_op1_shards(spark, tables):
    df = result(spark, tables, "op1_histogram_sort")
    out = {r.doc_id: r for r in df.collect()}
    assert set(out) == set(tables[1]) and {r.law for r in out.values()} == {"bytes"}
    slots, loads = defaultdict(list), Counter()
    for i, r in out.items():
        text = (tables[1][i][1] or "").encode()
        assert (r["size"], r.text_crc32, r.grown_shard) == (len(text) + 8, zlib.crc32(text), None)
        assert 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in out.values())
    assert max(loads.values()) <= sum(loads.values()) / 24 + largest


def test_op2_base_scores(spark, tables):
    tokens = {i: [*re.findall(WORD, (r[1] or "").translate(LOWER)), None] for i, r in tables[1].items()}
    train = Counter(t for i, ts in tokens.items() if crc(i) % 10 for t in ts)
    n, v = sum(train.values()), len(train)
    for r in result(spark, tables, "op2_log_bilinear").collect():
        own = tokens[r.doc_id]
        base = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert r.held_out == (crc(r.doc_id) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(train[t] > 0 for t in own), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0 and math.isfinite(r.score)


def test_op3_counts(spark, tables):
    for r in result(spark, tables, "op3_divergence_rules").collect():
        text = tables[1][r.doc_id][1] or ""
        w = re.findall(WORD, text)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeat = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines, seen, twice = [x for x in text.split("\n") if re.search(WORD, x)], set(), 0
        for line in lines:
            twice += line in seen
            seen.add(line)
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(repeat), failed,
        )
        assert not (failed and r.kept)


def test_op5_op6_held_out_rows_and_values(spark, tables):
    out = result(spark, tables, "op5_toxic_lexicon").collect()
    assert {r.doc_id for r in out} == set(tables[1])
    for r in out:
        assert r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    told = {r.doc_id: r.predicted for r in out if r.doc_id < 70}
    assert all(told[i] == (i % 5 == 0) for i in told)
    for r in result(spark, tables, "op6_viterbi_language").collect():
        text = tables[1][r.doc_id][1] or ""
        assert r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text))


def test_op7_places(spark, tables):
    out = result(spark, tables, "op7_exact_complement_packing").collect()
    filled = defaultdict(list)
    pieces = defaultdict(list)
    for r in out:
        filled[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    assert set(pieces) == set(tables[1])
    for places in filled.values():
        ends = [0]
        for offset, length in sorted(places):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    for own in pieces.values():
        assert [p for p, _, _ in sorted(own)] == list(range(len(own))) and min(own)[1] == 0
    assert len(filled) == -(-sum(r.length for r in out) // 2048)


def test_op9_and_op8_touch_planted_rows_only(spark, tables):
    assert {(r.doc_id, r.item_id) for r in result(spark, tables, "op9_qgram_contamination").collect()} == {(9, 2)}
    touched = {r.doc_id for r in result(spark, tables, "op8_chained_passages").collect()}
    assert touched <= {4, 100, 101}


def test_op10_equals_its_sql(spark, tables):
    got = sorted(map(tuple, result(spark, tables, "op10_jaccard_join").select("doc_id", "n_shingles", "component_id").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tables[0]}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(ORACLES["op10_jaccard_join"]).fetchall())
    assert dict((a, c) for a, _, c in got)[100] == 4


def test_op4_names_its_columns(spark, tables):
    out = result(spark, tables, "op4_kneser_ney").collect()
    assert {r.doc_id for r in out} == set(tables[1])
