import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayloom.llm import shards
from dayloom.llm.packing import best_fit, pack_documents, plan
from dayloom.llm.tokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_tokens_equal_the_tokenizer():
    whole, words = Tokenizer.from_file(PATH), WordTokens(PATH)
    for text in (
        "it's we'll 'S don'T 12ab3", "İstanbul ΣΑΣ Straße ﬁ ŉ ǆ ſ ª º µ × ÷", "<|endoftext|> x<|startoftext|>y",
        "a\x1cb a b é é", "你好 नमस्ते мир", "", "   ", "''s 'LL'll",
    ):
        assert words.encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr("dayloom.llm.tokens.WORDS", 20)
    whole, words = Tokenizer.from_file(PATH), WordTokens(PATH)
    for i in range(200):
        text = f"word{i} other{i % 7} thing{i * i}"
        assert words.encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(words) < 60


def test_words_learned_together_equal_the_tokenizer():
    rng = random.Random(7)
    whole, words = Tokenizer.from_file(PATH), WordTokens(PATH)
    signs = "eeeaaainthsto" * 3 + "ABZzéèüßñÉÀçİŉſªµ×" + "019²½" + "'''.,!$#<|>-_" + "你д́\x85"
    texts = [
        " ".join("".join(rng.choices(signs, k=rng.choice([1, 2, 3, 5, 9, 14, 70]))) for _ in range(rng.randrange(60)))
        for _ in range(300)
    ]
    texts += ["a" * 63 + " " + "a" * 64 + " " + "aa" * 3000, "we'll'LL'd's're x'vex 'm' ''t", "\n\t "]
    calls = []
    by_tokenizer = words._by_tokenizer
    words._by_tokenizer = lambda word: calls.append(word) or by_tokenizer(word)
    got = words.encode_all([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    # the tokenizer is called only for what the merges alone do not settle
    assert calls and all(len(w) > 60 or not w.isascii() or b"<|" in w for w in calls)
    calls.clear()
    assert words.encode_all([b"plain W\xc3\xb6rter, it's 12 $$$ more"])[0].size and not calls
    assert words.encode_all([]) == [] and words.encode_all([b"", b" "])[1].size == 0


def test_words_of_one_call_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr("dayloom.llm.tokens.WORDS", 20)
    whole, words = Tokenizer.from_file(PATH), WordTokens(PATH)
    for i in range(60):
        texts = [f"word{i} other{i % 7}", "", f"thing{i * i} été{i} 你{i % 3}"]
        got = words.encode_all([t.encode() for t in texts])
        assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(words) < 60


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = random.Random(seed)
    counts = {n: rng.randrange(1, 30) for n in rng.sample(range(1, 65), 30)}
    made = plan(counts, 64)
    used = defaultdict(int)
    for pattern, n in made:
        assert n > 0 and sum(pattern) <= 64
        for x in pattern:
            used[x] += n
    assert used == counts
    assert sum(n for _, n in made) <= sum(n for _, n in best_fit(counts, 64)) + 1


def test_best_fit_matches_one_by_one():
    counts = {40: 3, 33: 2, 20: 7, 11: 5, 3: 9}
    bins: list[int] = []
    for x in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
        room = [r for r in bins if r >= x]
        if room:
            bins.remove(min(room))
            bins.append(min(room) - x)
        else:
            bins.append(64 - x)
    assert sum(n for _, n in best_fit(counts, 64)) == len(bins)


def test_documents_round_trip(spark, docs, odd_rows):
    out = [r for r in pack_documents(docs(odd_rows)).collect()]
    whole = Tokenizer.from_file(PATH)
    want = sorted(tuple(whole.encode(t or "", add_special_tokens=False).ids + [0]) for _, t, _ in odd_rows)
    pieces, by_sequence = defaultdict(dict), defaultdict(list)
    for r in out:
        ids = np.array(r.ids, "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and len(ids) == r.length and r.start == 2048 * r.piece
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.piece, r.doc_id].setdefault("x", []).append(tuple(r.ids))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    single = sorted(t for (p, d), v in pieces.items() for t in v["x"] if d != 6)
    assert single == [w for w in want if len(w) <= 2048]
    long = [t for p in range(10**3) if (p, 6) in pieces for t in pieces[p, 6]["x"]]
    assert sum(long, ()) == next(w for w in want if len(w) > 2048)
    assert pack_documents(docs([])).collect() == []


def check_shards(rows, n, slack):
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r.shard] += r.bytes
        slots[r.shard].append(r.slot)
    mean = sum(size.values()) / n
    assert all(abs(size[s] - mean) <= slack for s in range(n))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_with_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(shards, "CELL_ROWS", 64)
    rng = random.Random(4)
    rows = [(i, "hot text" if i % 3 == 0 else f"t{i} " + "x" * rng.randrange(200), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = shards.histogram_sort(df, F.col("text"), F.octet_length("text") + 8, shards=7)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "shard", "slot", "bytes"] and len(got) == 3000
    check_shards(got, 7, 0.02 * sum(r.bytes for r in got) / 7 + 210)
    cold = defaultdict(set)
    for r in got:
        cold[r.text].add(r.shard)
    assert all(len(v) == 1 for t, v in cold.items() if t != "hot text")


def test_shards_of_equal_and_odd_rows(spark, docs, odd_rows):
    same = spark.createDataFrame([(1, "a")] * 500, "doc_id long, text string")
    check_shards(shards.histogram_sort(same, F.col("text"), F.lit(10), shards=5).collect(), 5, 20)
    out = shards.histogram_sort(docs(odd_rows), F.col("text"), F.octet_length("text"), shards=3).collect()
    assert len(out) == len(odd_rows) and {r.doc_id for r in out} == {1, 2, 3, 4, 5, 6, 7, None}
    assert shards.histogram_sort(docs([]), F.col("text"), F.lit(1)).collect() == []


def test_shards_stay_in_the_engine(spark, docs, odd_rows):
    out = shards.histogram_sort(docs(odd_rows), F.col("text"), F.octet_length("text"), shards=3)
    plan_ = out._jdf.queryExecution().toString()
    assert "Python" not in plan_ and "Arrow" not in plan_ and "Pandas" not in plan_
