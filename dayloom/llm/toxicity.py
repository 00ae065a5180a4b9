"""Toxicity by a weighted lexicon, matched by an Aho–Corasick automaton on folded text."""

from __future__ import annotations

import math
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.session import stage

#: The lexicon is fitted on at most so many labelled rows, those with the least hash of the key.
FIT_ROWS = 20_000
#: Rows that must hold a term, and the share of toxic ones among them.
MIN_SUPPORT, MIN_SHARE = 4, 0.5
STEM_LENGTHS = range(3, 13)

# Letters of other scripts that look like Latin ones, and characters that stand
# in for letters. Folding also joins i, l, 1 and the like, which are all used for each other.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "ո": "n",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ι": "i", "κ": "k", "ν": "v", "τ": "t",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ⅼ": "l",
}
SUBSTITUTES = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "l", "|": "l"}
SAME = {"i": "l"}
_INVISIBLE = "​‌‍⁠﻿­"


def _table() -> dict[int, str]:
    """Every folded character: lower case, wide forms, look-alikes, stand-ins, then ``SAME``;
    what is no letter after that becomes a blank, so words begin and end at blanks."""
    table = {}
    for c in range(0x0530):
        x = chr(c)
        small = HOMOGLYPHS.get(x.lower(), x.lower())
        small = SUBSTITUTES.get(small, small)
        small = "".join(SAME.get(y, y) for y in small)
        table[c] = small if all(unicodedata.category(y)[0] in "LM" for y in small) else " "
    for c in range(0xFF21, 0xFF5B):
        x = unicodedata.normalize("NFKC", chr(c)).lower()
        table[c] = SAME.get(x, x) if x.isalpha() else " "
    table |= {ord(x): SAME.get(y, y) for x, y in HOMOGLYPHS.items()}
    table |= {ord(x): None for x in _INVISIBLE}
    table |= {c: " " for c in range(0x2000, 0x2060) if chr(c) not in _INVISIBLE}
    return table


FOLDS = _table()


def fold(text: str) -> str:
    """Folded text between blanks; later marks of a letter stay with it. A digit or sign folds
    to a letter wherever it stands, so '1d10t' and 'idiot' are the same word, and a mark at the
    end of a word ('clown!') may add a letter: terms are also sought without it."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return f" {text.translate(FOLDS)} "


def _fit_counts(rows: DataFrame) -> DataFrame:
    """``term, whole, n, bad`` of word beginnings (``whole``: complete words) and of two-word
    phrases, in how many rows and toxic rows; from ``text, toxic``."""

    def count(batches):
        for batch in batches:
            terms: dict = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = fold(text or "").split()
                found = {(w[:n], False) for w in set(words) for n in STEM_LENGTHS if n <= len(w)}
                found |= {(w, True) for w in set(words) if len(w) >= STEM_LENGTHS[0]}
                for t in found:
                    c = terms.setdefault(t, [0, 0])
                    c[0] += 1
                    c[1] += toxic
            columns = list(zip(*[(t, w, n, b) for (t, w), (n, b) in terms.items()], strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["term", "whole", "n", "bad"]
            )

    counted = rows.select("text", "toxic").mapInArrow(count, "term string, whole boolean, n long, bad long")
    return counted.groupBy("term", "whole").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def choose_terms(counts: list[tuple[str, bool, int, int]], rate: float, tried: int = 1) -> dict[tuple[str, bool], float]:
    """The lexicon: terms with enough rows and toxic share, and their weights (log odds against
    the base rate). Where ``tried`` terms were looked at, chance alone must not explain one of
    them. Of word beginnings that contain each other the one with most evidence stands; one
    that is nearly always a complete word is matched as a word only."""
    good = {(t, w): (n, b) for t, w, n, b in counts if n >= MIN_SUPPORT and b >= MIN_SHARE * n}
    good = {t: c for t, c in good.items() if _evidence(*c, rate) >= math.log(max(tried, 1)) + 2}
    chosen: dict[tuple[str, bool], float] = {}
    held: set[str] = set()  # stems taken, and all their beginnings
    stems = sorted((t for t, w in good if not w), key=lambda t: (-_evidence(*good[t, False], rate), -len(t), t))
    for t in stems:
        if t in held or any((t[:k], False) in chosen or (t[:k], True) in chosen for k in range(STEM_LENGTHS[0], len(t))):
            continue
        n, bad = good[t, False]
        held |= {t[:k] for k in range(STEM_LENGTHS[0], len(t) + 1)}
        whole = good.get((t, True), (0, 0))[0] >= 0.95 * n
        chosen[t, whole] = math.log((bad + 0.5) / (n - bad + 0.5)) - math.log(rate / (1 - rate))
    return chosen


def _evidence(n: int, bad: int, rate: float) -> float:
    """Log likelihood ratio of the term's own toxic share against the base rate."""
    share = (bad + 0.01) / (n + 0.02)
    return bad * math.log(share / rate) + (n - bad) * math.log((1 - share) / (1 - rate))


class Matcher:
    """Finds lexicon terms and exception phrases in folded text."""

    def __init__(self, terms: dict[tuple[str, bool], float], phrases: set[str]):
        self.automaton = ahocorasick.Automaton()
        for (t, whole), weight in terms.items():
            key = f" {t} " if whole else f" {t}"
            self.automaton.add_word(key, (len(key), t, weight))
            if whole:  # a mark behind the word that folds to a letter
                for mark in "l":
                    self.automaton.add_word(f" {t}{mark} ", (len(key) + 1, t, weight))
        self.phrases = phrases
        if len(self.automaton):
            self.automaton.make_automaton()

    def find(self, folded: str) -> list[tuple[int, str, float]]:
        """Place, term and weight of each match that no exception phrase covers."""
        if not len(self.automaton):
            return []
        out = []
        for end, (size, term, weight) in self.automaton.iter(folded):
            at = end + 1 - size
            if self.phrases and not self.phrases.isdisjoint(around(folded, at)):
                continue
            out.append((at + 1, term, weight))
        return out


def around(folded: str, at: int) -> list[str]:
    """The two-word phrases with the word that begins after the blank at ``at``."""
    end = folded.find(" ", at + 1)
    word = folded[at + 1 : end]
    before = folded[:at].rsplit(None, 1)[-1:] if at else []
    after = folded[end : end + 64].split(None, 1)[:1]
    return [f"{x} {word}" for x in before] + [f"{word} {x}" for x in after]


def features(matches: list, words: int) -> list[float]:
    total = sum(w for *_, w in matches)
    return [1.0, math.log1p(total), math.log1p(1000 * total / (words + 50))]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        w += np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", usable: Column | None = None):
    """Lexicon, exception phrases and the scale of the score, as plain values.

    Learns from at most ``FIT_ROWS`` labelled rows for which ``usable`` holds. Word beginnings
    and words are counted by row and label in Spark; those above the support come to the
    driver, a number that the bound on rows limits. Rows whose label or key is null are not
    used; of several labels of a key the largest counts; without labels every score is 0.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy(key).agg(F.max("toxic").cast("long").alias("toxic"))
    known = known.orderBy(F.xxhash64(key), key).limit(FIT_ROWS)
    # FIT_ROWS bounds this side
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(known), key).select("text", "toxic")
    rows = stage(rows, "labelled")
    share = rows.agg(F.avg("toxic")).first()[0]
    if not share or share == 1:
        return {}, set(), [-30.0, 0.0, 0.0]
    counts = stage(_fit_counts(rows).where(F.col("n") >= MIN_SUPPORT), "terms")
    likely = counts.where(F.col("bad") >= F.col("n") * MIN_SHARE).select("term", "whole", "n", "bad")
    terms = choose_terms([tuple(r) for r in likely.collect()], share, counts.count())
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def look(batches):
        """A row for each labelled text, and each phrase around a term."""
        matcher = Matcher(sent.value, set())
        for batch in batches:
            out = []
            for text_, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(text_ or "")
                for phrase in {p for at, *_ in matcher.find(folded) for p in around(folded, at - 1)}:
                    out.append((phrase, 1, toxic))
            columns = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int64(), pa.int64()], strict=True)],
                ["phrase", "n", "bad"],
            )

    seen = rows.mapInArrow(look, "phrase string, n long, bad long").groupBy("phrase")
    seen = seen.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    phrases = {r.phrase for r in seen.where(f"n >= {MIN_SUPPORT - 1} AND bad = 0").collect()}
    sent2 = docs.sparkSession.sparkContext.broadcast((terms, phrases))

    def measure(batches):
        matcher = Matcher(*sent2.value)
        for batch in batches:
            x = [_measured(matcher, t) for t in batch.column(0).to_pylist()]
            names = ["a", "b", "c", "y"]
            values = np.array(x, float).reshape(len(x), 3)
            yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in values.T), batch.column(1).cast(pa.float64())], names)

    # equal rows are counted, then at most FIT_ROWS rows fit the scale
    points = rows.mapInArrow(measure, "a double, b double, c double, y double").toPandas().to_numpy()
    return terms, phrases, [float(v) for v in _logistic(points[:, :3], points[:, 3])]


def _measured(matcher: Matcher, text: str | None) -> list[float]:
    folded = fold(text or "")
    matches = matcher.find(folded)
    return features(matches, folded.count(" ") if matches else 0)


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``tox_score`` (0 to 1) and ``tox_terms``, the terms found.

    Null and empty texts score like any text without a term. Repeated rows score alike; other
    columns come along, columns of these two names are replaced; an empty table gives an empty one.
    """
    docs = docs.drop("tox_score", "tox_terms")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches):
        terms, phrases, scale = sent.value
        matcher = Matcher(terms, phrases)
        for batch in batches:
            scores, found = [], []
            for x in batch.column(batch.schema.get_field_index(text)).to_pylist():
                folded = fold(x or "")
                matches = matcher.find(folded)
                z = np.dot(features(matches, folded.count(" ") if matches else 0), scale)
                scores.append(float(1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
                found.append(sorted({t for _, t, _ in matches}))
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "tox_score", "tox_terms"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(rate, f"{kinds}, tox_score double, tox_terms array<string>")


def held_out(key: str, parts: int, part: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts == part


def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = fit(docs, labels, usable=~held_out("doc_id", 4, 2))
    out = score(docs, model)
    held = F.coalesce(held_out("doc_id", 4, 2), F.lit(False))
    return out.select(
        "doc_id", held.alias("held_out"), F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.3).cast("int").alias("predicted"),
    )
