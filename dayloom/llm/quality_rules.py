"""Quality rules by divergence from language references."""

from __future__ import annotations

from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import text as T
from dayloom.session import stage

# Classes of bytes. A character of more than one byte counts at its first byte.
CLASSES = ["lower", "upper", "digit", "space", "stop", "symbol", "mark", "wide", "control"]
_STOPS = b".,;:!?'\"()-"
_SYMBOLS = b"#*$%&|<>"


def _class_table() -> np.ndarray:
    b = np.arange(256)
    table = np.full(256, CLASSES.index("mark"))
    table[(b >= 97) & (b <= 122)] = CLASSES.index("lower")
    table[(b >= 65) & (b <= 90)] = CLASSES.index("upper")
    table[(b >= 48) & (b <= 57)] = CLASSES.index("digit")
    table[b < 32] = CLASSES.index("control")
    table[T.IS_SPACE] = CLASSES.index("space")
    table[list(_STOPS)] = CLASSES.index("stop")
    table[list(_SYMBOLS)] = CLASSES.index("symbol")
    table[b >= 0xC0] = CLASSES.index("wide")
    table[(b >= 0x80) & (b < 0xC0)] = len(CLASSES)  # later bytes of a character
    return table


CLASS_OF = _class_table()


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules. Distances are square roots of Jensen–Shannon divergences in
    bits, so they lie between 0 and 1."""

    min_words: int = 50
    max_repeat_percent: int = 50
    class_distance: float = 0.3
    #: Texts with fewer words are not judged by their common words.
    common_min_words: int = 50
    common_distance: float = 0.5
    common_words: int = 64


def _class_counts(part: T.Slice) -> np.ndarray:
    wide = len(CLASSES) + 1
    doc = np.repeat(np.arange(part.n), np.diff(part.offsets))
    flat = np.bincount(doc * wide + CLASS_OF[part.data], minlength=part.n * wide)
    return flat.reshape(part.n, wide)[:, :-1]


def _lower_hashes(part: T.Slice) -> np.ndarray:
    """Hashes of the lower-cased words of a slice that keeps its capitals."""
    return T.Slice(0, part.data, part.offsets, lower=True).word_hashes()


def _repeats(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    if len(hashes) < 4:
        return 0
    _, at, count = np.unique(T.shingles(hashes, 3), return_inverse=True, return_counts=True)
    again = count[at] > 1
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    seen, again = set(), 0
    for line in text.split(b"\n"):
        if line and line.strip(b" \t\n\r\x0b\x0c"):
            again += line in seen
            seen.add(line)
    return again


@dataclass
class References:
    """By language: shares of the character classes, and the common words, in order, with theirs
    (the last share is all other words)."""

    classes: np.ndarray
    words: list[np.ndarray]
    shares: list[np.ndarray]


def references(docs: DataFrame, text: str, lang: str, limits: Limits) -> References:
    """Histograms of each language over all documents that have a language and enough words."""

    def count(batches):
        classes: dict[str, np.ndarray] = {}
        words: dict[str, list] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for part in T.slices(batch.column(0), lower=False):
                hashes, counts = _lower_hashes(part), _class_counts(part)
                for i in range(part.n):
                    name, lo, hi = langs[part.doc + i], part.words[i], part.words[i + 1]
                    if name is None or hi - lo < limits.min_words:
                        continue
                    classes[name] = classes.get(name, 0) + counts[i]
                    words.setdefault(name, []).append(hashes[lo:hi])
            for name, parts in words.items():
                if len(parts) > 1 and sum(map(len, parts)) > 1 << 20:
                    yield from _word_rows(name, parts)
                    words[name] = []
        for name, parts in words.items():
            yield from _word_rows(name, parts)
        for name, c in classes.items():
            yield _rows(name, np.arange(len(c)), c, "c")

    kind = "lang string, kind string, item long, n long"
    counted = docs.select(text, lang).mapInArrow(count, kind)
    counted = stage(counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), "counts")
    totals = counted.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    # the most frequent words of each language: every task keeps its own first ones only
    place = F.expr("row_number() OVER (PARTITION BY lang, kind ORDER BY n DESC, item)")
    top = counted.withColumn("place", place).where(F.col("place") <= max(limits.common_words, len(CLASSES)))
    top = top.join(totals, ["lang", "kind"])
    top = top.where((F.col("kind") == "c") | (F.col("place") <= limits.common_words))
    found: dict[str, dict] = {}
    for r in top.collect():
        found.setdefault(r.lang, {"c": {}, "w": {}, "total": 0})[r.kind][r["item"]] = r.n
        if r.kind == "w":
            found[r.lang]["total"] = r.total
    out = References(np.zeros((0, len(CLASSES))), [], [])
    for name in sorted(found):
        c = np.array([found[name]["c"].get(i, 0) for i in range(len(CLASSES))], float)
        out.classes = np.vstack([out.classes, c / c.sum()])
        w = np.array(list(found[name]["w"]), np.int64).view(np.uint64)
        n = np.array(list(found[name]["w"].values()), float)[np.argsort(w)]
        out.words.append(np.sort(w))
        out.shares.append(np.append(n, max(0, found[name]["total"] - n.sum())) / max(1, found[name]["total"]))
    return out


def _rows(name: str, items: np.ndarray, counts: np.ndarray, kind: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(items)), pa.array([kind] * len(items)), pa.array(items, pa.int64()),
         pa.array(counts, pa.int64())],
        ["lang", "kind", "item", "n"],
    )


def _word_rows(name: str, parts: list[np.ndarray]):
    if parts:
        items, counts = np.unique(np.concatenate(parts), return_counts=True)
        yield _rows(name, items.view(np.int64), counts, "w")


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Between the rows of two arrays of distributions."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def quality_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", limits: Limits = Limits()
) -> DataFrame:
    """Counts, distances and the verdict ``kept`` for every row.

    A text fails the base rules with fewer than ``min_words`` words or too many words in
    repeated 3-word windows. Otherwise it is compared with the nearest language reference: by its
    common words, lower-cased, if it has ``common_min_words`` words, else by its character
    classes. It fails if its classes are further than ``class_distance`` from that reference, or
    its common words (with as many words) further than ``common_distance``. References come from
    all words and characters of all rows with a language and ``min_words`` words; the language of
    a row is not used to judge it. Without any reference only the base rules hold.

    Null texts count as empty and fail; repeated rows and ties are judged alike; null keys stay
    null; other columns are ignored; an empty table gives an empty one.
    """
    # plain values: broadcast data is read where this module need not be installed
    refs = docs.sparkSession.sparkContext.broadcast(astuple(references(docs, text, lang, limits)))

    def judge(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in _COLUMNS}
            for part in T.slices(batch.column(1), lower=False):
                hashes, counts = part.word_hashes(), _class_counts(part)
                lower = _lower_hashes(part)
                chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
                for i in range(part.n):
                    lo, hi = part.words[i], part.words[i + 1]
                    words = int(hi - lo)
                    repeat = _repeats(hashes[lo:hi])
                    failed = words < limits.min_words or 100 * repeat > limits.max_repeat_percent * words
                    far, odd = _distances(counts[i], lower[lo:hi], References(*refs.value), limits)
                    good = far is None or far <= limits.class_distance
                    if words >= limits.common_min_words:
                        good = good and (odd is None or odd <= limits.common_distance)
                    at = part.data[part.offsets[i] : part.offsets[i + 1]].tobytes()
                    row = (
                        words, int((chars[part.ends[lo:hi]] - chars[part.starts[lo:hi]]).sum()),
                        int(counts[i][CLASSES.index("symbol")]), _dup_lines(at), repeat, failed,
                        not failed and bool(good), far, odd,
                    )
                    for n, v in zip(_COLUMNS, row, strict=True):
                        out[n].append(v)
            arrays = [pa.array(out[n], t) for n, t in _COLUMNS.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [key, *_COLUMNS])

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, class_distance double, common_distance double"
    )
    return docs.select(key, text).mapInArrow(judge, schema)


_COLUMNS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
    "class_distance": pa.float64(), "common_distance": pa.float64(),
}


def _distances(
    classes: np.ndarray, words: np.ndarray, refs: References, limits: Limits
) -> tuple[float | None, float | None]:
    """To the nearest reference, by character classes and by common words."""
    if not len(refs.classes) or not len(words):
        return None, None
    far = js_distance(classes / classes.sum(), refs.classes)
    odd = np.ones(len(far))
    for i, (known, shares) in enumerate(zip(refs.words, refs.shares, strict=True)):
        if len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            hit = known[at] == words
            counts = np.bincount(at[hit], minlength=len(known) + 1)
            counts[-1] = len(words) - hit.sum()
            odd[i] = js_distance(counts / len(words), shares)
    # ties of one measure are decided by the other
    first, second = (odd, far) if len(words) >= limits.common_min_words else (far, odd)
    nearest = np.lexsort((second, first))[0]
    return float(far[nearest]), float(odd[nearest])


def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = quality_rules(docs)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "common_distance",
    )
