"""Language identification: scripts, scores of words, and Viterbi over the words of a text."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import text as T

CELLS = 1 << 16
#: Cost of a change of language between two words, in nats.
SWITCH = 12.0
#: Overlapping letter triples are not independent; their log odds count by this factor.
WEIGHT = 0.5
#: A language may use a script if this share of its words does.
SCRIPT_SHARE = 0.01
OUTSIDE = -100.0
SEGMENT = 32
#: Scores held at once: words times languages.
HELD = 6_000_000

# First and last code point of the letters of scripts; Latin is script 0.
SCRIPTS = [
    (0x00C0, 0x024F, 0), (0x0370, 0x03FF, 1), (0x0400, 0x052F, 2), (0x0531, 0x058F, 3), (0x0591, 0x05FF, 4),
    (0x0600, 0x06FF, 5), (0x0750, 0x077F, 5), (0x0900, 0x097F, 6), (0x0980, 0x09FF, 7), (0x0A00, 0x0A7F, 8),
    (0x0A80, 0x0AFF, 9), (0x0B80, 0x0BFF, 10), (0x0C00, 0x0C7F, 11), (0x0E00, 0x0E7F, 12), (0x10A0, 0x10FF, 13),
    (0x1100, 0x11FF, 14), (0x1E00, 0x1EFF, 0), (0x1F00, 0x1FFF, 1), (0x3040, 0x30FF, 15), (0x3400, 0x9FFF, 16),
    (0xAC00, 0xD7AF, 14),
]
_FIRST, _LAST, _SCRIPT = (np.array(x) for x in zip(*SCRIPTS, strict=True))
N_SCRIPTS = int(_SCRIPT.max()) + 1
#: Which code points are letters; the ranges hold digits, marks and signs as well.
_LETTER = np.array([unicodedata.category(chr(i))[0] == "L" for i in range(1 << 16)])


def _cells(part: T.Slice) -> np.ndarray:
    """The cell of the byte triple around every byte; texts and words end at blanks."""
    d = part.data
    before, after = np.full(len(d), 32, np.uint32), np.full(len(d), 32, np.uint32)
    before[1:], after[:-1] = d[:-1], d[1:]
    edge = part.offsets[(part.offsets > 0) & (part.offsets < len(d))]
    before[edge], after[edge - 1] = 32, 32
    triple = (before << np.uint32(16)) | (d.astype(np.uint32) << np.uint32(8)) | after
    return (triple * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _scripts(part: T.Slice) -> np.ndarray:
    """Script of every word: the highest of its letters, -1 without letters."""
    out = np.full(len(part.starts), -1)
    d = part.data
    if not len(out):
        return out
    out[np.add.reduceat(((d >= 97) & (d <= 122)).astype(np.int32), part.starts) > 0] = 0
    lead = np.flatnonzero(d >= 0xC3)
    if len(lead):
        size = np.where(d[lead] < 0xE0, 1, np.where(d[lead] < 0xF0, 2, 3))
        point = d[lead].astype(np.int64) & (0x3F >> size)
        for k in (1, 2, 3):
            more = size >= k
            point[more] = (point[more] << 6) | (d[np.minimum(lead[more] + k, len(d) - 1)] & 0x3F)
        k = np.searchsorted(_FIRST, point, side="right") - 1
        known = (k >= 0) & (point <= _LAST[np.maximum(k, 0)]) & _LETTER[np.minimum(point, 0xFFFF)]
        word = np.searchsorted(part.starts, lead[known], side="right") - 1
        np.maximum.at(out, word, _SCRIPT[k[known]])
    return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang"):
    """Names of the languages, scores of the cells, and which scripts each may use, as plain
    values. Counts byte triples and scripts over all rows with a language; the sums have at most
    ``CELLS`` plus the scripts as rows for each language."""

    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for part in T.slices(batch.column(0)):
                cells, script = _cells(part), _scripts(part)
                inside = ~T.IS_SPACE[part.data]
                row = {name: i for i, name in enumerate(dict.fromkeys(langs[part.doc : part.doc + part.n]))}
                code = np.array([row[x] for x in langs[part.doc : part.doc + part.n]], np.int64)
                width = CELLS + N_SCRIPTS
                byte = np.repeat(code, np.diff(part.offsets))[inside] * width + cells[inside]
                word = (np.repeat(code, np.diff(part.words)) * width + CELLS + script)[script >= 0]
                counts = np.bincount(np.concatenate([byte, word]), minlength=len(row) * width).reshape(-1, width)
                for name, i in row.items():
                    if name is not None:
                        found[name] = found.get(name, 0) + counts[i]
        for name, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at), pa.array(counts[at])], ["lang", "cell", "n"]
            )

    rows = docs.where(F.col(lang).isNotNull()).select(text, lang)
    sums = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = sums.toPandas()
    names = sorted(set(table["lang"]))
    counts = np.zeros((CELLS + N_SCRIPTS, len(names)))
    code = table["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(np.int64)
    counts[table["cell"].to_numpy(np.int64), code] = table["n"].to_numpy(float)
    cells, scripts = counts[:CELLS], counts[CELLS:]
    scores = np.log(cells + 0.5) - np.log(cells.sum(0) + 0.5 * CELLS)
    scores -= scores.max(1, keepdims=True) if len(names) else 0
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True
    return names, (WEIGHT * scores).astype(np.float32), allowed


def _word_scores(part: T.Slice, cells: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores by word and language, and the script of each word."""
    script = _scripts(part)
    if not len(part.starts):
        return np.zeros((0, cells.shape[1]), np.float32), script
    each = cells[_cells(part)]
    each[T.IS_SPACE[part.data]] = 0
    scores = np.add.reduceat(each, part.starts, axis=0)
    scores[script < 0] = 0
    scores[script >= 0] += np.where(allowed, 0, OUTSIDE).astype(np.float32)[script[script >= 0]]
    return scores, script


def viterbi(scores: np.ndarray, words: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word. ``words[i]:words[i + 1]`` are the words of text i.

    Texts are cut into segments of ``SEGMENT`` words. All segments at once give their best
    scores from each entry to each exit language; a pass over the segments of each text joins
    them; then each segment is traced back from its exit. The result is that of one pass over
    the whole text."""
    n, langs = scores.shape
    if not n:
        return np.empty(0, np.int64)
    sizes = np.diff(words)
    per = -(-sizes // SEGMENT)
    first = np.concatenate([[0], np.cumsum(per)])
    total = int(first[-1])
    owner = np.repeat(np.arange(len(sizes)), per)
    start = words[:-1][owner] + (np.arange(total) - first[:-1][owner]) * SEGMENT
    stop = np.minimum(start + SEGMENT, words[1:][owner])
    best = np.full((total, langs, langs), -1e30, np.float32)
    best[:, np.arange(langs), np.arange(langs)] = 0
    for t in range(SEGMENT):
        on = np.flatnonzero(start + t < stop)
        if not len(on):
            break
        now = best[on]
        best[on] = np.maximum(now, now.max(2, keepdims=True) - switch) + scores[start[on] + t][:, None, :]
    # over the segments of each text, longest texts first
    order = np.argsort(-per, kind="stable")
    value = np.zeros((len(sizes), langs))
    enter = np.zeros((total, langs), np.int64)
    for s in range(int(per.max())):
        live = order[: np.searchsorted(-per[order], -s, side="left")]
        path = value[live][:, :, None] + best[first[live] + s]
        enter[first[live] + s] = path.argmax(1)
        value[live] = path.max(1)
    last = value.argmax(1)
    exit_ = np.zeros(total, np.int64)
    entry = np.zeros(total, np.int64)
    for s in range(int(per.max()) - 1, -1, -1):
        live = order[: np.searchsorted(-per[order], -s, side="left")]
        at = first[live] + s
        exit_[at] = last[live]
        entry[at] = enter[at, last[live]]
        last[live] = entry[at]
    # within the segments
    now = np.full((total, langs), -1e30, np.float32)
    now[np.arange(total), entry] = 0
    came = np.zeros((SEGMENT, total, langs), np.int8 if langs < 128 else np.int16)
    for t in range(SEGMENT):
        on = np.flatnonzero(start + t < stop)
        if not len(on):
            break
        top = now[on].argmax(1)
        change = now[on, top][:, None] - switch > now[on]
        came[t, on] = np.where(change, top[:, None], np.arange(langs))
        now[on] = np.where(change, now[on, top][:, None] - switch, now[on]) + scores[start[on] + t]
    out = np.empty(n, np.int64)
    state = exit_
    for t in range(SEGMENT - 1, -1, -1):
        on = np.flatnonzero(start + t < stop)
        out[start[on] + t] = state[on]
        state[on] = came[t, on, state[on]]
    return out


def identify(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred, lang_score, lang_spans``.

    Each word gets a score for every language from its letter triples, and only languages that
    use its script are candidates; the best path with a cost for every change labels the words.
    ``lang_pred`` is the language of most words with letters (the first by name in a tie),
    ``lang_score`` its share of them, ``lang_spans`` the runs of words ``first, last, lang``.

    A null text or one without letters is ``und`` with score 0 and no spans; so is every text
    if the model has no language. Repeated rows are labelled alike, other columns come along (those of
    the three names are replaced), an
    empty table gives an empty one.
    """
    docs = docs.drop("lang_pred", "lang_score", "lang_spans")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())]))

    def label(batches):
        names, cells, allowed = sent.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            preds, shares, spans = ["und"] * len(column), [0.0] * len(column), [[] for _ in range(len(column))]
            held: list[tuple] = []

            def settle():
                scores = np.concatenate([h[1] for h in held])
                counts = np.concatenate([np.diff(h[3]) for h in held])
                words = np.concatenate([[0], np.cumsum(counts)])
                path, script = viterbi(scores, words, SWITCH), np.concatenate([h[2] for h in held])
                rows = np.concatenate([np.arange(h[0], h[0] + len(h[3]) - 1) for h in held])
                for row, lo, hi in zip(rows.tolist(), words[:-1].tolist(), words[1:].tolist(), strict=True):
                    own = path[lo:hi]
                    votes = np.bincount(own[script[lo:hi] >= 0], minlength=len(names))
                    if votes.sum():
                        k = int(votes.argmax())
                        preds[row], shares[row] = names[k], float(votes[k] / votes.sum())
                        cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [hi - lo]])
                        spans[row] = [
                            {"first": int(a), "last": int(b) - 1, "lang": names[own[a]]}
                            for a, b in zip(cut[:-1], cut[1:], strict=True)
                        ]

            size = 0
            for part in T.slices(column) if names else ():
                scores, script = _word_scores(part, cells, allowed)
                held.append((part.doc, scores, script, part.words))
                size += scores.size
                if size > HELD:
                    settle()
                    held, size = [], 0
            if held:
                settle()
            for row in [i for i, p in enumerate(preds) if p == "und"] if names else ():
                # letters outside the listed scripts: no evidence, the first language stands
                if any(c.isalpha() for c in column[row].as_py() or ""):
                    preds[row] = names[0]
            new = [pa.array(preds), pa.array(shares, pa.float64()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], [*batch.schema.names, "lang_pred", "lang_score", "lang_spans"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    added = "lang_pred string, lang_score double, lang_spans array<struct<first: long, last: long, lang: string>>"
    return docs.mapInArrow(label, f"{kinds}, {added}")


def held_out(key: str, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))


def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit(docs.where(~held_out("doc_id", 3, 1)))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )
