"""Periodic runs of words, found by recompression and grammar LCE queries.

The words of some texts become one sequence of numbers, with a number of its own between two
texts. Recompression rewrites the sequence level by level: block compression turns every maximal
repetition of one symbol into a single symbol, pair compression splits the symbols in two halves
and joins every left one with the right one behind it. The levels are a run-length grammar of the
texts in which equal stretches are written alike but for their edges, so how far two places agree
(LCE) is found by climbing the levels while both agree and descending to the first difference.

A run of period q and at least 2q words holds a place k*q that agrees with (k+1)*q. These places of
the harmonic grid are the candidates (n log n of them, compared by array); LCE queries in both
directions extend the ones that agree to the whole run.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dayloom.llm import text as T

MIN_WORDS = 12
#: Candidates that are extended together, and text that is compressed together.
CANDIDATES = 1 << 18
SLICE_BYTES = 1 << 20


@dataclass
class Level:
    """One sequence of the grammar and how the next one covers it.

    ``cover[k]`` is the symbol of the next level over symbol k; ``down[m]`` is where symbol m of
    the next level begins (one more entry for the end). ``block``: how the next level was made.
    """

    symbols: np.ndarray
    cover: np.ndarray
    down: np.ndarray
    block: bool

    def mirrored(self) -> Level:
        n, m = len(self.symbols), len(self.down) - 1
        return Level(self.symbols[::-1], (m - 1 - self.cover)[::-1], (n - self.down)[::-1], self.block)


class Grammar:
    """A run-length grammar of a sequence.

    ``symbols`` are numbers; the highest ones, from ``fixed`` on, occur once each, first and last
    among other places: they are never joined with others, and nothing is equal across them.
    """

    def __init__(self, symbols: np.ndarray, fixed: int):
        self.levels: list[Level] = []
        now, salt = symbols.astype(np.int64), 0
        self.top = now
        # done when two symbols that can be joined are nowhere neighbours
        while (free := now < fixed)[1:].dot(free[:-1]):
            starts = np.ones(len(now), bool)
            starts[1:] = now[1:] != now[:-1]
            if not starts.all():
                now, fixed = self._add(now, starts, fixed, True)
            while True:
                salt += 1
                left = T.salted(now.view(np.uint64), salt) & np.uint64(1) == 0
                free = now < fixed
                if not (free[:-1] & free[1:]).any():
                    break
                open_, close = left & free, ~left & free
                pairs, flipped = open_[:-1] & close[1:], close[:-1] & open_[1:]
                pairs = flipped if flipped.sum() > pairs.sum() else pairs
                if pairs.any():
                    starts = np.ones(len(now), bool)
                    starts[1:] = ~pairs
                    now, fixed = self._add(now, starts, fixed, False)
                    break
        self.top = now
        self.back = [level.mirrored() for level in self.levels]

    def _add(self, now: np.ndarray, starts: np.ndarray, fixed: int, block: bool) -> tuple[np.ndarray, int]:
        """Writes the next level; its symbols are numbered by what they stand for."""
        down = np.append(np.flatnonzero(starts), len(now))
        size = np.diff(down)
        first, other = now[down[:-1]], size if block else np.where(size > 1, now[down[1:] - 1], -1)
        joined = size > 1
        out = first.copy()
        keep, old = np.unique(first[~joined & (first < fixed)], return_inverse=True)
        out[~joined & (first < fixed)] = old
        base = len(keep)
        if joined.any():
            order = np.lexsort((other[joined], first[joined]))
            a, b = first[joined][order], other[joined][order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            number = np.empty(len(order), np.int64)
            number[order] = np.cumsum(new) - 1
            out[joined] = base + number
            base += int(new.sum())
        alone = first >= fixed  # in order, so they stay distinct
        out[alone] = base + np.arange(alone.sum())
        kind = np.int32 if len(now) < 1 << 31 else np.int64
        self.levels.append(Level(now.astype(kind), (np.cumsum(starts) - 1).astype(kind), down.astype(kind), block))
        return out, base

    def lce(self, i: np.ndarray, j: np.ndarray, backward: bool = False) -> np.ndarray:
        """How many symbols agree from places i and j on (i != j), or before them."""
        levels = self.back if backward else self.levels
        n = len(levels[0].symbols) if levels else len(self.top)
        top = self.top[::-1] if backward else self.top
        i, j = (n - i, n - j) if backward else (i, j)
        a, b = i.astype(np.int64), j.astype(np.int64)
        stop = np.full(len(a), len(levels))
        act = np.arange(len(a))
        for k, level in enumerate(levels):
            x, y = a[act], b[act]
            cx, cy = level.cover[x], level.cover[y]
            inside = (level.down[cx] != x) | (level.down[cy] != y)
            ends = inside & (level.symbols[x] != level.symbols[y])
            rx = np.where(inside & ~ends, level.down[cx + 1] - x, 0)
            ry = np.where(inside & ~ends, level.down[cy + 1] - y, 0)
            step = np.minimum(rx, ry)
            a[act], b[act] = x + step, y + step
            ends |= rx != ry
            stop[act[ends]] = k
            act = act[~ends]
            if not len(act):
                break
            x, y = a[act], b[act]
            # behind a whole symbol that agrees the next begins; both are at beginnings here
            a[act] = np.where(level.down[level.cover[x]] == x, level.cover[x], level.cover[x] + 1)
            b[act] = np.where(level.down[level.cover[y]] == y, level.cover[y], level.cover[y] + 1)
        while len(act):  # at the top only single symbols stand between those that occur once
            act = act[top[a[act]] == top[b[act]]]
            a[act] += 1
            b[act] += 1
        for k in range(len(levels) - 1, -1, -1):
            level, at = levels[k], np.flatnonzero(stop > k)
            if not len(at):
                continue
            m, o = a[at], b[at]
            x, y = level.down[m].astype(np.int64), level.down[o].astype(np.int64)
            same = level.symbols[x] == level.symbols[y]
            step = np.minimum(level.down[m + 1] - x, level.down[o + 1] - y) if level.block else 1
            step = np.where(same, step, 0)
            a[at], b[at] = x + step, y + step
        return a - i


def _candidates(ids: np.ndarray, doc: np.ndarray, longest: int, q_least: int = 1):
    """Places i and i + q of one text that agree, as does a neighbour; i is a multiple of q.

    Yields ``i, q`` in chunks. A run's agreeing stretch has at least ``max(q, 12 - q)`` words.
    """
    found, n = [], 0
    for q in range(q_least, longest // 2 + 1):
        grid = ids[::q]
        k = np.flatnonzero(grid[1:] == grid[:-1])
        if not len(k):
            continue
        i = k * q
        i = i[doc[i] == doc[i + q]]
        near = (ids[i + 1] == ids[np.minimum(i + q + 1, len(ids) - 1)]) | (ids[i - 1] == ids[i + q - 1])
        i = i[near]
        if len(i):
            found.append((i, np.full(len(i), q)))
            n += len(i)
        if n >= CANDIDATES:
            yield tuple(np.concatenate(x) for x in zip(*found, strict=True))
            found, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, ...]:
    """All runs of texts that stand one behind the other: ``doc, start, length, period``.

    ``words`` are numbers, equal where words are; ``sizes`` is the number of words of each text.
    Starts count from the beginning of the text. Sorted by text, start and period.
    """
    kinds, ids = np.unique(words, return_inverse=True)
    n_docs, fixed = len(sizes), len(kinds)
    doc = np.repeat(np.arange(n_docs), sizes)
    # a separator before every text and one at the end
    place = np.arange(len(ids)) + doc + 1
    sequence = np.empty(len(ids) + n_docs + 1, np.int64)
    owner = np.empty(len(sequence), np.int64)
    apart = np.ones(len(sequence), bool)
    apart[place] = False
    sequence[place], owner[place] = ids, doc
    sequence[apart] = fixed + np.arange(n_docs + 1)
    owner[apart] = -1 - np.arange(n_docs + 1)
    begin = np.cumsum(np.concatenate([[0], sizes[:-1] + 1])) + 1 if n_docs else np.empty(0, np.int64)
    out = [np.empty((0, 4), np.int64)]
    grammar = None
    for i, q in _candidates(sequence, owner, int(sizes.max(initial=0))):
        if grammar is None:
            grammar = Grammar(sequence, fixed)
        ahead = grammar.lce(i, i + q)
        behind = grammar.lce(i, i + q, backward=True)
        # every run once for a period: from its first place on the grid
        keep = (behind < q) & (ahead + behind >= np.maximum(q, least - q))
        i, q, ahead, behind = (x[keep] for x in (i, q, ahead, behind))
        at = owner[i]
        out.append(np.stack([at, i - behind - begin[at], ahead + behind + q, q], 1))
    runs = np.concatenate(out)
    # the same stretch under a multiple of its period is no run of its own
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
    runs = runs[first]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    return tuple(runs.T)


def kept_words(runs: tuple[np.ndarray, ...], sizes: np.ndarray) -> np.ndarray:
    """Which words stay: all but those that a run holds after its first period."""
    doc, start, length, period = runs
    begin = np.concatenate([[0], np.cumsum(sizes)])
    edge = np.zeros(begin[-1] + 1, np.int64)
    np.add.at(edge, begin[doc] + start + period, 1)
    np.add.at(edge, begin[doc] + start + length, -1)
    return np.cumsum(edge)[:-1] == 0


_COLUMNS = {
    "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
    "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
}


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_WORDS, periodic: bool = False,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: its number of runs, the longest one, digests of all runs and of the
    text without repetitions; with ``with_text`` also ``runs`` (array of structs) and ``collapsed``.

    A run is a stretch of words with smallest period ``period`` and at least
    ``max(least, 2 * period)`` words (``least`` is 3 or more) that no neighbouring word extends. Of several longest runs the
    one with the smallest start, then period, is shown. Words after the first period of a run are
    dropped from the collapsed text. ``periodic`` makes texts of every tenth key periodic first, as
    the query asks.

    A text is a row, so it is searched in one task, whatever its length, with memory in proportion;
    nothing is shuffled. Null and blank texts have no runs and the digests of empty strings; a null
    key is kept and never makes a text periodic; repeated rows give repeated rows; an empty table
    gives an empty one; other columns are ignored.
    """

    if least < 3:
        raise ValueError("runs have 3 words at least")

    def search(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for part in T.slices(batch.column(1), lower=False, size=SLICE_BYTES):
                sizes = np.diff(part.words)
                source = np.arange(len(part.starts))
                if periodic:
                    for i in range(part.n):
                        _make_periodic(source[part.words[i] : part.words[i + 1]], keys[part.doc + i])
                runs = find_runs(part.word_hashes()[source], sizes, least)
                where, data = _collapsed(part, source, kept_words(runs, sizes), sizes)
                bound = np.searchsorted(runs[0], np.arange(part.n + 1))
                rows: dict[str, list] = {n: [] for n in _COLUMNS}
                texts, lists = [], []
                for i in range(part.n):
                    start, length, period = (x[bound[i] : bound[i + 1]].tolist() for x in runs[1:])
                    found = list(zip(start, length, period, strict=True))
                    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                    short = data[where[i] : where[i + 1]].tobytes()
                    row = (
                        len(found), *best, 1000 * best[1] // best[2] if found else None,
                        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(short).hexdigest(),
                    )
                    for n, v in zip(_COLUMNS, row, strict=True):
                        rows[n].append(v)
                    if with_text:
                        texts.append(short.decode())
                        lists.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                columns = [batch.column(0).slice(part.doc, part.n), *(pa.array(rows[n], t) for n, t in _COLUMNS.items())]
                names = [key, *_COLUMNS]
                if with_text:
                    columns += [pa.array(lists, _RUNS), pa.array(texts, pa.string())]
                    names += ["runs", "collapsed"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    if with_text:
        schema += ", runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(key, text).mapInArrow(search, schema)


_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _make_periodic(source: np.ndarray, key: int | None) -> None:
    """For every tenth key: words from a place on repeat the p words there, both by the key's hash."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    n = len(source)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        source[a:] = source[a] + np.arange(n - a) % p


def _collapsed(part: T.Slice, source: np.ndarray, keep: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of every text joined by blanks: where the texts begin, and all bytes."""
    doc = np.repeat(np.arange(part.n), sizes)[keep]
    first, size = part.starts[source[keep]], (part.ends - part.starts)[source[keep]]
    gap = np.ones(len(doc), np.int64)  # a blank before every word but a text's first
    gap[:1] = 0
    gap[1:] = doc[1:] == doc[:-1]
    at = np.cumsum(size + gap) - size
    total = int(at[-1] + size[-1]) if len(doc) else 0
    data = np.full(total, 0x20, np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    data[np.repeat(at, size) + within] = part.data[np.repeat(first, size) + within]
    bytes_of = np.bincount(doc, weights=size + gap, minlength=part.n).astype(np.int64)
    return np.concatenate([[0], np.cumsum(bytes_of)]), data


def op12(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf}/documents.parquet"), periodic=True)
