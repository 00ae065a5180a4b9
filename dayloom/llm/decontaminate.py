"""Benchmark decontamination by the q-gram lemma and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Q = 12
#: A window begins at every character, so equal excerpts are found wherever they begin.
WINDOW = 80
#: One edit for so many characters of a window.
PER_EDIT = 16
#: Benchmark characters indexed at a time; a larger benchmark goes through in blocks.
BLOCK_CHARS = 1 << 17
SLICE_CHARS = 1 << 20
#: Windows aligned at a time.
VERIFIED = 1 << 14
_TABLE_BITS = 24


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one blank, no ends."""
    return " ".join((text or "").lower().replace("\0", " ").split())


def budget(length: int) -> int:
    """Edits allowed in a window: as many as the lemma can still see, at most one in ``PER_EDIT``."""
    return min(length // PER_EDIT, length // Q - 1)


def grams(points: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``Q`` characters, by doubling: 2, 4, 8, 12."""
    if len(points) < Q:
        return np.empty(0, np.uint64)
    b = 0x9E3779B97F4A7C15
    p1, p2, p4 = (np.uint64(pow(b, k, 2**64)) for k in (1, 2, 4))
    one = points.astype(np.uint64) + np.uint64(1)
    two = one[:-1] * p1 + one[1:]
    four = two[:-2] * p2 + two[2:]
    eight = four[:-4] * p4 + four[4:]
    out = eight[: len(one) - Q + 1] * p4 + four[8 : 8 + len(one) - Q + 1]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """Some benchmark items, one behind the other with gaps, and where each q-gram stands in them.
    Plain arrays in ``state`` travel to the executors. A window is known by its first place."""

    def __init__(self, state: dict):
        self.__dict__.update(state)
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[(self.hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    @staticmethod
    def state(items: list[str]) -> dict:
        texts = [np.frombuffer(normal(t).encode("utf-32-le", "replace"), np.uint32) for t in items]
        lengths = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(lengths + WINDOW) - lengths  # a window apart, so none reaches another item
        points = np.zeros(int((lengths + WINDOW).sum()) + WINDOW, np.uint32)
        hashes, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for at, t in zip(first.tolist(), texts, strict=True):
            points[at : at + len(t)] = t
            hashes.append(grams(t))
            places.append(at + np.arange(len(hashes[-1])))
        flat, place = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(flat, kind="stable")
        unique, start = np.unique(flat[order], return_index=True)
        sizes = np.minimum(lengths, WINDOW)
        return {
            "points": points, "first_of": first, "last_of": first + lengths - sizes, "sizes": sizes,
            "edits": np.array([max(0, budget(n)) for n in sizes.tolist()], np.int64), "hashes": unique,
            "start": np.append(start, len(flat)), "place": place[order],
        }

    def item(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_of, place, side="right") - 1

    def _hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a place in the text and a place of an item with the same q-gram."""
        h = grams(points)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        real = self.hashes[k] == h[at]
        at, k = at[real], k[real]
        inner = _inside_repeats(h, at)
        at, k = at[~inner], k[~inner]
        many = self.start[k + 1] - self.start[k]
        each = np.repeat(self.start[k] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.repeat(at, many), self.place[each]

    def search(self, points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Text, window, first and last place and edits of each region that matches.

        ``points`` holds several texts with a separator behind each; ``starts`` is where they begin
        and where the next would. Regions lie within one text.
        """
        at, place = self._hits(points)
        if not len(at):
            return
        doc = np.searchsorted(starts, at, side="right") - 1
        item, diagonal = self.item(place), at - place + len(self.points)  # not negative
        size, e = self.sizes[item], self.edits[item]
        exact = self._exact(doc, item, diagonal, place)
        x_doc, x_window, x_diagonal, x_item = exact
        x_first = x_window + x_diagonal - len(self.points)
        yield x_doc, x_window, x_first, x_first + self.sizes[x_item], np.zeros(len(x_doc), np.int64)
        # two families of bands of width 2e + 2, shifted by half: one holds any spread up to e
        for half in (0, 1):
            shift = half * (e + 1)
            low = (diagonal + shift) // (2 * e + 2) * (2 * e + 2) - shift
            order = np.lexsort((place, low, item, doc))
            d, m, b, s = doc[order], item[order], low[order], place[order]
            need = np.maximum(1, size[order] + 1 - Q * (e[order] + 1))
            j = np.arange(len(s)) + need - 1
            ok = j < len(s)
            j = np.minimum(j, len(s) - 1)
            span = size[order] - Q
            ok &= (d[j] == d) & (m[j] == m) & (b[j] == b) & (s[j] - s <= span)
            # so many hits from here on fit a window that begins in [lo, hi]
            d, m, b, lo, hi = d[ok], m[ok], b[ok], (s[j] - span)[ok], s[ok]
            lo, hi = np.maximum(lo, self.first_of[m]), np.minimum(hi, self.last_of[m])
            joined = np.zeros(len(d), bool)
            joined[1:] = (d[1:] == d[:-1]) & (m[1:] == m[:-1]) & (b[1:] == b[:-1])
            lo[1:] = np.where(joined[1:], np.maximum(lo[1:], hi[:-1] + 1), lo[1:])
            many = np.maximum(hi - lo + 1, 0)
            window = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            d, m, b = (np.repeat(x, many) for x in (d, m, b))
            known = x_diagonal + half * (self.edits[x_item] + 1)
            width = 2 * self.edits[x_item] + 2
            known = known // width * width - half * (self.edits[x_item] + 1)
            left = ~np.isin(_packed(d, window, b), _packed(x_doc, x_window, known))
            d, m, b, window = d[left], m[left], b[left] - len(self.points), window[left]
            for k in range(0, len(window), VERIFIED):
                part = slice(k, k + VERIFIED)
                bounds = starts[d[part]], starts[d[part] + 1] - 1
                found, first, last, edits = self._verify(points, window[part], m[part], b[part], *bounds)
                yield d[part][found], window[part][found], first, last, edits

    def _exact(self, doc, item, diagonal, place) -> tuple[np.ndarray, ...]:
        """Windows whose q-grams all stand on one diagonal: equal text, nothing to align."""
        order = np.lexsort((place, diagonal, doc))
        d, g, s, m = doc[order], diagonal[order], place[order], item[order]
        j = np.arange(len(s)) + self.sizes[m] - Q
        ok = j < len(s)
        j = np.minimum(j, len(s) - 1)
        ok &= (d[j] == d) & (g[j] == g) & (s[j] - s == self.sizes[m] - Q)
        return d[ok], s[ok], g[ok], m[ok]

    def _verify(self, points, window, item, low, text_lo, text_hi):
        """Least edits of each window against its text around the band: which are within budget,
        where they begin and end, and how many edits they have."""
        e, size = self.edits[item], self.sizes[item]
        top = int(e.max())
        columns, far = 4 * top + 3, np.int16(400)
        start = window + low - top
        c = np.arange(columns, dtype=np.int16)
        cost = np.zeros((len(window), columns), np.int16)
        origin = np.broadcast_to(c, cost.shape).copy()
        best, end, begin = np.full(len(window), 400), np.zeros(len(window), np.int64), np.zeros(len(window), np.int64)
        rows = np.arange(len(window))[:, None]
        base = start[:, None] + c
        lo, hi = text_lo[:, None], text_hi[:, None]
        for r in range(int(size.max(initial=0))):
            where = base + r
            outside = (where < lo) | (where >= hi)
            other = points[np.clip(where, 0, len(points) - 1)] != self.points[window + r][:, None]
            step = cost + np.where(outside, far, other.astype(np.int16))
            # a character only in the window
            take = np.zeros(cost.shape, bool)
            take[:, :-1] = cost[:, 1:] + 1 < step[:, :-1]
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            came = origin.copy()
            came[:, :-1] = np.where(take[:, :-1], origin[:, 1:], origin[:, :-1])
            # characters only in the text: the best column before, at one edit a column
            np.minimum(step, far, out=step)
            run = np.minimum.accumulate((step - c) * np.int16(64) + (np.int16(63) - c), axis=1)
            pick = np.int16(63) - (run & np.int16(63))
            filled = (run >> np.int16(6)) + c
            came = came[rows, pick]
            live = r < size
            if live.all():
                cost, origin = filled, came
            else:
                cost, origin = np.where(live[:, None], filled, cost), np.where(live[:, None], came, origin)
            done = r + 1 == size
            if done.any():
                k = cost[done].argmin(1)
                best[done] = cost[done].min(1)
                end[done] = start[done] + r + 1 + k
                begin[done] = start[done] + origin[done, k]
        ok = (best <= e) & (begin >= text_lo) & (end <= text_hi)
        return ok, begin[ok], end[ok], best[ok]


def _packed(doc: np.ndarray, window: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (doc.astype(np.uint64) << np.uint64(48)) ^ (window.astype(np.uint64) << np.uint64(26)) ^ low.astype(np.uint64)


#: Periods of repeated characters that are looked through, and how much of such a stretch is kept
#: at both ends.
PERIODS = 16
KEPT = 4 * WINDOW


def _inside_repeats(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which places lie deep inside a stretch that repeats a few characters, like a line of dashes.
    All windows there are found at the stretch's ends as well, with the same first and last place."""
    inner = np.zeros(len(at), bool)
    if len(at) <= 2 * KEPT:
        return inner
    for period in range(1, PERIODS + 1):
        same = (at[period:] - at[:-period] == period) & (h[at[period:]] == h[at[:-period]])
        if not same.any():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            inner[lo + KEPT : max(lo + KEPT, hi + period - KEPT)] = True
    return inner


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of about ``BLOCK_CHARS`` characters, one block at a time."""
    keys, texts, size = [], [], 0
    for r in benchmark.where(F.col(text).isNotNull()).select(item, text).toLocalIterator():
        keys.append(r[0])
        texts.append(r[1])
        size += len(r[1])
        if size >= BLOCK_CHARS:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key, item, windows, first, last, edits`` for every row of ``docs`` and benchmark item
    that share a passage.

    Items are cut into windows of ``WINDOW`` characters at every character, a shorter item is
    one window; case and runs of white space do not count. A window with at most e edits in a
    text shares ``size + 1 - Q * (e + 1)`` q-grams with it, on diagonals at most e apart: bands
    of diagonals with so many are aligned, and those within e edits match. ``windows`` is the
    number of the item's windows found, ``first, last`` the places of the region in the
    normalised text, ``edits`` the fewest edits of a window. As windows begin at every character,
    any passage of ``WINDOW`` characters of an item within the edits is found. A region lies in one
    text, whatever stands beside it in a batch. Hits are kept by item place and slid over, not listed
    by window, and the inside of a stretch that repeats a few characters is looked at from its ends.

    Null and empty texts share nothing, nor do items of fewer than ``Q`` characters; equal
    items and repeated rows are reported one by one; null keys stay null; other columns are
    ignored; without rows or items the result is empty.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    columns = f"`{key}` {kind}, block_item long, windows int, `first` long, `last` long, edits int"
    out = None
    for keys, texts in blocks(benchmark, item, item_text):
        sent = spark.sparkContext.broadcast(Index.state(texts))
        found = docs.select(key, text).mapInArrow(_finder(sent, key), columns)
        named = spark.createDataFrame(list(enumerate(keys)), f"block_item long, `{item}` {item_kind}")
        found = found.join(F.broadcast(named), "block_item").select(key, item, "windows", "first", "last", "edits")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], f"`{key}` {kind}, `{item}` {item_kind}, {columns.split('long, ', 1)[1]}")
    return out


def _finder(sent, key: str):
    def find(batches):
        index = Index(sent.value)
        for batch in batches:
            texts = [normal(x) for x in batch.column(1).to_pylist()]
            found: list[tuple] = []
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) < SLICE_CHARS):
                    size += len(texts[hi]) + 1
                    hi += 1
                points = np.frombuffer(("\0".join(texts[lo:hi]) + "\0").encode("utf-32-le", "replace"), np.uint32)
                starts = np.cumsum([0] + [len(x) + 1 for x in texts[lo:hi]])
                parts = list(index.search(points, starts)) if len(index.hashes) else []
                if parts:
                    found += _by_item(index, lo, starts, *map(np.concatenate, zip(*parts, strict=True)))
                lo = hi
            columns = list(zip(*found, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            rows, *rest = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [key, "block_item", "windows", "first", "last", "edits"]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *rest], names)

    return find


def _by_item(index: Index, row: int, starts, doc, window, first, last, edits) -> Iterator[tuple]:
    """One tuple for each text and item."""
    item = index.item(window)
    order = np.lexsort((window, item, doc))
    doc, item, window, first, last, edits = (x[order] for x in (doc, item, window, first, last, edits))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return
    other = new.copy()
    other[1:] |= window[1:] != window[:-1]
    first, last = first - starts[doc], last - starts[doc]
    columns = (
        row + doc[at], item[at], np.add.reduceat(other.astype(np.int64), at), np.minimum.reduceat(first, at),
        np.maximum.reduceat(last, at), np.minimum.reduceat(edits, at),
    )
    yield from zip(*(x.tolist() for x in columns), strict=True)


def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    return contamination(docs, benchmark)
