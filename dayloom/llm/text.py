"""Vectorised word handling over Arrow string columns, shared by the operators.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``, the same as the code-point pattern
``[^\\x20\\x09-\\x0D]+`` because UTF-8 never uses those bytes inside a longer sequence.
A null text counts as an empty one. Work goes through slices of about ``SLICE_BYTES`` of
text, so memory does not follow the Arrow batch; a single longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BYTE = np.arange(256, dtype=np.uint8)
IS_SPACE = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler."""
    x = x ^ (x >> np.uint64(30))
    x = x * _SALTS[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _SALTS[1]
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th of several independent scramblings of the same 64-bit values."""
    return mix(x + np.uint64(0xD6E8FEB86659FD93 * (2 * k + 1) % 2**64))


class Slice:
    """Some texts: their bytes, one after the other, and where words begin and end.

    ``doc`` is the row of the first text within its batch; ``words[i]:words[i + 1]`` are the
    words of text i.
    """

    def __init__(self, doc: int, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.doc, self.offsets, self.n = doc, offsets, len(offsets) - 1
        self.data = LOWER[data] if lower else data
        inside = ~IS_SPACE[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edge = offsets[(offsets > 0) & (offsets < len(data))]
            first[edge] = inside[edge]
            last[edge - 1] = inside[edge - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.words = np.searchsorted(self.starts, offsets)

    def word_hashes(self) -> np.ndarray:
        """64-bit hashes of the words, from their bytes alone."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        lengths = self.ends - self.starts
        where = np.repeat(self.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        within = where - np.repeat(self.starts, lengths)
        powers = np.empty(int(lengths.max()), np.uint64)
        powers[0] = 1
        powers[1:] = _BASE
        powers = np.multiply.accumulate(powers)
        values = (self.data[where].astype(np.uint64) + np.uint64(1)) * powers[within]
        return mix(np.add.reduceat(values, np.cumsum(lengths) - lengths))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.LargeStringArray):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, where, data = column.buffers()
    if not len(column) or where is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a column in order, some at a time: the row of the first one, their bytes and
    where texts begin and end."""
    data, offsets = _buffers(column)
    at = 0
    while at < len(offsets) - 1:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), len(offsets) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def slices(column: pa.Array, lower: bool = True, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in order, as slices."""
    for doc, data, offsets in spans(column, size):
        yield Slice(doc, data, offsets, lower)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive words; the whole sequence as one if it is shorter."""
    if not len(hashes):
        return hashes
    k_eff = min(k, len(hashes))
    n = len(hashes) - k_eff + 1
    out = np.full(n, k_eff, np.uint64)
    for i in range(k_eff):
        out = mix(out * _BASE + hashes[i : i + n])
    return out


def list_array(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.Array:
    """Arrays of numbers as one Arrow list column."""
    lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))
