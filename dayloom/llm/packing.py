"""Best-fit packing of token sequences by exact complements."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import text as T
from dayloom.llm.tokens import WordTokens
from dayloom.session import stage

CAPACITY = 2048
#: Rows that one task is meant to number.
CELL_ROWS = 1 << 15


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = 0,
    capacity: int = CAPACITY, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32`` and ``ids`` if wanted.

    ``path`` is the tokenizer's file as every executor sees it; by default that of the
    installed tokenizer files. A text's ids end with ``end``; longer ones are cut every
    ``capacity`` ids. A null text has the end only.
    """

    def cut(batches):
        place = path
        if place is None:
            import public_tokenizers

            place = public_tokenizers.path("word_bpe_49k.json")
        words = WordTokens(place)
        for batch in batches:
            # one output batch for some texts, so that memory stays in bounds
            for first, data, offsets in T.spans(batch.column(1)):
                row, number, start, length, crc, found = [], [], [], [], [], []
                data, offsets = data.tobytes(), offsets.tolist()
                texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                for i, ids in enumerate(words.encode_all(texts), first):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at : at + capacity]
                        row.append(i)
                        number.append(k)
                        start.append(at)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.tobytes()))
                        if with_ids:
                            found.append(own.astype(np.int32))
                columns = [batch.column(0).take(pa.array(row)), pa.array(number, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                names = [key, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, T.list_array(found, pa.int32())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, and how many sequences follow each.

    Longest lengths first: what fills the gap exactly with one, two or three pieces is taken as
    often as there are pieces; what no combination completes is packed best-fit, longest first.
    Taking exact fills early can leave worse rests than it saves, so the same is tried with
    fewer pieces to a fill, and the plan with the fewest sequences stands. Works on the number
    of pieces by length, so its size is bounded by the capacity.
    """
    plans = [_filled(counts, capacity, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda made: sum(n for _, n in made))


def _filled(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan whose exact fills have at most ``most`` pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    rest: dict[int, int] = {}
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            left[length] -= 1  # the piece whose gap is filled
            fill = _complement(left, capacity - length, most)
            left[length] += 1
            if fill is None:
                rest[length] = int(left[length])
                left[length] = 0
                break
            pattern = (length, *fill)
            need = np.bincount(pattern, minlength=1)
            n = min(int(left[x] // need[x]) for x in set(pattern))
            for x in pattern:
                left[x] -= n
            out.append((pattern, n))
    return out + best_fit(rest, capacity)


def _complement(left: np.ndarray, gap: int, most: int = 3) -> tuple[int, ...] | None:
    """One, two or three available lengths with sum ``gap``; larger ones are used up first."""
    if most and left[gap]:
        return (gap,)
    found = _pair(left, gap) if most > 1 else None
    if found or most < 3:
        return found
    for a in np.flatnonzero(left[: max(gap - 1, 0)])[::-1].tolist():
        if 3 * a < gap:
            break
        left[a] -= 1
        found = _pair(left, gap - a, a)
        left[a] += 1
        if found:
            return (a, *found)
    return None


def _pair(left: np.ndarray, total: int, most: int | None = None) -> tuple[int, int] | None:
    large = np.arange(total - 1, (total - 1) // 2, -1)
    if most is not None:
        large = large[large <= most]
    small = total - large
    ok = (left[large] > 0) & (left[small] > 0) & ((large != small) | (left[large] > 1))
    at = np.flatnonzero(ok)
    return (int(large[at[0]]), int(small[at[0]])) if len(at) else None


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: equal sequences are kept as one pattern with a number."""
    open_: dict[int, list[list]] = {}  # by free space: patterns and numbers
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                per = min(n, capacity // length)
                k = n // per
                open_.setdefault(capacity - per * length, []).append([(length,) * per, k])
                n -= k * per
                continue
            pattern, k = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(n, k)
            if used < k:
                open_.setdefault(room, []).append([pattern, k - used])
            open_.setdefault(room - length, []).append([(*pattern, length), used])
            n -= used
    return [(tuple(p), k) for groups in open_.values() for p, k in groups]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of equal-length pieces: length and first rank (sorted), the sequence of that
    rank, the offset in it."""
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rank = next_rank.get(length, 0)
            next_rank[length] = rank + n
            rows.append((length, rank, sequence, offset))
            offset += length
        sequence += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return columns[0], columns[1], columns[2], columns[3]


def pack(rows: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """All rows and columns with ``sequence_id`` and ``offset``: pieces of 1 to ``capacity``
    tokens in as few sequences as the plan finds.

    Only the number of pieces by length goes to the driver, where the plan is made; every
    piece then gets a rank among those of its length, and its rank says its place. A length
    that very many pieces share is ranked in cells of about ``CELL_ROWS`` rows. Columns named
    ``sequence_id`` or ``offset`` are replaced; a null length is an error; repeated
    rows are pieces of their own; an empty table gives an empty one.
    """
    rows = rows.drop("sequence_id", "offset")
    kept = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    slim = stage(rows.select(kept, F.col(length).alias("len"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if dict(rows.dtypes)[c] != "array<int>"], F.monotonically_increasing_id()).alias("h")), "pieces")
    counts = {r["len"]: r["n"] for r in slim.groupBy("len").agg(F.count("*").alias("n")).collect()}
    if any(x is None or not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    sent = slim.sparkSession.sparkContext.broadcast(_places(plan(counts, capacity)))
    cells = max(1, -(-max(counts.values(), default=1) // CELL_ROWS))
    placed = slim.withColumn("cell", F.pmod("h", F.lit(cells)))
    offsets = placed.groupBy("len", "cell").agg(F.count("*").alias("n"))
    first = F.expr("sum(n) OVER (PARTITION BY len ORDER BY cell) - n")
    offsets = offsets.select("len", "cell", first.alias("first"))
    number = F.expr("row_number() OVER (PARTITION BY len, cell ORDER BY h) - 1")
    ranked = placed.withColumn("i", number).join(offsets, ["len", "cell"])
    ranked = ranked.select("row", "len", (F.col("first") + F.col("i")).alias("rank"))

    def put(batches):
        lengths, ranks, sequences, offsets_ = sent.value
        keys = lengths * (1 << 44) + ranks
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False)
            rank = batch.column(2).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, own * (1 << 44) + rank, side="right") - 1
            new = [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets_[at])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *new], ["row", "sequence_id", "offset"])

    kind = ranked.schema["row"].dataType.simpleString()
    return ranked.mapInArrow(put, f"row {kind}, sequence_id long, offset long").select("row.*", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, with_ids: bool = True
) -> DataFrame:
    """Documents as packed pieces, with their token ids if wanted: ``pieces`` and then ``pack``.

    Every row of ``docs`` is a document, a null text an empty one (the end token only), null and
    repeated keys included; other columns are ignored; an empty table gives an empty one.
    """
    return pack(pieces(docs, key, text, path, with_ids=with_ids))


def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = pack_documents(docs, with_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
