"""N-gram Jaccard join by prefix filters under several global orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import text as T
from dayloom.llm.graph import components
from dayloom.session import remove, stage, store

ORDERS = 3
#: Order 0 ranks this part of all shingles (those with the least hashes) by exact frequency.
RANKED_PART = 6
#: Star rounds at least and at most by order 0, and by the last order before pairs are listed.
STAR_ROUNDS = (1, 2)
LAST_ROUNDS = (0, 6)
#: The last order's exchange has so many parts at least (a shingle that is hotter fills one nearly
#: alone), a part that many shingles on average; a task holds as many before it sends them.
HOT_PART, PART_SHINGLES, HELD_SHINGLES = 64, 1 << 20, 1 << 20
#: Ranges of shingle hashes whose sizes bound the overlap of two sets.
BINS = 256
#: Most keys that are sent to all executors in place of a shuffle of texts.
SENT_KEYS = 1 << 20

_RANKED_BELOW = (1 << 64) // RANKED_PART  # hashes are not negative up to half of all values


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and distinct shingles of every text."""
    for part in T.slices(column):
        hashes = part.word_hashes()
        for i in range(part.n):
            yield part.doc + i, np.unique(T.shingles(hashes[part.words[i] : part.words[i + 1]], k))


def _length(n: int, percent: int) -> int:
    """Two sets over the threshold share one of so many first shingles under any order."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _prefix(found: np.ndarray, percent: int, order: int) -> np.ndarray:
    """The first shingles of a set under one of the scrambled orders."""
    length = _length(len(found), percent)
    if length >= len(found):
        return found
    return found[np.argpartition(T.salted(found, order), length - 1)[:length]]


def _by_part(percent: int) -> bool:
    """Whether the ranked part is larger than a prefix. If not, order 0 would be the order of the
    hashes for the most part, and the last order is used at once."""
    return RANKED_PART * (100 - percent) < 100


def _ranked(found: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """What may stand in the prefix of order 0, and how many of these are ranked by frequency:
    all shingles of the ranked part, and if they are too few, the next in hash order."""
    ranked = int(np.searchsorted(found, np.uint64(_RANKED_BELOW)))
    return found[: max(ranked, _length(len(found), percent))], ranked


def _cut(found: np.ndarray) -> np.ndarray:
    """The upper 48 bits of shingles, which the last order goes by; some may be one then."""
    return np.unique(found >> np.uint64(16)).astype(np.int64)


def _fingerprint(found: np.ndarray) -> bytes | None:
    """128 bits that do not depend on the order of the set; null for an empty one."""
    if not len(found):
        return None
    return np.array([T.salted(found, 8).sum(), T.salted(found, 9).sum()], np.uint64).tobytes()


def signatures(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """Of every row: ``key, n, cls`` (set size and fingerprint), ``n_cut`` (size of the set of 48-bit
    values), ``tokens`` that order 0 may put first (none where it is not used) with the number
    ``ranked`` of them, the prefixes of the other orders as 32-bit values, and ``bins``, the sizes
    of ``BINS`` parts of the set."""
    by_part = _by_part(percent)

    def sign(batches):
        for batch in batches:
            n, n_cut, cls, ranked, tokens, bins, parts = [], [], [], [], [], [], [[] for _ in _PREFIXES]
            for _, found in _sets(batch.column(1), k):
                n.append(len(found))
                n_cut.append(len(_cut(found)))
                cls.append(_fingerprint(found))
                first, count = _ranked(found, percent) if by_part else (found[:0], 0)
                tokens.append(first)
                ranked.append(count)
                bins.append(np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=BINS).astype(np.int32))
                for order, out in enumerate(parts, 1):
                    out.append((_prefix(found, percent, order) >> np.uint64(32)).astype(np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary())]
            columns += [pa.array(n_cut, pa.int64()), pa.array(ranked, pa.int64())]
            columns += [T.list_array(tokens), *(T.list_array(p, pa.int32()) for p in parts), T.list_array(bins, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [key, "n", "cls", "n_cut", "ranked", "tokens", *_PREFIXES, "bins"])

    kind = docs.schema[key].dataType.simpleString()
    arrays = "tokens array<long>, " + ", ".join(f"{p} array<int>" for p in [*_PREFIXES, "bins"])
    return docs.select(key, text).mapInArrow(sign, f"`{key}` {kind}, n long, cls binary, n_cut long, ranked long, {arrays}")


_PREFIXES = [f"p{i}" for i in range(1, ORDERS)]


def _texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``wanted``, which has ``owner``, with the texts ``_t`` of the owners."""
    if wanted.count() <= SENT_KEYS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    return texts.join(wanted, F.col("_k").eqNullSafe(F.col("owner"))).drop("_k", "owner")


def _whole_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, k: int) -> tuple[DataFrame, list[str]]:
    """``cls, s`` of the classes in ``wanted``, which has ``cls, owner``, and the folders they are
    in; each set is read again from the text of its owner."""

    def whole(batches):
        for batch in batches:
            found = [s for _, s in _sets(batch.column(1), k)]
            columns = [batch.column(0), pa.array([_fingerprint(s) for s in found], pa.binary()), T.list_array(found)]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "own", "s"])

    texts = _texts(docs, wanted, key, text).select("cls", "_t")
    sets = texts.mapInArrow(whole, "cls binary, own binary, s array<long>")
    sets, folder = store(sets.where("cls = own").drop("own"), "sets")
    # a key may stand on several rows with one text
    twice = sets.groupBy("cls").agg(F.count("*").alias("c")).where("c > 1")
    if twice.isEmpty():
        return sets, [folder]
    sets, once = store(sets.dropDuplicates(["cls"]), "sets")
    return sets, [folder, once]


def _ends(pairs: DataFrame) -> DataFrame:
    """``cls`` of all classes in ``pairs``."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))
    return stage(ends.distinct(), "ends")


def _sided(df: DataFrame, c: str) -> DataFrame:
    return df.select(*[F.col(x).alias(c if x == "cls" else f"{x}_{c}") for x in df.columns])


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs ``a, b``, those that share a prefix shingle under every further order,
    and whose bins allow the overlap that the threshold needs."""
    # the sketches are much wider than the pairs: only those of their classes are shuffled
    ends = _ends(pairs)
    sketches = sketches.join(F.broadcast(ends) if ends.count() <= SENT_KEYS else ends, "cls", "left_semi")
    kept = pairs.join(_sided(sketches, "a"), "a").join(_sided(sketches, "b"), "b")
    for p in _PREFIXES:
        kept = kept.where(F.arrays_overlap(f"{p}_a", f"{p}_b"))
    most = F.expr("aggregate(zip_with(bins_a, bins_b, (x, y) -> least(x, y)), 0L, (t, x) -> t + x)")
    return kept.where(most * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b", "n_a", "n_b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a, b, n_a, n_b``, those whose whole sets reach the threshold."""
    kept = pairs.join(_sided(sets, "a"), "a").join(_sided(sets, "b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return kept.where(common * 100 >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


def _postings(filled: DataFrame, owners: DataFrame, percent: int) -> DataFrame:
    """``token, cls, n``: the prefixes under order 0, without shingles that one class alone has.

    Order 0 has the ranked part first, rarest first by exact frequency, then all others by hash.
    A shingle of one class makes no candidates, so it only counts: of a class with ``own`` such
    ranked shingles, the prefix has ``own`` places fewer for shared ones.
    """
    short = filled.select(F.explode("tokens").alias("token"), F.xxhash64("cls").alias("c"))
    found = short.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("f"))
    shared = short.join(found.where("lo <> hi").select("token", "f"), "token")
    # a row of a class for each of its copies
    shared = shared.distinct().withColumn("in_part", F.col("token").between(0, _RANKED_BELOW - 1))
    length = F.expr(f"n - (({percent} * n + 99) div 100) + 1")
    placed = shared.join(owners.select("c", "cls", "n", "ranked"), "c")
    # both windows hold the tokens of one document
    placed = placed.withColumn("own", F.col("ranked") - F.expr("count_if(in_part) OVER (PARTITION BY c, cls)"))
    placed = placed.withColumn("place", F.expr("row_number() OVER (PARTITION BY c, cls ORDER BY NOT in_part, f, token)"))
    kept = placed.where((F.col("ranked") < length) | (F.col("place") <= length - F.col("own")))
    return kept.select("token", "cls", "n")


def _packed(tokens: np.ndarray, rows: np.ndarray) -> bytes:
    """Values of 48 bits and steps of row numbers, byte by byte in planes: nearly all of the upper
    ones are zero, so an exchange writes little for them."""
    steps = np.diff(rows, prepend=0)
    planes = [tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]]
    planes.append(steps.astype("<u4").view(np.uint8).reshape(-1, 4))
    return np.concatenate(planes, axis=1).T.tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(10, -1).T
    tokens = np.zeros((len(planes), 8), np.uint8)
    tokens[:, :6] = planes[:, :6]
    steps = np.ascontiguousarray(planes[:, 6:]).view("<u4")[:, 0]
    return tokens.view("<i8")[:, 0], np.cumsum(steps.astype(np.int64))


def _shared(texts: DataFrame, k: int, shingles: int) -> DataFrame:
    """``token, c, f`` of every shingle (48 bits) that several classes hold: the class and the number
    of these. ``texts`` has ``cls, c, _t``. Shingles go through one exchange in packed blocks, by
    parts of the hash; most stand in one class only and end there."""
    parts = max(HOT_PART, shingles // PART_SHINGLES)

    def sent(held):
        tokens = np.concatenate([x for _, x in held])
        row = np.repeat(np.arange(len(held)), [len(x) for _, x in held])
        part = tokens % parts
        order = np.argsort(part, kind="stable")
        ends = np.append(0, np.cumsum(np.bincount(part, minlength=parts)))
        number, classes, data = [], [], []
        for p in np.flatnonzero(np.diff(ends)):
            pick = order[ends[p] : ends[p + 1]]
            own, local = np.unique(row[pick], return_inverse=True)
            number.append(p)
            classes.append(np.array([held[i][0] for i in own], np.int64))
            data.append(_packed(tokens[pick] // parts, local))
        columns = [pa.array(number, pa.int32()), T.list_array(classes), pa.array(data, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["part", "classes", "data"])

    def find(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            cls, c = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, found in _sets(batch.column(2), k):
                # a key may stand on several rows, with one text or with others
                if c[i] in seen or _fingerprint(found) != cls[i]:
                    continue
                seen.add(c[i])
                held.append((c[i], _cut(found)))
                size += len(held[-1][1])
                if size >= HELD_SHINGLES:
                    yield sent(held)
                    held, size, seen = [], 0, set()
        if held:
            yield sent(held)

    def group(table):
        tokens, c = [], []
        for batch in table.to_batches():
            lists = batch.column("classes")
            own, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            numbers = batch.column("part").to_numpy()
            for p, data, first in zip(numbers, batch.column("data").to_pylist(), ends[:-1].tolist(), strict=True):
                found, row = _unpacked(data)
                tokens.append(found * parts + int(p))
                c.append(own[first + row])
        tokens, c = np.concatenate(tokens), np.concatenate(c)
        order = np.lexsort((c, tokens))
        tokens, c = tokens[order], c[order]
        # a class whose key stands on several rows may be sent by several tasks
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (c[1:] != c[:-1]))
        tokens, c = tokens[new], c[new]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        sizes = np.diff(np.append(first, len(tokens)))
        f = np.repeat(sizes, sizes)
        kept = f > 1
        return pa.table([pa.array(x[kept], pa.int64()) for x in (tokens, c, f)], names=["token", "c", "f"])

    blocks = texts.select("cls", "c", "_t").mapInArrow(find, "part int, classes array<long>, data binary")
    return blocks.groupBy("part").applyInArrow(group, "token long, c long, f long")


def _rarest(docs: DataFrame, wanted: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """``token, cls, n, place``: the prefixes of the classes in ``wanted`` (rows of the owners) under
    the last order, all shingles by their exact frequency among these classes, the rarest first.
    Shingles of one class alone only count; ``place`` counts them too."""
    shingles = wanted.agg(F.sum("n")).first()[0] or 0
    shared = _shared(_texts(docs, wanted.select("cls", "c", "owner"), key, text), k, shingles)
    placed = shared.join(wanted.select("c", "cls", "n", "n_cut"), "c")
    # Both windows hold the tokens of one document. Where two shingles of a set are one value, both
    # the values in common and those before a place are fewer by no more than that.
    placed = placed.withColumn("own", F.expr("n_cut - count(*) OVER (PARTITION BY c, cls)"))
    placed = placed.withColumn("place", F.expr("own + row_number() OVER (PARTITION BY c, cls ORDER BY f, token)"))
    return placed.where(f"place <= n - (({percent} * n + 99) div 100) + 1").select("token", "cls", "n", "place")


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """``key, n_shingles, component_id`` of every row of ``docs``.

    A row's set holds its distinct shingles of k lower-cased words, or all words as one shingle
    where there are fewer; rows link when 100 · |A ∩ B| ≥ percent · |A ∪ B|. ``component_id``
    is the smallest key that links reach, the row's own key included.

    Rows with equal sets are one class. Classes that share a prefix shingle under order 0 are
    candidates; the prefixes of the other orders must overlap too, then the sizes of parts of
    the sets must allow the overlap, and the whole sets are compared last. Within the classes
    of one prefix shingle, a star round compares all with one pivot. What still lies in different
    components gets prefixes under one more order, by exact frequency of all shingles among these
    classes: texts that share a frequent passage and have a tenth of their own are no candidates
    any more. (Where a prefix is longer than the ranked part, this order is used at once.) The
    first star round there has the class with the least place as pivot, the middle of a family of
    near copies if it stands in the table. After further star rounds, while these pay, the remaining combinations are listed
    where the places of a common shingle allow the overlap. So no link is lost, and a large group
    of copies costs a row per member and round.

    Null or blank texts have an empty set and stay alone; null keys stay null unless linked;
    repeated rows come back as often as they stand; other columns are ignored; an empty table
    gives an empty one.
    """
    rows, folder = store(signatures(docs, key, text, k, percent), "prefixes")
    filled = rows.where("cls IS NOT NULL")
    owners = filled.groupBy("cls").agg(
        F.min(key).alias("owner"), *[F.first(x).alias(x) for x in ("n", "n_cut", "ranked")]
    )
    owners = stage(owners.withColumn("c", F.xxhash64("cls")), "owners")
    phase = int(not _by_part(percent))
    if phase:
        postings = stage(_rarest(docs, owners, key, text, k, percent), "postings")
    else:
        postings = stage(_postings(filled, owners, percent), "postings").withColumn("place", F.lit(1).cast("long"))
    sketches = filled.select("cls", "n", *_PREFIXES, "bins")
    sketches = sketches.join(postings.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"])
    sketches, sketched = store(sketches, "sketches")
    # only these columns are read from here on
    rows = stage(rows.select(key, "n", "cls"), "members")
    remove(docs.sparkSession, folder)
    near = F.expr(f"least(n_a, n_b) * 100 >= {percent} * greatest(n_a, n_b)")
    links = labels = tried = None
    turn, last, before, spent = 0, False, None, 0
    while not last:
        placed = postings.withColumn("comp", F.col("cls"))
        if labels is not None:
            placed = postings.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
            placed = placed.select("token", "cls", "n", "place", F.coalesce("component", "cls").alias("comp"))
        central = F.col("place") if phase and not spent else F.lit(0)
        groups = placed.groupBy("token").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"),
            F.bit_xor(F.xxhash64("cls")).alias("x1"), F.bit_xor(F.xxhash64("cls", F.lit("x"))).alias("x2"),
            F.min(F.struct(central.alias("i"), F.xxhash64("cls", F.lit(turn)).alias("r"), "cls", "n", "comp")).alias("pivot"),
        ).where("lo <> hi")
        if not phase:
            # shingles with the same classes make the same pairs: one of them is enough
            groups = groups.groupBy("m", "x1", "x2").agg(F.min("token").alias("token"), F.first("pivot").alias("pivot"))
        open_ = stage(placed.join(groups.select("token", "pivot", "m"), "token"), "open")
        size = open_.agg(F.count("*").alias("rows"), F.sum("m").alias("pairs")).first()
        if not size.rows:
            break
        postings = open_.select("token", "cls", "n", "place")
        # every row of a group of m stands for m pairs; star rounds go on while they take a tenth
        # of them away, then the last order takes over, then the rest is listed
        least_, most = LAST_ROUNDS if phase else STAR_ROUNDS
        small = size.pairs <= 4 * size.rows
        pays = before is None or 10 * size.pairs <= 9 * before
        if spent >= most or (spent >= least_ and (small or not pays)):
            if phase == 0 and not small:
                wanted = stage(owners.join(open_.select("cls").distinct(), "cls", "left_semi"), "wanted")
                postings = stage(_rarest(docs, wanted, key, text, k, percent), "postings")
                phase, spent, before = 1, 0, None
                continue
            last = True
        turn, spent, before = turn + 1, spent + 1, size.pairs
        if last:
            sides = {"cls": "", "n": "n_", "comp": "c_", "place": "i_"}
            left = open_.select("token", *[F.col(x).alias(f"{y}a") for x, y in sides.items()])
            right = open_.select("token", *[F.col(x).alias(f"{y}b") for x, y in sides.items()])
            pairs = left.join(right, "token").where("a < b")
            if phase:
                # at the first common shingle, no more can be common than what is left of either
                most_common = F.expr("1 + least(n_a - i_a, n_b - i_b)")
                pairs = pairs.where(most_common * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b")))
        else:
            pairs = open_.select(
                F.col("pivot.cls").alias("a"), F.col("pivot.n").alias("n_a"), F.col("cls").alias("b"),
                F.col("n").alias("n_b"), F.col("pivot.comp").alias("c_a"), F.col("comp").alias("c_b"),
            )
        pairs = pairs.where(near & (F.col("c_a") != F.col("c_b")))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        if pairs.isEmpty():
            continue
        possible = stage(_possible(pairs, sketches, percent), "possible")
        tried = pairs if tried is None else tried.union(pairs)
        if possible.isEmpty():
            continue
        wanted = owners.join(_ends(possible), "cls", "left_semi").select("cls", "owner")
        sets, folders = _whole_sets(docs, stage(wanted, "wanted"), key, text, k)
        found = stage(_verified(possible, sets, percent), "found")
        for folder in folders:
            remove(docs.sparkSession, folder)
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = stage(components(links), "labels")
    remove(docs.sparkSession, sketched)
    named = owners.select("cls", "owner", F.col("cls").alias("component"))
    if labels is not None:
        named = named.drop("component").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        named = named.withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("owner").alias("component_id"))
    ids = named.join(least, "component").select("cls", "component_id")
    out = rows.select(key, F.col("n").alias("n_shingles"), "cls").join(ids, "cls", "left")
    return out.select(key, "n_shingles", F.coalesce("component_id", key).alias("component_id"))


def op10(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf}/documents.parquet"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The query's rows by all pairs that share a shingle and the closure of their links.
ORACLE = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS s FROM words
), sizes AS (
  SELECT w.doc_id, count(s) AS n FROM words w LEFT JOIN shingles USING (doc_id) GROUP BY 1
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(min(b), doc_id)) AS component_id
FROM sizes LEFT JOIN reach ON a = doc_id GROUP BY doc_id, n
"""
