"""Conversation prefix trie, rolled up by centroid decomposition.

A node stands for all conversations that begin with the same turns. It is known by its depth and an
exclusive-or of its turns' salted hashes (128 bits), so a conversation's nodes are running values
and the parent's key is its child's without the last turn. A node is named by its smallest member
and its depth.

Sums over subtrees go by centroid decomposition of the parent edges. A node weighs as many as its
members; the weight of a whole subtree is what is left of its members' turns, which one
aggregation gives. The centroid of a component is its deepest node with more than half of the
weight. What lies in the component at and under the centroid is added up and given to the centroid
and all nodes on its way to the top; then the centroid goes, its children become tops of components
of their own, and the way to the top loses the centroid's weight. Every round halves the heaviest
component. Components up to ``LOCAL_WEIGHT`` go to one task each, which finishes the same rounds on
arrays; heavier ones are split by joins and aggregates over all of them together.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayloom.session import stage

#: Heaviest component that one task finishes; it has at most so many nodes.
LOCAL_WEIGHT = 1 << 17
#: Turns of one conversation that are numbered in one task.
BLOCK = 1024
_KEY = ["depth", "p1", "p2"]


def _running(df: DataFrame, part: str, block: Column, order: list[Column], values: dict[str, tuple]) -> DataFrame:
    """Adds running values along ``part``, in order of block and order, without all rows of a part
    in one task: within a block first, then from block totals. ``values``: name -> (aggregate,
    column, combination of two values, value of nothing)."""
    df = stage(df.withColumn("block", block), "trie-rows")
    inner = Window.partitionBy(part, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(part).orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(part, "block").agg(*[agg(c).alias(n) for n, (agg, c, _, _) in values.items()])
    before = totals.select(
        F.col(part).alias("b_part"), F.col("block").alias("b_block"),
        *[F.coalesce(agg(n).over(outer), F.lit(zero)).alias(f"b_{n}") for n, (agg, _, _, zero) in values.items()],
    )
    df = df.withColumns({n: agg(c).over(inner) for n, (agg, c, _, _) in values.items()})
    df = df.join(before, (df[part] == before["b_part"]) & df["block"].eqNullSafe(before["b_block"]))
    df = df.withColumns({n: both(F.col(n), F.col(f"b_{n}")) for n, (_, _, both, _) in values.items()})
    return df.drop("block", "b_part", "b_block", *[f"b_{n}" for n in values])


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: ``conv_id, depth, total, size, s1, s2`` of every turn, and
    ``conv_id, total`` of every conversation, turnless ones included.

    A conversation begins with the first ``crc32(conv_id) % 9`` turns of the one whose id is the
    next lower multiple of five (towards zero) and goes on with its own later turns. Turns are in
    order of turn (null first); equal turn numbers by role, then by the MD5 of the text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), F.md5(text).alias("digest"),
        F.octet_length(text).cast("long").alias("size"), F.xxhash64(role, text).alias("g1"),
        F.xxhash64(F.lit("turn"), text, role).alias("g2"),
    )
    turns = _running(
        turns, "conv_id", F.floor(F.col("turn") / BLOCK), [F.asc_nulls_first("turn"), F.col("role"), F.col("digest")],
        {"pos": (F.sum, F.lit(1), _plus, 0)},
    )
    turns = stage(turns.select("conv_id", "pos", "size", "g1", "g2"), "trie-turns")
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = convs.withColumn("head", F.crc32(F.col("conv_id").cast("string")) % 9)
    convs = stage(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5), "trie-convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_own", F.lit(0))))
    total = F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    convs = stage(convs.select("conv_id", "head", "base", "taken", total.alias("total")), "trie-lengths")
    own = turns.join(convs, "conv_id").where("pos > head").withColumn("depth", F.expr("taken + pos - head"))
    first = turns.where("pos <= 8 AND conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    lent = first.join(convs, "base").where("pos <= taken").withColumn("depth", F.col("pos"))
    columns = ["conv_id", "depth", "total", "size", "g1", "g2"]
    rows = own.select(*columns).union(lent.select(*columns))
    rows = rows.withColumns({"s1": F.xxhash64("depth", "g1"), "s2": F.xxhash64("g2", "depth")}).drop("g1", "g2")
    return rows, convs.select("conv_id", "total")


def ends_digests(ends: DataFrame) -> DataFrame:
    """``depth, p1, p2, ends_sha256``: the digest of the members that end at a node.

    A SHA-256 is sequential, so the ids of one node pass through one task; they do so as a sorted
    stream of three numbers and an id a row, with memory of one batch.
    """

    def digest(batches):
        now, state = None, None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            ids = batch.column(3).to_pylist()
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            done = []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                if lo == hi:
                    continue
                key = tuple(keys[:, lo].tolist())
                text = ",".join(map(str, ids[lo:hi])).encode()
                if key == now:
                    state.update(b"," + text)
                else:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(text)
            yield _digest_rows(done)
        if now is not None:
            yield _digest_rows([(*now, state.hexdigest())])

    ends = ends.select(*_KEY, "conv_id").repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id")
    return ends.mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [*_KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """One row per node of the rebuilt conversations' trie: ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Null roles and texts are empty, null turns come first, and equal turn numbers are ordered by
    role and text digest, so repeated rows are turns of their own. Rows without a conv_id belong to
    no conversation. A conversation without turns is a member of the root. An empty table has no
    node, not even a root. Other columns are ignored.
    """
    rows, convs = rebuilt_turns(conversations)
    rows = _running(
        rows, "conv_id", F.floor((F.col("depth") - 1) / BLOCK), [F.col("depth")],
        {n: (F.bit_xor, F.col(s), _xor, 0) for n, s in (("p1", "s1"), ("p2", "s2"))},
    )
    rows = stage(rows, "trie-paths")
    nodes = rows.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("size").alias("size"),
        F.sum(F.col("total") - F.col("depth") + 1).alias("w"),
        F.min(_xor(F.col("p1"), F.col("s1"))).alias("q1"), F.min(_xor(F.col("p2"), F.col("s2"))).alias("q2"),
    )
    root = convs.agg(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("size"),
        F.sum(F.col("total") + 1).alias("w"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"),
    ).where("n_convs > 0")
    nodes = stage(nodes.union(root), "trie-nodes")

    up = F.col("depth") - 1
    children = nodes.where("depth > 0").groupBy(up.alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                           F.col("conv_id").alias("parent_conv_id"))
    none = F.col("conv_id").isNull()
    ends = rows.where("depth = total").select(*_KEY, "conv_id").union(
        convs.where("total = 0").select(*[F.lit(0).cast("long").alias(k) for k in _KEY], "conv_id")
    ).where(~none)
    trie = (
        nodes.join(children.agg(F.count("*").alias("n_children")), _KEY, "left")
        .join(parents, ["depth", "q1", "q2"], "left")
        .join(ends_digests(ends), _KEY, "left")
        .withColumns({
            "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
            "leaf": F.col("n_children").isNull().cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("size"),
        })
    )
    first = nodes.where("depth = 0").select("conv_id").first()  # the root, or none of an empty table
    tops = {"top_conv": F.lit(first and first.conv_id).cast("long"), "top_depth": F.lit(0).cast("long")}
    trie = stage(trie.drop("q1", "q2", "size").withColumns(tops), "trie")
    # ways through nodes of other conversations: who owns a node and its parent
    owners = trie.select(*_KEY, F.col("conv_id").alias("owner"), F.col("parent_conv_id").alias("above"))
    paths = rows.select("conv_id", *_KEY).join(owners, _KEY).where("above <> conv_id")
    return centroid_sums(trie.drop("p1", "p2"), paths.select("conv_id", "depth", "owner", "above"), local_weight).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def centroid_sums(trie: DataFrame, paths: DataFrame, local_weight: int) -> DataFrame:
    """Adds ``n_leaves`` and ``saved_tokens``, the sums of ``leaf`` and ``saved`` over subtrees.

    ``trie``: ``conv_id, depth, parent_conv_id, w`` (weight of the subtree), ``top_conv, top_depth``
    (the top of its tree) and the values. A node's way up is that of its conversation; ``paths`` has the places of a conversation whose parent
    node belongs to another one: ``conv_id, depth, owner, above`` (owners of node and parent).
    """
    top = ["top_conv", "top_depth"]
    state = trie.withColumns({c: F.lit(0).cast("long") for c in ("n_leaves", "saved_tokens")})
    finished, small = [], []
    columns = state.columns
    while True:
        totals = stage(state.groupBy(*top).agg(F.max("w").alias("weight")), "trie-components")
        light = state.join(totals.where(F.col("weight") <= local_weight), top).select(*columns)
        small.append(light)
        heavy = totals.where(F.col("weight") > local_weight)
        if heavy.isEmpty():
            break
        if not finished:
            paths = stage(paths, "trie-ways")
        state = stage(state.join(heavy, top), "trie-heavy")
        found = state.where("2 * w > weight").groupBy(*top).agg(
            F.max_by(F.struct("conv_id", "depth", "w"), "depth").alias("x")
        ).select(*top, F.col("x.conv_id").alias("x_conv"), F.col("x.depth").alias("x_depth"), F.col("x.w").alias("x_w"))
        found = stage(found, "trie-centroids")
        way = found.join(paths.select(F.col("conv_id").alias("x_conv"), F.col("depth").alias("at"), "above"), "x_conv")
        way = way.where("at <= x_depth AND at > top_depth").select(
            F.col("above").alias("conv_id"), (F.col("at") - 1).alias("depth"), F.lit(True).alias("on_way")
        )
        under = paths.select("conv_id", (F.col("depth") - 1).alias("x_depth"), "owner", "above")
        marked = state.join(found, top).join(way, ["conv_id", "depth"], "left").join(under, ["conv_id", "x_depth"], "left")
        same = F.col("conv_id") == F.col("x_conv")
        below = (F.col("depth") > F.col("x_depth")) & (F.coalesce("above", "conv_id") == F.col("x_conv"))
        place = (
            F.when(same & (F.col("depth") == F.col("x_depth")), "centroid").when(below, "below")
            .when((F.col("depth") < F.col("x_depth")) & (same | F.col("on_way").isNotNull()), "way").otherwise("aside")
        )
        marked = stage(marked.withColumn("place", place), "trie-marked")
        sums = marked.where("place IN ('centroid', 'below')").groupBy(*top).agg(
            F.sum("leaf").alias("d_leaves"), F.sum("saved").alias("d_saved")
        )
        gains = F.col("place").isin("centroid", "way")
        after = marked.join(sums, top).withColumns({
            "n_leaves": F.col("n_leaves") + F.when(gains, F.col("d_leaves")).otherwise(0),
            "saved_tokens": F.col("saved_tokens") + F.when(gains, F.col("d_saved")).otherwise(0),
            "w": F.col("w") - F.when(F.col("place") == "way", F.col("x_w")).otherwise(0),
            "top_conv": F.when(F.col("place") == "below", F.coalesce("owner", "conv_id")).otherwise(F.col("top_conv")),
            "top_depth": F.when(F.col("place") == "below", F.col("x_depth") + 1).otherwise(F.col("top_depth")),
        })
        after = stage(after.select(*columns, "place"), "trie-round")
        finished.append(after.where("place = 'centroid'").select(*columns))
        state = after.where("place <> 'centroid'").select(*columns)
    rest = reduce(DataFrame.union, small)
    rest = rest.repartition(*top).sortWithinPartitions(*top, "depth").mapInArrow(_finish, rest.schema)
    return reduce(DataFrame.union, finished, rest)


def _finish(batches):
    """Components that stand one behind the other, whole components at a time."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= 1 << 16:
            table = pa.Table.from_batches(held)
            tops = np.stack([table.column(c).to_numpy() for c in ("top_conv", "top_depth")])
            cut = int(np.flatnonzero((tops != tops[:, -1:]).any(0))[-1:].sum() + 1) if (tops != tops[:, -1:]).any() else 0
            if cut:
                yield from _summed(table.slice(0, cut)).to_batches()
            held = table.slice(cut).to_batches()
            n -= cut
    if held:
        yield from _summed(pa.Table.from_batches(held)).to_batches()


def _summed(table: pa.Table) -> pa.Table:
    get = lambda c: table.column(c).to_numpy()
    conv, depth, tops = get("conv_id"), get("depth"), np.stack([get("top_conv"), get("top_depth")])
    # a parent's place among the rows, -1 for the top of a component
    above = table.column("parent_conv_id").fill_null(0).to_numpy()
    names, code = np.unique(np.concatenate([conv, above]), return_inverse=True)
    wide = int(depth.max(initial=0)) + 2
    own, up = code[: len(conv)] * wide + depth, code[len(conv) :] * wide + depth - 1
    order = np.argsort(own)
    at = np.minimum(np.searchsorted(own[order], up), len(own) - 1)
    parent = np.where(own[order][at] == up, order[at], -1)
    parent[(conv == tops[0]) & (depth == tops[1])] = -1
    values = np.stack([get("leaf"), get("saved")], 1)
    sums = component_sums(parent, depth, get("w"), values)
    for i, name in enumerate(("n_leaves", "saved_tokens")):
        k = table.column_names.index(name)
        table = table.set_column(k, table.schema.field(k), pa.array(get(name) + sums[:, i]))
    return table


def component_sums(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values over every node's subtree in a forest, all components a round at a time.

    ``parent`` is -1 at tops; ``weight`` is that of whole subtrees and falls from parent to child.
    """
    order, end, parent = _preorder(parent, depth)
    n = len(order)
    w, values = weight[order].copy(), values[order]
    tops = np.flatnonzero(parent < 0)
    comp = tops[np.searchsorted(tops, np.arange(n), side="right") - 1] if n else tops
    sums = np.zeros_like(values)
    chosen = np.zeros(n, np.int64)
    v = np.arange(n)
    while len(v):
        heavy = v[2 * w[v] > w[comp[v]]]
        chosen[comp[heavy]] = heavy  # the last one of each component in preorder, thus the deepest
        x = chosen[comp[v]]
        under = (v >= x) & (v < end[x])
        total = np.zeros_like(sums)
        np.add.at(total, x[under], values[v[under]])
        way = (v <= x) & (x < end[v])
        sums[v[way]] += total[x[way]]
        less = way & (v != x)
        w_x = w[x]
        child = v[parent[v] == x]
        keys = chosen[comp[child]] * n + child
        sort = np.argsort(keys)
        below = under & (v != x)
        found = np.searchsorted(keys[sort], x[below] * n + v[below], side="right") - 1
        w[v[less]] -= w_x[less]
        comp[v[below]] = child[sort][found]
        v = v[v != x]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _preorder(parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes in preorder, where each one's subtree ends, and parents, both as places in that order."""
    n = len(parent)
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    layers = np.split(by_depth, cuts) if n else []
    size = np.ones(n, np.int64)
    for layer in reversed(layers):
        inner = layer[parent[layer] >= 0]
        np.add.at(size, parent[inner], size[inner])
    place = np.zeros(n, np.int64)
    tops = np.flatnonzero(parent < 0)
    place[tops] = np.cumsum(size[tops]) - size[tops]
    for layer in layers:
        inner = layer[parent[layer] >= 0]
        if not len(inner):
            continue
        inner = inner[np.argsort(parent[inner], kind="stable")]
        before = np.cumsum(size[inner]) - size[inner]
        first = np.concatenate([[True], parent[inner][1:] != parent[inner][:-1]])
        before -= before[first][np.cumsum(first) - 1]
        place[inner] = place[parent[inner]] + 1 + before
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    end = np.empty(n, np.int64)
    end[place] = place + size
    up = np.full(n, -1)
    up[place] = np.where(parent >= 0, place[np.maximum(parent, 0)], -1)
    return order, end, up


def op11(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


ORACLE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))
         ) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, max(pos) AS own, conv_id - conv_id % 5 AS base,
         -- unsigned crc32 of the decimal id, bit by bit
         xor(list_reduce(
            list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN regexp_extract_all(conv_id::VARCHAR, '.')]),
            lambda c, x: list_reduce(
              list_prepend(xor(c, x), range(8)),
              lambda y, i: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384 ELSE 0 END))
          ), 4294967295) % 9 AS head
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, t.pos AS depth, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.head
  UNION ALL
  SELECT c.conv_id, least(c.head, coalesce(b.own, 0)) + t.pos - c.head, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.head LEFT JOIN convs b ON b.conv_id = c.base
), hashed AS (
  SELECT conv_id, depth, strlen(text) AS size, md5(length(role)::VARCHAR || ':' || role || text) AS turn FROM rebuilt
), lists AS (
  SELECT c.conv_id, coalesce(list(h.turn ORDER BY h.depth) FILTER (WHERE h.turn IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN hashed h USING (conv_id) GROUP BY c.conv_id
), steps AS (
  SELECT conv_id, unnest(range(0, len(path) + 1)) AS depth, path FROM lists
), ways AS (
  SELECT s.conv_id, s.depth, len(s.path) AS total, coalesce(h.size, 0) AS size,
         md5(array_to_string(s.path[1:s.depth], ',')) AS node,
         md5(array_to_string(s.path[1:s.depth - 1], ',')) AS parent
  FROM steps s LEFT JOIN hashed h ON h.conv_id = s.conv_id AND h.depth = s.depth
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs,
         (count(*) - 1) * max(size) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = total), '')) AS ends
  FROM ways GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c USING (depth, node)
  LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.parent
), sums AS (
  SELECT w.depth, w.node, sum((n.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
  FROM full_nodes n JOIN ways w ON w.conv_id = n.conv_id AND w.depth <= n.depth
  GROUP BY w.depth, w.node
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums s USING (depth, node)
"""
