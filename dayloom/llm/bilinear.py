"""Log-bilinear language model, trained with noise-contrastive estimation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import text as T
from dayloom.session import stage


@dataclass(frozen=True)
class Shape:
    """Sizes of the model. Its output units are the end, the most frequent words, and classes of
    all other words by their last letters; within a class words have their smoothed shares."""

    words: int = 831
    classes: int = 192
    width: int = 16
    batch: int = 2048
    noise: int = 48
    rate: float = 0.12
    #: Steps of one task at least; a task with little text goes over it again.
    steps: int = 600
    #: Words whose counts every executor holds; all others are counted and joined.
    sent_words: int = 1 << 17
    seed: int = 20_24

    @property
    def units(self) -> int:
        return 1 + self.words + self.classes


ALPHA = 0.1
END_HASH = -1


class Tokens:
    """The tokens of a slice: hashes (``END_HASH`` for the end of each text), classes by last
    letters, and where each text begins."""

    def __init__(self, part: T.Slice, classes: int):
        hashes = part.word_hashes().view(np.int64)
        n = len(hashes) + part.n
        doc = np.repeat(np.arange(part.n), np.diff(part.words))
        at = np.arange(len(hashes)) + doc
        self.first = part.words[:-1] + np.arange(part.n)
        self.bounds = np.append(self.first, n)
        self.hashes = np.full(n, END_HASH, np.int64)
        self.hashes[at] = hashes
        self.classes = np.zeros(n, np.int64)
        if len(hashes):
            d = part.data.astype(np.uint64)
            code = d[part.ends - 1]
            for k in (2, 3):
                back = part.ends - k
                code = code * np.uint64(257) + np.where(back >= part.starts, d[np.maximum(back, 0)], 0)
            self.classes[at] = (T.mix(code) % np.uint64(classes)).astype(np.int64)

    def contexts(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The units one and two tokens before; the end stands before the beginning."""
        one, two = np.zeros_like(units), np.zeros_like(units)
        one[1:], two[2:] = units[:-1], units[:-2]
        one[self.first] = 0
        two[self.first] = 0
        second = self.first + 1
        two[second[second < self.bounds[1:]]] = 0
        return one, two


def _counts(docs: DataFrame, text: str, shape: Shape) -> DataFrame:
    """``h, cls, n`` of every token of all texts."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            h, c, n = (np.concatenate(x) for x in zip(*held, strict=True))
            unique, at, back = np.unique(h, return_index=True, return_inverse=True)
            return unique, c[at], np.bincount(back, weights=n).astype(np.int64)

        for batch in batches:
            for part in T.slices(batch.column(0)):
                tokens = Tokens(part, shape.classes)
                unique, at, n = np.unique(tokens.hashes, return_index=True, return_counts=True)
                held.append((unique, tokens.classes[at], n))
                size += len(unique)
                if size > 1_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 700_000:
                        yield _count_rows(*held[0])
                        held, size = [], 0
        if held:
            yield _count_rows(*merged())

    rows = docs.select(text).mapInArrow(count, "h long, cls int, n long")
    return rows.groupBy("h").agg(F.first("cls").alias("cls"), F.sum("n").alias("n"))


def _count_rows(h, c, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c.astype(np.int32)), pa.array(n)], ["h", "cls", "n"])


class Lexicon:
    """Counts of the most frequent words, and the unit of every token; plain arrays in ``state``."""

    def __init__(self, state: dict):
        self.__dict__.update(state)

    def lookup(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Count (-1 if not among the words held) and unit of every token."""
        at = np.minimum(np.searchsorted(self.hashes, tokens.hashes), len(self.hashes) - 1)
        held = self.hashes[at] == tokens.hashes
        counts = np.where(held, self.counts[at], -1)
        unit = np.where(held, self.units[at], -1)
        return counts, np.where(unit >= 0, unit, self.first_class + tokens.classes)


def lexicon(counts: DataFrame, shape: Shape) -> dict:
    """The lexicon's state from the table of counts, and the totals over it."""
    by_class = counts.where(F.col("h") != END_HASH).groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    class_rows = by_class.collect()
    ends = counts.where(F.col("h") == END_HASH).agg(F.sum("n")).first()[0] or 0
    # the count from which words are held: their number is bounded by sent_words
    steps = counts.groupBy("n").agg(F.count("*").alias("m")).orderBy(F.desc("n"))
    least, seen = None, 0
    for r in steps.limit(shape.sent_words).collect():
        if seen + r.m > shape.sent_words:
            break
        least, seen = r.n, seen + r.m
    top = counts.where(F.col("n") >= (least if least is not None else 1 << 62)).toPandas()
    top = top[top["h"] != END_HASH].sort_values(["n", "h"], ascending=[False, True])
    n_class, v_class, own = np.zeros(shape.classes), np.zeros(shape.classes), np.zeros(shape.units)
    for r in class_rows:
        n_class[r.cls], v_class[r.cls] = r.n, r.v
    units = np.full(len(top), -1, np.int64)
    units[: shape.words] = 1 + np.arange(min(len(top), shape.words))
    h, c, cls = top["h"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["cls"].to_numpy(np.int64)
    single = units >= 0
    own[0] = ends
    own[units[single]] = c[single]
    total, distinct = int(n_class.sum() + ends), int(v_class.sum() + (ends > 0))
    np.subtract.at(n_class, cls[single], c[single])
    np.subtract.at(v_class, cls[single], 1)
    own[1 + shape.words :] = n_class
    h, c, units = np.append(h, END_HASH), np.append(c, ends), np.append(units, 0)
    order = np.argsort(h)
    return {
        "hashes": h[order], "counts": c[order], "units": units[order], "first_class": 1 + shape.words,
        "total": total, "distinct": distinct, "unit_counts": own,
        "class_log": np.log10(n_class + ALPHA * (v_class + 1)),
    }


def initial(unit_counts: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(shape.seed)
    k, d = shape.units, shape.width
    p = (unit_counts + 1) / (unit_counts + 1).sum()
    return {
        "context": rng.normal(0, 0.3, (k, d)).astype(np.float32),
        "target": rng.normal(0, 0.1, (k, d)).astype(np.float32),
        "near": np.ones(d, np.float32), "far": np.full(d, 0.7, np.float32),
        "bias": np.log(p).astype(np.float32),
    }


def _gather(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows with equal index."""
    order = np.argsort(at, kind="stable")
    sorted_ = at[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(sorted_)) + 1])
    return sorted_[cuts], np.add.reduceat(values[order], cuts, axis=0)


class Trainer:
    """Noise-contrastive steps with Adagrad. A batch shares its noise units, drawn from the
    units' shares in the training text."""

    def __init__(self, params: dict[str, np.ndarray], shape: Shape, seed: int):
        self.p, self.shape = {k: v.copy() for k, v in params.items()}, shape
        self.squares = {k: np.full(v.shape, 1e-6, np.float32) for k, v in params.items()}
        self.rng = np.random.default_rng(seed)
        share = np.exp(params["bias"].astype(float))
        self.share = share / share.sum()
        self.cumulated = np.cumsum(self.share)
        self.log_noise = np.log(shape.noise * self.share).astype(np.float32)

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        g = gradient / np.float32(self.shape.batch)
        self.squares[name][at] += g * g
        self.p[name][at] -= self.shape.rate * g / np.sqrt(self.squares[name][at])

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        p = self.p
        x1, x2 = p["context"][one], p["context"][two]
        q = x1 * p["near"] + x2 * p["far"]
        noise = np.searchsorted(self.cumulated, self.rng.random(self.shape.noise))
        noise = np.minimum(noise, len(self.share) - 1)
        rw, rn = p["target"][word], p["target"][noise]
        own = (q * rw).sum(1) + p["bias"][word] - self.log_noise[word]
        other = q @ rn.T + p["bias"][noise] - self.log_noise[noise]
        g_own = (1 / (1 + np.exp(-np.clip(own, -30, 30))) - 1).astype(np.float32)
        g_other = (1 / (1 + np.exp(-np.clip(other, -30, 30)))).astype(np.float32)
        dq = g_own[:, None] * rw + g_other @ rn
        at = np.concatenate([word, noise])
        width = self.shape.width
        d_target = np.zeros((len(at), width + 1), np.float32)
        d_target[: len(word), :width], d_target[: len(word), width] = g_own[:, None] * q, g_own
        d_target[len(word) :, :width], d_target[len(word) :, width] = g_other.T @ q, g_other.sum(0)
        near, far = (dq * x1).sum(0), (dq * x2).sum(0)
        rows, sums = _gather(at, d_target)
        self._move("target", rows, sums[:, :width])
        self._move("bias", rows, sums[:, width])
        rows, sums = _gather(np.concatenate([one, two]), np.concatenate([dq * p["near"], dq * p["far"]]))
        self._move("context", rows, sums)
        self._move("near", slice(None), near)
        self._move("far", slice(None), far)


def train(docs: DataFrame, text: str, state: dict, shape: Shape) -> dict[str, np.ndarray]:
    """Every task trains from the same start on all its texts; the parameters are averaged with
    the tokens as weights, as sums in Spark."""
    start = initial(state["unit_counts"], shape)
    sent = docs.sparkSession.sparkContext.broadcast((state, start))
    flat = _flat(start)

    def learn(batches):
        lexicon_, trainer, seen, held = Lexicon(sent.value[0]), Trainer(sent.value[1], shape, shape.seed), 0, []
        size = 0
        early: list = []
        for batch in batches:
            for part in T.slices(batch.column(0)):
                tokens = Tokens(part, shape.classes)
                units = lexicon_.lookup(tokens)[1]
                one, two = tokens.contexts(units)
                held.append(np.stack([one, two, units]))
                size += len(units)
                seen += len(units)
                if seen <= shape.steps * shape.batch:
                    early.append(held[-1])
                if size >= 1 << 18:
                    _steps(trainer, held, shape)
                    held, size = [], 0
        if held:
            _steps(trainer, held, shape)
        while early and seen and seen < shape.steps * shape.batch:
            # little text: over it again
            _steps(trainer, early, shape)
            seen += sum(e.shape[1] for e in early)
        if seen:
            values = _flat(trainer.p).astype(float) * seen
            at = np.arange(len(values) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(values, float(seen)))], ["i", "v"])

    sums = docs.select(text).mapInArrow(learn, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    table = sums.toPandas().sort_values("i")["v"].to_numpy()
    if not len(table):
        return start
    return _shaped((table[:-1] / table[-1]).astype(np.float32), start) if len(flat) == len(table) - 1 else start


def _steps(trainer: Trainer, held: list[np.ndarray], shape: Shape) -> None:
    rows = np.concatenate(held, axis=1)
    order = trainer.rng.permutation(rows.shape[1])
    for lo in range(0, len(order), shape.batch):
        trainer.step(*rows[:, order[lo : lo + shape.batch]])


def _flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def tables(params: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log weights of a unit after one near and one far context unit, and the log of their sum
    over all units for every pair of contexts: three matrix products, since the exponential of
    the score is a product of the two sides."""
    target = params["target"].T
    near = (params["context"] * params["near"]) @ target + params["bias"]
    far = (params["context"] * params["far"]) @ target
    a, b = near.max(1, keepdims=True), far.max(1, keepdims=True)
    total = np.exp(near - a) @ np.exp(far - b).T
    return near, far, (np.log(total) + a + b.T).astype(np.float32)


def bilinear_scores(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", shape: Shape = Shape()
) -> DataFrame:
    """``key, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are lower-cased words and one end per text. The model learns from the rows for which
    ``learn`` holds: all their tokens are counted, and each task trains on all its texts. The
    probability of a token is that of its unit, normalised over all units, after the two tokens
    before, times the word's share in its class for words that are no unit. ``score`` is the
    sum of log10 probabilities; ``base_score`` the same from smoothed counts alone. Counts of
    words beyond the most frequent come from a join on their hash.

    A null text is an empty one: its end is scored. Without learning rows all counts are 0.
    Repeated rows score alike, null keys stay null, other columns are ignored, an empty table
    gives an empty one.
    """
    spark = docs.sparkSession
    training = docs.where(F.coalesce(learn, F.lit(False))).select(text)
    counts = stage(_counts(training, text, shape), "counts")
    state = lexicon(counts, shape)
    params = train(training, text, state, shape)
    sent = spark.sparkContext.broadcast((state, *tables(params)))

    def score(batches):
        state_, near, far, total = sent.value
        lex = Lexicon(state_)
        bias10 = np.log(10.0)
        for batch in batches:
            rows: list[list] = [[] for _ in range(5)]
            for part in T.slices(batch.column(1)):
                tokens = Tokens(part, shape.classes)
                counts_, units = lex.lookup(tokens)
                one, two = tokens.contexts(units)
                model = (near[one, units] + far[two, units] - total[one, two]).astype(float) / bias10
                rare = units >= lex.first_class
                held = counts_ >= 0
                logs = np.where(held, np.log10(np.maximum(counts_, 0) + ALPHA), 0.0)
                model += np.where(rare, logs - lex.class_log[np.maximum(units - lex.first_class, 0)], 0.0)
                b = tokens.bounds
                rows[0].append(np.diff(b))
                rows[1].append(np.add.reduceat((counts_ > 0).astype(np.int64), b[:-1]))
                rows[2].append(np.add.reduceat(logs, b[:-1]))
                rows[3].append(np.add.reduceat(model, b[:-1]))
                away = np.flatnonzero(~held)
                cuts = np.searchsorted(away, b)
                rows[4].extend(tokens.hashes[away[x:y]] for x, y in zip(cuts[:-1], cuts[1:], strict=True))
            flat = [np.concatenate(r) if r else np.empty(0, k) for r, k in zip(rows[:4], (int, int, float, float), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x) for x in flat), T.list_array(rows[4])],
                [key, "n_tokens", "known", "logs", "model", "away"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, known long, logs double, model double, away array<long>"
    scored = docs.select(key, text).mapInArrow(score, schema).withColumn("place", F.monotonically_increasing_id())
    scored = stage(scored, "scored")
    away = scored.select("place", F.explode("away").alias("h")).join(counts.select("h", "n"), "h", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + F.lit(ALPHA))
    away = away.groupBy("place").agg(F.sum(log).alias("more"), F.count("n").alias("also"))
    out = scored.drop("away").join(away, "place", "left").na.fill(0, ["more", "also"])
    base = float(np.log10(state["total"] + ALPHA * (state["distinct"] + 1)))
    return out.select(
        key, "n_tokens", (F.col("known") + F.col("also")).alias("n_known"),
        F.lit(state["total"]).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model") + F.col("more")).alias("score"),
    )


def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    out = bilinear_scores(docs, ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
