"""Language-model scores from a log-bilinear neural model trained in numpy by noise-contrastive estimation.

The model predicts the class of the next token from the classes of the ``ORDER`` tokens before it:
``s(w, h) = (sum_i C_i r_(h_i)) . q_w + b_w``, normalised over all classes by one matrix product per batch.  The ``TOP`` most frequent tokens and the
end of a text are classes of their own; all other tokens fall into ``ENDINGS`` classes by their last bytes, and a token has its
smoothed share of its class, so that the probabilities of all tokens add up to one.  An unknown token has the share of one
unseen token of its class.

* Counts cover all training texts; they are summed per task first and then by Spark.
* Training takes every training token in every round.  Texts are dealt by their hash to units of about ``UNIT`` tokens, and units to steps and
  lanes, about as many of the one as of the other.  All lanes of a step start from the average of the step before (parameters and squared gradients,
  weighted by tokens), so the steps that build on each other grow with the corpus and do not depend on how its files are laid out.
* Scoring covers all texts.  The counts of up to ``LISTED`` tokens are sent to the tasks (all that occur at least as often as a threshold taken from the
  histogram of counts); the counts of rarer ones come by a join on the token's hash, added up per row.

Null and empty texts are the end alone.  Rows are scored one by one, so repeated and null ids are fine.  Without training texts all tokens are
unknown, and score and base are those of an empty count.  Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .flat import flatten, lower_ascii, mix, range_hashes, range_sums, slices, text_bytes, words

ORDER, WIDTH = 3, 16
TOP, ENDINGS = 384, 127
LISTED = 1 << 20
ROUNDS, BATCH, NOISE, RATE = 2, 1024, 32, 0.08
UNIT = 1 << 18
SMOOTH = 0.1
END = TOP + ENDINGS
CLASSES = END + 1
START = CLASSES
#: The end of a text as a token.
END_HASH = np.uint64(0xE4D)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, class of its ending, first word of every text and the end)."""
    flat = flatten(texts)
    buf = lower_ascii(flat.buf)
    flat.buf = buf
    begin, stop, first = words(flat)
    tail = np.maximum(begin, stop - 3)
    total = range_sums(buf)
    ending = mix(range_hashes(buf, tail, stop, total)) % np.uint64(ENDINGS)
    return range_hashes(buf, begin, stop, total), ending.astype(np.int64), first


# ---- counts -------------------------------------------------------------------------------------------------------


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    token, ending, count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(count)], ["token", "ending", "n"])

    for rows in slices(batches):
        h, e, first = tokens(text_bytes(rows.column(1)))
        h = np.concatenate((token, h, [END_HASH]))
        e = np.concatenate((ending, e, [-1]))
        n = np.concatenate((count, np.ones(len(h) - len(count) - 1, np.int64), [len(first) - 1]))
        token, at, code = np.unique(h, return_index=True, return_inverse=True)
        ending, count = e[at], np.bincount(code, n, minlength=len(token)).astype(np.int64)
        if len(token) > 1_000_000:
            yield out()
            token, ending, count = token[:0], ending[:0], count[:0]
    yield out()


@dataclass
class Vocabulary:
    """What tasks need of the counts."""

    total: int
    distinct: int
    threshold: int
    listed: np.ndarray  # sorted hashes of the tokens with at least ``threshold`` occurrences
    listed_count: np.ndarray
    top: np.ndarray  # sorted hashes of the tokens with a class of their own
    top_class: np.ndarray
    class_count: np.ndarray
    share_total: np.ndarray  # smoothed total of each ending class

    def counts_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, whether it is listed)."""
        return _lookup(self.listed, self.listed_count, h)

    def classes_of(self, h: np.ndarray, ending: np.ndarray) -> np.ndarray:
        own, found = _lookup(self.top, self.top_class, h)
        return np.where(found, own, TOP + ending)


def _lookup(names: np.ndarray, values: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(names):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.searchsorted(names, h)
    at[at == len(names)] = 0
    found = names[at] == h
    return np.where(found, values[at], 0), found


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # Numbers of tokens by count: the threshold is the lowest that keeps the list within its bound.
    shape = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("tokens")).collect()
    threshold, size = 100_001, 0
    for r in sorted(shape, key=lambda r: -r.n):
        size += r.tokens
        if size > LISTED:
            break
        threshold = r.n
    listed = counts.filter(F.col("n") >= threshold).select("token", "n").toArrow()
    h, n = np.asarray(listed["token"]).view(np.uint64), np.asarray(listed["n"])
    order = np.argsort(h)
    h, n = h[order], n[order]
    best = counts.filter(F.col("ending") >= 0).orderBy(F.desc("n"), "token").limit(TOP).select("token", "n").collect()
    top = np.array([r.token for r in best], np.int64).view(np.uint64)
    class_count = np.zeros(CLASSES)
    class_count[: len(best)] = [r.n for r in best]
    share_total = np.full(ENDINGS, SMOOTH)
    rare = counts.filter(F.col("ending") >= 0).join(F.broadcast(counts.sparkSession.createDataFrame([(r.token,) for r in best], "token long")), "token", "left_anti")
    for r in rare.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("tokens")).collect():
        class_count[TOP + r.ending] = r.n
        share_total[r.ending] = r.n + SMOOTH * (r.tokens + 1)
    class_count[END] = sum(r.n for r in counts.filter(F.col("ending") < 0).collect())
    order = np.argsort(top)
    return Vocabulary(total, distinct, threshold, h, n, top[order], order, class_count, share_total)


# ---- model --------------------------------------------------------------------------------------------------------


@dataclass
class Parameters:
    context: np.ndarray  # classes and the start, by WIDTH
    target: np.ndarray
    mixers: np.ndarray  # ORDER x WIDTH x WIDTH
    bias: np.ndarray

    @classmethod
    def initial(cls, class_count: np.ndarray) -> Parameters:
        r = np.random.default_rng(5)
        share = (class_count + 1) / (class_count.sum() + CLASSES)
        small = lambda *shape: r.normal(0, 0.1, shape).astype(np.float32)
        mixers = np.repeat(np.eye(WIDTH, dtype=np.float32)[None] / ORDER, ORDER, 0)
        return cls(small(CLASSES + 1, WIDTH), small(CLASSES, WIDTH), mixers, np.log(share).astype(np.float32))

    def unmoved(self) -> Parameters:
        """Squared gradients before the first step."""
        return Parameters(*(np.full(x.shape, 0.05, np.float32) for x in self.parts()))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.mixers, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, values: np.ndarray) -> Parameters:
        edge = np.cumsum([p.size for p in self.parts()])[:-1]
        return Parameters(*(v.reshape(p.shape).astype(np.float32) for v, p in zip(np.split(values, edge), self.parts())))


def sequences(cls: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(targets, contexts) of texts of classes: each text ends with the end, and begins after ``ORDER`` starts."""
    n = np.diff(first)
    size = n + 1 + ORDER
    begin = np.cumsum(size) - size
    line = np.full(int(size.sum()), START, np.int64)
    text = np.repeat(np.arange(len(n)), n)
    line[np.arange(len(cls)) - first[:-1][text] + begin[text] + ORDER] = cls
    line[begin + size - 1] = END
    place = np.arange(len(line))
    keep = np.ones(len(line), bool)
    for i in range(ORDER):
        keep[begin + i] = False
    at = place[keep]
    return line[at], np.column_stack([line[at - i - 1] for i in range(ORDER)])


def _grouped(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by index, for all indexes below ``n``."""
    width = rows.shape[1]
    cell = (index * width)[:, None] + np.arange(width)
    return np.bincount(cell.ravel(), rows.ravel(), n * width).astype(np.float32).reshape(n, width)


class Trainer:
    """Noise-contrastive estimation with adaptive steps; the noise of a batch is shared by its tokens."""

    def __init__(self, p: Parameters, class_count: np.ndarray, seed: int | list[int], past: Parameters | None = None):
        self.p = Parameters(*(x.copy() for x in p.parts()))
        self.past = [x.copy() for x in (past or p.unmoved()).parts()]
        self.random = np.random.default_rng(seed)
        share = (class_count + 1) / (class_count.sum() + CLASSES)
        self.cumulative = np.cumsum(share)
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.seen = 0

    def step(self, part: int, gradient: np.ndarray) -> None:
        """Classes without a gradient stay as they are."""
        past, value = self.past[part], self.p.parts()[part]
        past += gradient * gradient
        value += RATE * gradient / np.sqrt(past)

    def train(self, target: np.ndarray, context: np.ndarray) -> None:
        order = self.random.permutation(len(target))
        target, context = target[order], np.ascontiguousarray(context[order].T)
        for i in range(0, len(order), BATCH):
            self.batch(target[i : i + BATCH], context[:, i : i + BATCH])
        self.seen += len(target)

    def batch(self, w: np.ndarray, h: np.ndarray) -> None:
        """Learn from the targets ``w``; row i of ``h`` are the classes i + 1 places before them."""
        p, n = self.p, len(w)
        vectors = [p.context.take(x, 0) for x in h]
        q = vectors[0] @ p.mixers[0]
        for v, c in zip(vectors[1:], p.mixers[1:]):
            q += v @ c
        noise = np.minimum(np.searchsorted(self.cumulative, self.random.random(NOISE)), CLASSES - 1)
        shift = p.bias - self.log_noise
        wanted, drawn = p.target.take(w, 0), p.target.take(noise, 0)
        own = np.einsum("ij,ij->i", q, wanted) + shift.take(w)
        other = q @ drawn.T
        other += shift.take(noise)
        up = (1 / (1 + np.exp(np.clip(own, -20, 20)))).astype(np.float32)
        np.clip(other, -20, 20, out=other)
        np.exp(np.negative(other, out=other), out=other)
        other += 1
        down = np.reciprocal(other, out=other)
        back = up[:, None] * wanted
        back -= down @ drawn
        scale = np.float32(1 / np.sqrt(n))
        rows = np.empty((n + NOISE, WIDTH + 1), np.float32)
        np.multiply(up[:, None], q, out=rows[:n, :WIDTH])
        rows[:n, WIDTH] = up
        np.negative(down.T @ q, out=rows[n:, :WIDTH])
        np.negative(down.sum(0), out=rows[n:, WIDTH])
        g = _grouped(np.concatenate((w, noise)), rows, CLASSES) * scale
        mixers = np.stack([v.T @ back for v in vectors]) * scale
        contexts = np.concatenate([back @ c.T for c in p.mixers])
        self.step(1, g[:, :WIDTH])
        self.step(3, g[:, WIDTH])
        self.step(0, _grouped(h.ravel(), contexts, CLASSES + 1) * scale)
        self.step(2, mixers)


def log_probabilities(p: Parameters, target: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Normalised natural log-probability of every target class."""
    out = np.empty(len(target))
    # A context class as each of the places sees it; the last column carries the bias into the product.
    table = [np.column_stack((p.context @ c, np.full(CLASSES + 1, 1 / ORDER))).astype(np.float32) for c in p.mixers]
    weights = np.ascontiguousarray(np.column_stack((p.target, p.bias)).T.astype(np.float32))
    longest = sum(np.linalg.norm(t[:, :WIDTH], axis=1).max() for t in table)
    # Scores that stay this small need no shift before the exponential.
    small = longest * np.linalg.norm(p.target, axis=1).max() + np.abs(p.bias).max() < 80
    # The scores of all classes after a context are a sum over its places, one row of a matrix each.
    places = [t @ weights for t in table]
    powers = [np.exp(x) for x in places] if small else []
    rows = 256
    held = np.empty((2, rows, CLASSES), np.float32)
    for i in range(0, len(target), rows):
        h, w = context[i : i + rows].T, target[i : i + rows]
        s, other = held[:, : len(w)]
        own = sum(x[at, w] for x, at in zip(places, h))
        if small:
            # Exponentials of a sum are products of exponentials, which need no exponential for each token.
            powers[0].take(h[0], 0, out=s, mode="clip")
            for x, at in zip(powers[1:-1], h[1:-1]):
                s *= x.take(at, 0, out=other, mode="clip")
            out[i : i + rows] = own - np.log(np.einsum("ij,ij->i", s, powers[-1].take(h[-1], 0, out=other, mode="clip")))
            continue
        places[0].take(h[0], 0, out=s, mode="clip")
        for x, at in zip(places[1:], h[1:]):
            s += x.take(at, 0, out=other, mode="clip")
        top = s.max(1)
        s -= top[:, None]
        np.exp(s, out=s)
        out[i : i + rows] = own - top - np.log(s.sum(1))
    return out


def _dealt(vocab: Vocabulary, steps: int, lanes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of every text, with the step and lane that learn from it; repeated rows of a lot go apart."""
    for rows in slices(batches):
        h, ending, first = tokens(text_bytes(rows.column(1)))
        cls = vocab.classes_of(h, ending).astype("<i2")
        place = np.asarray(rows.column(0)).view(np.uint64)
        order = np.argsort(place, kind="stable")
        ranked = place[order]
        begin = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        copy = np.empty(len(place), np.uint64)
        copy[order] = np.arange(len(place)) - np.repeat(begin, np.diff(np.append(begin, len(place))))
        unit = (mix(place + copy) % np.uint64(steps * lanes)).astype(np.int64)
        classes = pa.Array.from_buffers(pa.binary(), len(place), [None, pa.py_buffer((2 * first).astype(np.int32)), pa.py_buffer(cls.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [pa.array((unit // lanes).astype(np.int32)), pa.array((unit % lanes).astype(np.int32)), pa.array(place.view(np.int64)), classes],
            ["step", "lane", "place", "classes"],
        )


SUMS = "salt int, lane int, weight double, total binary"


def _taught(p: Parameters, past: Parameters, class_count: np.ndarray, turn: int, salts: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """One lane of one step: its parameters and squared gradients times its tokens."""
    pdf = pdf.sort_values("place")
    lane = int(pdf.lane.iloc[0])
    trainer = Trainer(p, class_count, [turn, lane], past)
    texts = [np.frombuffer(c, "<i2") for c in pdf.classes]
    n = np.array([len(t) for t in texts])
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(n) // UNIT)) + 1).tolist(), len(n)]
    for a, b in zip(edges, edges[1:]):
        trainer.train(*sequences(np.concatenate(texts[a:b]).astype(np.int64), np.concatenate(([0], np.cumsum(n[a:b])))))
    values = np.concatenate((trainer.p.flat(), Parameters(*trainer.past).flat())).astype(float) * trainer.seen
    return pd.DataFrame({"salt": [lane % salts], "lane": [lane], "weight": [float(trainer.seen)], "total": [values.tobytes()]})


def _teacher(*state):
    return lambda pdf: _taught(*state, pdf)


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("lane")
    total = sum(np.frombuffer(t) for t in pdf.total)
    return pd.DataFrame({"salt": pdf.salt.iloc[:1], "lane": pdf.lane.iloc[:1], "weight": [pdf.weight.sum()], "total": [total.tobytes()]})


def plan(tokens_: int) -> tuple[int, int]:
    """(steps, lanes) of a round over so many tokens."""
    units = -(-tokens_ // UNIT)
    steps = math.isqrt(max(units - 1, 0)) + 1
    return steps, max(1, -(-units // steps))


def train(texts: DataFrame, vocab: Vocabulary) -> Parameters:
    """``texts``: (key, text) of the training rows."""
    p = Parameters.initial(vocab.class_count)
    if not vocab.total:
        return p
    spark, share, past = texts.sparkSession, vocab.class_count, p.unmoved()
    steps, lanes = plan(vocab.total)
    salts = math.isqrt(lanes - 1) + 1
    folder = scratch_path(spark, "lm-units")
    dealt = texts.select(F.xxhash64("key", "text").alias("place"), "text").mapInArrow(
        lambda it: _dealt(vocab, steps, lanes, it), "step int, lane int, place long, classes binary"
    )
    # A step is a few files.
    dealt.repartition("step", F.pmod("lane", F.lit(8))).write.partitionBy("step").parquet(folder)
    units = spark.read.schema("lane int, place long, classes binary, step int").parquet(folder)
    for turn in range(ROUNDS * steps):
        rows = units.filter(F.col("step") == turn % steps).drop("step").repartition(lanes, "lane")
        sums = rows.groupBy("lane").applyInPandas(_teacher(p, past, share, turn, salts), SUMS)
        got = sorted(sums.groupBy("salt").applyInPandas(_summed, SUMS).collect(), key=lambda r: r.salt)
        if got:
            mean = sum(np.frombuffer(r.total) for r in got) / sum(r.weight for r in got)
            p, past = p.filled(mean[: len(mean) // 2]), past.filled(mean[len(mean) // 2 :])
    return p


# ---- scores -------------------------------------------------------------------------------------------------------


def _scores(p: Parameters, vocab: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    log_all = np.log10(vocab.total + SMOOTH * (vocab.distinct + 1))
    share = np.concatenate((np.zeros(TOP), np.log10(vocab.share_total), [0.0]))
    end_count = vocab.class_count[END]
    rare_kind = pa.list_(pa.struct([("token", pa.int64()), ("times", pa.int32())]))
    for rows in slices(batches):
        h, ending, first = tokens(text_bytes(rows.column(1)))
        n = np.diff(first)
        texts = len(n)
        text = np.repeat(np.arange(texts), n)
        cls = vocab.classes_of(h, ending)
        target, context = sequences(cls, first)
        logs = log_probabilities(p, target, context) / np.log(10)
        score = np.bincount(np.repeat(np.arange(texts), n + 1), logs, minlength=texts)
        # Counts of listed words; the others' counts are added by the join.
        distinct, code = np.unique(h, return_inverse=True)
        count, listed = vocab.counts_of(distinct)
        log_count = np.where(listed, np.log10(count + SMOOTH), 0.0)[code]
        base = np.bincount(text, log_count, minlength=texts) + np.log10(end_count + SMOOTH) - (n + 1) * log_all
        inside = cls >= TOP  # shares within ending classes
        score += np.bincount(text[inside], log_count[inside] - share[cls[inside]], minlength=texts)
        known = np.bincount(text, listed[code], minlength=texts).astype(np.int64) + int(end_count > 0)
        away = np.flatnonzero(~listed[code])
        pair = np.column_stack((text[away], code[away]))
        pair, times = np.unique(pair, axis=0, return_counts=True) if len(pair) else (pair, np.zeros(0, np.int64))
        edge = np.searchsorted(pair[:, 0], np.arange(texts + 1))
        values = pa.StructArray.from_arrays([pa.array(distinct[pair[:, 1]].view(np.int64)), pa.array(times, pa.int32())], fields=list(rare_kind.value_type))
        rare = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), values)
        cols = [rows.column(0), rows.column(2), pa.array(n + 1), pa.array(known), pa.array(base), pa.array(score), rare]
        yield pa.RecordBatch.from_arrays(cols, ["key", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])


def score_texts(df: DataFrame, held_out, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; ``held_out`` marks rows not to learn from."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out.alias("held_out"))
    train_rows = rows.filter(~F.col("held_out")).select("key", "text")
    folder = scratch_path(spark, "lm-counts")
    train_rows.mapInArrow(_counts, "token long, ending int, n long").groupBy("token").agg(F.first("ending").alias("ending"), F.sum("n").alias("n")).filter("n > 0").write.parquet(folder)
    counts = spark.read.schema("token long, ending int, n long").parquet(folder)
    vocab = vocabulary(counts)
    p = train(train_rows, vocab)
    folder = scratch_path(spark, "lm-scores")
    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<struct<token:long,times:int>>"
    rows.mapInArrow(lambda it: _scores(p, vocab, it), schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    scored = spark.read.parquet(folder)
    apart = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.times")
    found = apart.join(counts.filter(F.col("n") < vocab.threshold).select("token", "n"), "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    more = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + SMOOTH)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known")
    )
    out = scored.drop("rare").join(more, "row", "left")
    add = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + add).alias("base_score"), (F.col("score") + add).alias("score"),
    )
