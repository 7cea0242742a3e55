"""Toxicity by weak supervision.

* Voters.  Many lexicon voters (a common list of insults, and words and word beginnings that are telling among labelled rows) and
  pattern voters (shouting, runs of marks, stretched letters, address in the second person next to such marks).  A
  voter fires on a text or abstains.
* Label model.  Expectation maximisation estimates how often each voter fires on toxic and on other texts; a given label is one
  more voter with fixed evidence, so that the estimates do not drift to another pair of classes.  Voters that fire together more than their common class explains
  are correlated; each voter's evidence is divided by the sum of its correlations, so that a clique counts once.
* Classifier.  A logistic regression on words and word beginnings is trained on the posterior labels.  Scores come from it alone.

Labels are read for rows in ``train`` only.  The fit uses at most ``SAMPLE`` labelled rows of each class and ``SAMPLE_BYTES`` bytes of text of each
(those with the smallest hash of the id), weighted to the share of their class among all labels; scores cover all texts.

Null and empty texts, and texts without letters, get the score of no evidence.  Labels that are null or have no document are
left out, of several labels of an id the largest holds.  Without labelled rows of both classes the insults alone decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .divergence import PLAIN
from .flat import flatten, mix, range_hashes, slices, text_bytes, words

SAMPLE, SAMPLE_BYTES = 3_000, 16 << 20
BEGINNINGS = (4, 5, 6, 7)
FEATURES, VOTERS, CHANCE = 1_500, 150, 22.0
#: Evidence of a given label in the label model: it is a voter among others, wrong in about one case of fifty.
LABEL_ODDS = 4.0
#: Common insults, for texts of any language that uses them.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "dumb", "fool", "jerk", "bastard", "imbecile", "filth", "vermin")
PATTERNS = tuple(
    re.compile(p)
    for p in (
        rb"(?:[A-Z]{3,}[^a-z]{1,3}){4}",  # shouting
        rb"[!?]{3,}",
        rb"([a-z])\1{3,}",
        rb"(?i)\b(?:you|your|u r|du|tu|vous)\b[^.\n]{0,20}!",
        rb"(?i)\b(?:hate|kill|shut up|go away)\b",
        rb"[#*$%&@]{3,}",
    )
)


def letter_words(texts: list[bytes]):
    flat = flatten([t.translate(PLAIN) for t in texts])
    return flat, *words(flat)


def text_features(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature): distinct words and word beginnings of every text; with ``known`` (sorted) only those, as indexes."""
    flat, begin, stop, first = letter_words(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    of, feature = [], []
    for k in (0, *BEGINNINGS):
        long = stop - begin > k
        h = range_hashes(flat.buf, begin[long], stop[long] if k == 0 else begin[long] + k)
        h = mix(h + np.uint64(k))
        at = text[long]
        if known is not None:
            place = np.searchsorted(known, h)
            place[place == len(known)] = 0
            hit = known[place] == h if len(known) else np.zeros(len(h), bool)
            at, h = at[hit], place[hit].astype(np.uint64)
        of.append(at)
        feature.append(h)
    of, feature = np.concatenate(of), np.concatenate(feature)
    order = np.lexsort((feature, of))
    of, feature = of[order], feature[order]
    new = np.ones(len(of), bool)
    new[1:] = (np.diff(of) != 0) | (feature[1:] != feature[:-1])
    return of[new], feature[new]


def word_feature(word: bytes) -> int:
    return int(mix(range_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)])))[0])


# ---- label model --------------------------------------------------------------------------------------------------


def label_model(votes: np.ndarray, start: np.ndarray, weight: np.ndarray, rounds: int = 15) -> np.ndarray:
    """Posterior of class 1 for rows of ``votes`` (fires or abstains), from the starting labels ``start``."""
    v = votes.astype(float)
    post = start.astype(float)
    for _ in range(rounds):
        w1, w0 = weight * post, weight * (1 - post)
        prior = (w1.sum() + 1) / (weight.sum() + 2)
        on_1 = (w1 @ v + 0.5) / (w1.sum() + 1)
        on_0 = (w0 @ v + 0.5) / (w0.sum() + 1)
        # What a voter does beyond the mean of its class.
        rest = v - np.outer(post, on_1) - np.outer(1 - post, on_0)
        cov = (rest * weight[:, None]).T @ rest / weight.sum()
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = np.clip(cov / np.outer(scale, scale), 0, 1)
        share = 1 / np.maximum(np.where(corr > 0.5, corr, 0).sum(1), 1)
        fires = np.log(on_1 / on_0)
        # A voter that abstains says nothing; that no telling voter fires is one piece of evidence.
        none = (v[:, fires > 1] == 0).all(1)
        quiet = np.log((w1 @ none + 0.5) / (w1.sum() + 1)) - np.log((w0 @ none + 0.5) / (w0.sum() + 1))
        odds = np.log(prior / (1 - prior)) + v @ (share * fires) + none * quiet + LABEL_ODDS * (2 * start - 1)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            return new
        post = new
    return post


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.02, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton steps; the penalty keeps weights of chance features small.  The bias is not penalised."""
    x = np.column_stack((x, np.ones(len(x), np.float32)))
    w = np.zeros(x.shape[1], np.float32)
    ridge = np.full(x.shape[1], penalty, np.float32)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)).astype(np.float32) + ridge * w
        h = (weight * np.maximum(p * (1 - p), 1e-4)).astype(np.float32)
        step = np.linalg.solve((x * h[:, None]).T @ x + np.diag(ridge), gradient)
        w = w - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        of, at = text_features(texts, self.features)
        odds = self.bias + np.bincount(of, self.weights[at.astype(np.int64)] if len(at) else None, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def insult_model() -> Model:
    h = np.array(sorted(word_feature(w.encode()) for w in INSULTS), np.uint64)
    return Model(h, np.full(len(h), 6.0), -3.0)


# ---- fit ----------------------------------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, key: str, text: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    """((label, text) rows of the bounded sample as a written table, number of labels of each class).

    Rows are chosen by id and text: an id with many texts takes no more room than many ids, and repeated rows count once.
    """
    spark = docs.sparkSession
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).filter(train).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    chosen = []
    mark = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    for k in (0, 1):
        ids = marked.filter(F.col("label") == k).orderBy(F.xxhash64(key), key).limit(SAMPLE).select(F.col(key).alias("id"))
        sized = docs.join(F.broadcast(ids), docs[key] == ids["id"]).select("id", F.coalesce(F.octet_length(text), F.lit(0)).alias("size"), mark.alias("mark")).distinct()
        room = SAMPLE_BYTES
        for r in sized.orderBy(F.xxhash64("id"), "id", "size", "mark").limit(SAMPLE).collect():
            if r["size"] <= room:
                room -= r["size"]
                chosen.append((r["id"], r["mark"], k))
    few = spark.createDataFrame(sorted(chosen), f"id {docs.schema[key].dataType.simpleString()}, mark long, label int")
    folder = scratch_path(spark, "toxicity-sample")
    rows = docs.join(F.broadcast(few), (docs[key] == few["id"]) & (mark == few["mark"])).select("id", "mark", "label", F.col(text).alias("text"))
    rows.dropDuplicates(["id", "mark"]).select("label", "text").write.parquet(folder)
    return spark.read.schema("label int, text string").parquet(folder), totals


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        label = np.asarray(rows.column(0))
        of, feature = text_features(text_bytes(rows.column(1)))
        names, code = np.unique(feature, return_inverse=True)
        pos = np.bincount(code, label[of] == 1, minlength=len(names)).astype(np.int64)
        n = np.bincount(code, minlength=len(names)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(pos), pa.array(n - pos)], ["feature", "pos", "neg"])


def telling_features(sample: DataFrame, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, gain) of features that toxic texts have more often than chance explains.

    The gain is the log-likelihood ratio against chance: far too many features are looked at to take the odds as they are.
    """
    counts = sample.mapInArrow(_feature_counts, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n, share = F.col("pos") + F.col("neg"), n1 / (n1 + n0)
    part = lambda c, s: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * s))).otherwise(0.0)
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1)) - F.log((F.col("neg") + 0.5) / (n0 + 1))
    best = counts.filter((F.col("pos") > 0) & (odds > 1)).select("feature", F.round(2 * (part("pos", share) + part("neg", 1 - share)), 9).alias("gain"))
    rows = best.filter(F.col("gain") > CHANCE).orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()
    names = np.array([r.feature for r in rows], np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], np.array([r.gain for r in rows])[order]


def _signs(known: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, known features, insults, patterns) of every text, as indexes."""
    insults = np.array(sorted(word_feature(w.encode()) for w in INSULTS), np.uint64)
    for rows in slices(batches):
        texts = text_bytes(rows.column(1))
        lists = []
        for names in (known, insults):
            of, at = text_features(texts, names)
            edge = np.searchsorted(of, np.arange(len(texts) + 1))
            lists.append(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(at.astype(np.int32))))
        shapes = pa.array([[j for j, p in enumerate(PATTERNS) if p.search(t)] for t in texts], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([rows.column(0), *lists, shapes], ["label", "features", "insults", "shapes"])


def _table(lists, width: int) -> np.ndarray:
    x = np.zeros((len(lists), width), np.float32)
    for i, at in enumerate(lists):
        x[i, at] = 1
    return x


def learn(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The driver gets the signs of the sample's texts, never the texts."""
    sample, totals = labelled_sample(docs, labels, train, key, text, label)
    taken = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not taken.get(0) or not taken.get(1):
        return insult_model()
    known, gain = telling_features(sample, taken[1], taken[0])
    if not len(known):
        return insult_model()
    signs = sample.mapInArrow(lambda it: _signs(known, it), "label int, features array<int>, insults array<int>, shapes array<int>").collect()
    signs.sort(key=lambda r: (r.label, r.features, r.insults, r.shapes))
    y = np.array([r.label for r in signs])
    weight = np.array([totals[k] / taken[k] for k in (0, 1)])[y]
    x = _table([r.features for r in signs], len(known))
    telling = np.argsort(-gain, kind="stable")[:VOTERS]
    votes = np.column_stack((x[:, telling], _table([r.insults for r in signs], len(INSULTS)), _table([r.shapes for r in signs], len(PATTERNS))))
    votes = votes[:, votes.any(0)]
    soft = label_model(votes, y, weight)
    w, b = logistic(x, soft, weight / weight.mean())
    return Model(known, w.astype(float), b)


# ---- on tables ----------------------------------------------------------------------------------------------------


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(key, [carry], score, predicted) of every text; the score depends on the text alone."""
    names = ["key", *(f"c{i}" for i in range(len(carry)))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, [key, *carry]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            s = model.scores(text_bytes(rows.column(1)))
            yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[2:], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    out = rows.mapInArrow(run, f"{schema}, score double, predicted int")
    return out.select(F.col("key").alias(key), *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "score", "predicted")


def fold(key: str, of: int) -> Column:
    """Remainder of the id's crc32 (a null id: of the empty string)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of


def reject(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    names = docs.columns
    plain = docs.toDF(*(f"x{i}" for i in range(len(names))))
    k, t = f"x{names.index(key)}", f"x{names.index(text)}"
    kept = score(plain, model, k, t, carry=[c for c in plain.columns if c != k]).filter("predicted = 0")
    return kept.select(*(F.col(f"x{i}").alias(n) for i, n in enumerate(names)))
