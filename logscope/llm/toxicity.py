"""Toxicity (operator 8): subword-bag embeddings averaged into a linear softmax.

A text is the bag of its words' features: each word in boundary marks and the word's character
3- to 5-grams, hashed into a fixed number of rows of an embedding table.  The mean of the rows
(a word that occurs c times weighs sqrt(c), so that one repeated word doesn't decide, and
``PRIOR`` neutral features are averaged in, so that a few words don't) goes through a linear
softmax over the two classes.  Embeddings and classifier are trained jointly in
numpy, so an unseen misspelling or inflection is scored by the n-gram vectors it shares with
words seen in training.

Training takes at most ``SAMPLE_ROWS`` labelled documents (those with the smallest seeded hash of
the id; the bound is a parameter).  Their bags are made in tasks from the whole texts, each bag
bounded by the table's rows, and one task trains on them; only the model reaches the driver.  A fifth of the sample is set aside once, to
calibrate the logits (scale and shift) on rows that a model has not seen.  The trained model (one
number per row, since the softmax of two classes needs only the difference of the logits) has a fixed size.
Scoring is a scalar column: no shuffle, and every word of every text counts.

Defined cases: a null text counts as empty and, like any text without words, gets the score of
the bias alone; rows without a label or id are scored but not learned from, nor are ids labelled both ways;
a model that is not finite is an error, and only scores from 0.5 to 1 count as toxic; without any training
row the score is 0.5 for every text but ``predicted`` is then 0 (nothing learned, nothing rejected);
repeated rows are scored alike; clashing column names are the caller's ``score`` and ``predicted``,
which are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import Memo, slices, texts

SAMPLE_ROWS = 5000
ROWS = 1 << 18          # of the embedding table
DIM = 4
GRAMS = (3, 4, 5)
PRIOR = 500.0           # features of a neutral text that every bag is averaged with
LEAST_STEPS = 400       # of training, however few rows there are
CALIBRATE = 5           # one in so many training rows is set aside for calibration
SEED = 8
MEMO_BYTES = 32 << 20       # of a task's memo of words


def features(word: str) -> list[int]:
    """Rows of the embedding table for one lower-cased word."""
    marked, crc, mask = f"<{word}>", zlib.crc32, ROWS - 1
    n = len(marked)
    if word.isascii():          # a character is a byte: cut the bytes
        b = marked.encode()
        out = [crc(b) & mask]
        for g in GRAMS:
            out += [crc(b[i:i + g], g) & mask for i in range(n - g + 1)]
        return out
    out = [crc(marked.encode()) & mask]
    for g in GRAMS:
        out += [crc(marked[i:i + g].encode(), g) & mask for i in range(n - g + 1)]
    return out


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(rows, counts) of a whole text."""
    ids, num = [], []
    for w, c in Counter(text.lower().split()).items():
        f = features(w)
        ids += f
        num += [c ** 0.5] * len(f)
    if not ids:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    u, inv = np.unique(np.array(ids, np.int32), return_inverse=True)
    return u, np.bincount(inv, weights=num).astype(np.float32)


@dataclass
class Model:
    """Logit difference (toxic minus clean) of each embedding row, and the bias."""

    rows: np.ndarray
    bias: float
    trained: bool = True


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 32,
          rate: float = 4.0, floor: float = 1e-7, seed: int = SEED) -> Model:
    """Joint Adagrad training of embeddings and softmax over (rows, counts) bags."""
    labels = np.asarray(labels, np.int64)
    use = [i for i in range(len(bags)) if len(bags[i][0])]
    if not use:
        return Model(np.zeros(ROWS, np.float32), 0.0, trained=False)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (ROWS, DIM)).astype(np.float32)
    soft, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias[:] = np.log([1 - share, share])
    g_emb, g_soft, g_bias = np.full(ROWS, floor, np.float32), np.full_like(soft, 1e-8), np.full_like(bias, 1e-8)
    onehot = np.eye(2, dtype=np.float32)[labels]
    epochs = max(epochs, -(-LEAST_STEPS * batch // len(use)))
    step, steps, top = 0, epochs * -(-len(use) // batch), rate
    for _ in range(epochs):
        order = rng.permutation(use)
        for k in range(0, len(order), batch):
            at = order[k:k + batch]
            rate, step = top * (1 - step / steps), step + 1     # falls evenly to nothing
            size = np.array([len(bags[i][0]) for i in at])
            seg = np.repeat(np.arange(len(at)), size)
            rows = np.concatenate([bags[i][0] for i in at])
            weight = np.concatenate([bags[i][1] for i in at])
            start = np.r_[0, np.cumsum(size)[:-1]]
            weight = weight / (PRIOR + np.add.reduceat(weight, start))[seg]
            mean = np.add.reduceat(emb[rows] * weight[:, None], start)
            z = mean @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - onehot[at]) / len(at)
            d_soft, d_bias, d_mean = mean.T @ d, d.sum(0), d @ soft.T
            by = np.argsort(rows, kind="stable")
            u, first = np.unique(rows[by], return_index=True)
            d_rows = np.add.reduceat((d_mean[seg] * weight[:, None])[by], first)
            g_emb[u] += (d_rows ** 2).mean(1)
            emb[u] -= rate * d_rows / np.sqrt(g_emb[u])[:, None]
            g_soft += d_soft ** 2
            soft -= rate * d_soft / np.sqrt(g_soft)
            g_bias += d_bias ** 2
            bias -= rate * 0.1 * d_bias / np.sqrt(g_bias)
    diff = soft[:, 1] - soft[:, 0]
    return Model((emb @ diff).astype(np.float32), float(bias[1] - bias[0]))


class _Words(Memo):
    """word -> logit sum + 1j * number of features (one number to add up), in a memo of bounded bytes."""

    def __init__(self, rows: np.ndarray, memo_bytes: int = MEMO_BYTES):
        values = rows.tolist()

        def logit(word: str) -> complex:
            f = features(word)
            return complex(sum([values[i] for i in f]), len(f))

        super().__init__(logit, memo_bytes)


def calibration(model: Model, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(scale, shift) of the logits of ``model`` that give the probabilities of rows it was not trained on (Platt's method: a
    logistic regression with smoothed targets); (1, 0) where one of the classes has no such row."""
    labels = np.asarray(labels, np.int64)
    pos, neg = int(labels.sum()), int((1 - labels).sum())
    if not (model.trained and pos and neg):
        return 1.0, 0.0
    mean = np.array([(model.rows[r] * c).sum() / (PRIOR + c.sum()) for r, c in bags], np.float64)
    spread = mean.std() or 1.0
    x = np.stack([mean / spread, np.ones(len(mean))], 1)
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.array([spread, model.bias])
    for _ in range(rounds):         # Newton's method in bounded steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0] / spread), 0.1), float(w[1] - model.bias)


def train_calibrated(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, aside: np.ndarray, **how) -> Model:
    """A model of all rows whose logits are calibrated by a model that did not see the rows ``aside``."""
    labels, aside = np.asarray(labels, np.int64), np.asarray(aside, bool)
    pick = lambda on: [b for b, x in zip(bags, on) if x]
    scale, shift = calibration(train(pick(~aside), labels[~aside], **how), pick(aside), labels[aside])
    m = train(bags, labels, **how)
    return Model((m.rows * scale).astype(np.float32), m.bias + shift, m.trained)


def score_text(words: _Words, bias: float, text: str) -> float:
    total = sum([words[w] * c ** 0.5 for w, c in Counter(text.lower().split()).items()], 0j)
    z = bias + (total.real / (PRIOR + total.imag))
    return float(1 / (1 + np.exp(-z)))


def toxicity_score(text: str | Column, model: Model) -> Column:
    """Column of toxicity scores (0 to 1); the model is broadcast once (fixed size, 1 MB)."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(model)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        words = _Words(m.rows)
        for parts in slices(batches):
            yield pa.array([score_text(words, m.bias, t) for part in parts for t in texts(part)], pa.float64())

    return run(text)


def _bags(text: str) -> Column:
    @arrow_udf("struct<ids:binary,counts:binary>")
    def run(arr: pa.Array) -> pa.Array:
        got = [bag(t) for a in range(0, len(arr), 256) for t in texts(arr.slice(a, 256))]
        cols = [pa.array([g[k].astype(t).tobytes() for g in got], pa.binary()) for k, t in ((0, "<i4"), (1, "<f4"))]
        return pa.StructArray.from_arrays(cols, names=["ids", "counts"])

    return run(text)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> Model:
    """Train on at most ``sample_rows`` rows of ``labels`` (doc_id, label) joined with their texts."""
    # an id that is labelled both ways is not learned from
    pick = (labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)")
            .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_other")).filter("_y = _other").drop("_other")
            .orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(sample_rows))
    # at most sample_rows narrow rows, so the broadcast is bounded; ids that repeat in docs give more rows, of which the
    # first sample_rows in an order by hashes of id and text are taken
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(pick), "_id")
            .select(F.xxhash64(F.lit(seed), "_id").alias("_r"), F.xxhash64("_t").alias("_h"), "_id", "_y", "_t"))
    rows = rows.withColumn("_b", _bags("_t")).select("_r", "_h", "_id", "_y", "_b.*").orderBy("_r", "_h", "_id", "_y").limit(sample_rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, labels, aside = [], [], []
        for b in batches:
            labels += b.column(3).to_pylist()
            aside += [r % CALIBRATE == 0 for r in b.column(0).to_pylist()]
            bags += [(np.frombuffer(i, "<i4"), np.frombuffer(c, "<f4")) for i, c in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
        m = train_calibrated(bags, np.array(labels, np.int64), np.array(aside, bool), seed=seed)
        if not (np.isfinite(m.rows).all() and np.isfinite(m.bias)):
            raise ArithmeticError("the toxicity model is not finite")
        yield pa.RecordBatch.from_arrays([pa.array([m.rows.tobytes()], pa.binary()), pa.array([m.bias]), pa.array([m.trained])],
                                         names=["rows", "bias", "trained"])

    # one task trains on the bounded sample, in an order that doesn't depend on arrival; only the model
    # (1 MB) comes to the driver
    got = (rows.repartition(1).sortWithinPartitions("_r", "_h", "_id", "_y")
           .mapInArrow(learn, "rows binary, bias double, trained boolean").collect())
    if not got:
        return train([], np.empty(0, np.int64))
    return Model(np.frombuffer(got[0]["rows"], np.float32), got[0]["bias"], got[0]["trained"])


def held_out(doc_id: str = "doc_id", mod: int = 5, rest: int = 0) -> Column:
    """Whether crc32 of the id as text has remainder ``rest`` modulo ``mod`` (null id: of no text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(mod)) == rest


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if score >= 0.5)."""
    scored = docs.withColumn("score", toxicity_score(text, model))
    hit = (F.col("score").between(0.5, 1.0)) if model.trained else F.lit(False)
    return scored.withColumn("predicted", hit.cast("int"))
