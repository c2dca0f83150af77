"""Quality classifier learnt from positives and unlabelled text.

Trusted positives are documents labelled 1; the unlabelled are web text of any kind, labelled or not. Labels 0 are never
read. A small neural network (numpy) minimises the non-negative unbiased risk of Kiryo et al. (2017):
prior * R(positives as 1) + max(0, R(unlabelled as 0) - prior * R(positives as 0)), with the logistic
loss, so that its output estimates the probability of label 1.

The class prior comes from a second classifier, of positives against unlabelled: where a text can only be
positive, the densities' ratio is the prior, so the prior is the median of (1 - s) / s over positives that it
was not fitted on.

Both are fitted on a bounded sample, POSITIVES and UNLABELLED documents at most in expectation, each drawn by
a hash of its id (and text, if unlabelled; equal rows are one); all texts are scored, whole. Scores depend on the text only: shares of characters, word
lengths, repeated words and lines.

Defined cases: a missing text is empty; empty texts have a score like any other, that of no words; a row or label without
an id is scored but teaches nothing as a positive; repeated labels count once, and one 1 makes a positive;
repeated rows are scored each; without any positive, or any unlabelled row, all scores are 0.5; an empty table
gives no rows; further columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import count_rows, drawn, id_crc, stored, text_bytes, with_columns

POSITIVES, UNLABELLED = 8000, 16000
THRESHOLD = 0.3
HIDDEN, EPOCHS, BATCH, RATE = 24, 40, 512, 5e-3

#: One share for each of these and for the classes below.
_SINGLE = b"\n\t .,;:!?'\"()[]{}<>|/\\*#%&$@_-+=~^`"
_CLASSES = (range(48, 58), range(65, 91), range(97, 123), range(128, 256), range(0, 9))


def _character_classes() -> np.ndarray:
    sums = np.zeros((256, len(_SINGLE) + len(_CLASSES)), dtype=np.float64)
    for i, byte in enumerate(_SINGLE):
        sums[byte, i] = 1
    for i, group in enumerate(_CLASSES, len(_SINGLE)):
        sums[list(group), i] = 1
    return sums


_SUMS = _character_classes()
FEATURES = _SUMS.shape[1] + 9


def features(text: bytes) -> np.ndarray:
    out = np.zeros(FEATURES)
    n = len(text)
    shares = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _SUMS
    out[: len(shares)] = np.sqrt(shares / max(n, 1))
    words = text.lower().split()
    lines = text.split(b"\n")
    count = len(words)
    distinct = len(set(words))
    out[len(shares) :] = (
        np.log1p(n),
        np.log1p(count),
        sum(map(len, words)) / max(count, 1),
        distinct / max(count, 1),
        np.log1p(distinct) / max(np.log1p(count), 1e-9),
        sum(map(eq, words, words[1:])) / max(count - 1, 1),
        1 - len(set(lines)) / len(lines),
        np.log1p(count / len(lines)),
        max(map(len, words), default=0) ** 0.5,
    )
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


class Network:
    """One hidden layer; its output is a logit."""

    def __init__(self, inputs: int, seed: int):
        rng = np.random.default_rng(seed)
        self.weights = [
            rng.standard_normal((inputs, HIDDEN)) / np.sqrt(inputs),
            np.zeros(HIDDEN),
            rng.standard_normal((HIDDEN, 1)) / np.sqrt(HIDDEN),
            np.zeros(1),
        ]
        self._moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self._steps = 0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return (np.tanh(x @ a + b) @ c + d)[:, 0]

    def step(self, x: np.ndarray, slope: np.ndarray) -> None:
        """One Adam step; ``slope``: derivative of the loss by each row's logit."""
        a, b, c, d = self.weights
        hidden = np.tanh(x @ a + b)
        back = slope[:, None] @ c.T * (1 - hidden**2)
        grads = [x.T @ back, back.sum(axis=0), hidden.T @ slope[:, None], slope[None].sum(axis=1)]
        self._steps += 1
        for i, grad in enumerate(grads):
            grad = grad + 1e-4 * self.weights[i]
            first, second = self._moments[i]
            first += 0.1 * (grad - first)
            second += 0.001 * (grad**2 - second)
            m = first / (1 - 0.9**self._steps)
            v = second / (1 - 0.999**self._steps)
            self.weights[i] = self.weights[i] - RATE * m / (np.sqrt(v) + 1e-8)


def _batches(rng: np.random.Generator, p: int, u: int):
    """Pairs of batches of positives and unlabelled; each epoch goes once through the larger set."""
    steps = max(1, -(-max(p, u) // BATCH))
    for _ in range(EPOCHS):
        own, other = rng.permutation(p), rng.permutation(u)
        for i in range(steps):
            yield (
                own[np.arange(i * p // steps, max((i + 1) * p // steps, i * p // steps + 1)) % p],
                other[np.arange(i * u // steps, max((i + 1) * u // steps, i * u // steps + 1)) % u],
            )


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled."""
    rng = np.random.default_rng(5)
    order = rng.permutation(len(positive))
    fit, rest = order[: (len(order) + 1) // 2], order[(len(order) + 1) // 2 :]
    if not len(rest):
        rest = fit
    net = Network(positive.shape[1], 6)
    x = positive[fit]
    for a, b in _batches(rng, len(x), len(unlabelled)):
        rows = np.concatenate([x[a], unlabelled[b]])
        s = _sigmoid(net.logits(rows))
        # Both sets weigh the same, so s / (1 - s) estimates the ratio of the densities.
        slope = np.concatenate([(s[: len(a)] - 1) / len(a), s[len(a) :] / len(b)]) / 2
        net.step(rows, slope)
    s = np.clip(_sigmoid(net.logits(positive[rest])), 1e-6, 1 - 1e-6)
    return float(np.clip(np.median((1 - s) / s), 0.02, 0.98))


def fit_network(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk."""
    rng = np.random.default_rng(7)
    net = Network(positive.shape[1], 8)
    for a, b in _batches(rng, len(positive), len(unlabelled)):
        rows = np.concatenate([positive[a], unlabelled[b]])
        z = net.logits(rows)
        s = _sigmoid(z)
        p, u = s[: len(a)], s[len(a) :]
        as_zero = np.logaddexp(0, z)  # loss of a row taken for label 0
        negative = as_zero[len(a) :].mean() - prior * as_zero[: len(a)].mean()
        slope = np.zeros(len(rows))
        if negative >= 0:
            slope[: len(a)] = prior * ((p - 1) - p) / len(a)
            slope[len(a) :] = u / len(b)
        else:
            # The negative part has been fitted too far: this step only takes that back.
            slope[: len(a)] = prior * p / len(a)
            slope[len(a) :] = -u / len(b)
        net.step(rows, slope)
    return net


@dataclass
class Model:
    network: Network | None
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), 0.5)
        return _sigmoid(self.network.logits((np.array([features(t) for t in texts]) - self.mean) / self.scale))


def held_out() -> Column:
    return id_crc() % 5 == 0


def _feature_rows(rows: DataFrame) -> np.ndarray:
    """Features of a bounded number of rows, in an order that doesn't depend on the tasks."""

    def make():
        kind = pa.list_(pa.float64())
        return lambda batch: [pa.array([features(t).tolist() for t in text_bytes(batch)], kind)]

    found = with_columns(rows, "_features array<double>", make, ["text"]).select("_features").collect()
    return np.array(sorted(r["_features"] for r in found)).reshape(-1, FEATURES)


def train(
    documents: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> Model:
    training = documents.where(~held_out()).select("doc_id", "text")
    trusted = labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id").dropna().distinct()

    # About ``positives`` ids, so they can be broadcast; of the texts that share an id one is taken.
    place = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 24)) / float(1 << 24)
    share = positives / max(count_rows(trusted), 1)
    ids = stored(trusted.where(place < share).select(F.col("doc_id").alias("_id")), "trusted")
    marked = training.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    p = _feature_rows(marked.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    u = _feature_rows(drawn(training, unlabelled / max(count_rows(training.select("doc_id")), 1), 4))
    if not len(p) or not len(u):
        return Model(None, np.zeros(FEATURES), np.ones(FEATURES), 0.5)
    both = np.concatenate([p, u])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 0.01
    p, u = (p - mean) / scale, (u - mean) / scale
    prior = estimate_prior(p, u)
    return Model(fit_network(p, u, prior), mean, scale, prior)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with _quality, the estimated probability of label 1; nothing is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda batch: [pa.array(shared.value.scores(text_bytes(batch)), pa.float64())]

    return with_columns(documents, "_quality double", make, ["text"])


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_quality").alias("score"),
        F.when(F.col("_quality") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
