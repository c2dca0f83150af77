"""Score texts with a log-bilinear language model, trained by noise-contrastive estimation.

The model (Mnih and Hinton, 2007) predicts a vector from the CONTEXT words before a token, each through the
diagonal matrix of its position, and scores a word by that vector's product with the word's own vector plus a bias.
It knows the CLASSES most frequent words; one more class stands for all other words, which share its probability
by their counts plus one, the unknown word included. So the log-probabilities are normalised over the whole
vocabulary: a batched matrix product gives the scores of all classes for every distinct context of a batch.

Counting covers all training texts. Training goes once through all of them, in ROUNDS parts: every task
trains on its own rows from the same start, with one set of noise words for a batch, and the tasks' parameters
are averaged, weighted by their tokens. The parameters, and the words that occur most (at most
HEAD), are what is broadcast; counts of rarer words meet the texts in a join.

Defined cases: a missing text is empty; an empty text is its end token; rows with equal ids are scored each; a row
without an id counts as the empty id (crc32 0: training); words of equal count rank by their bytes; without
any training text the score is the base score; an empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import id_crc, stored, text_bytes

#: No word can hold a blank, so this one is free.
END = b"\n"
HEAD, CLASSES, DIMS, CONTEXT = 131_072, 1024, 24, 2
ROUNDS, NOISE, BATCH, RATE = 2, 64, 2048, 0.08
#: Tokens that are worked on at a time; distinct words that a counting task holds before it sends them.
TOKENS, HELD = 1 << 18, 1 << 18
#: Pieces in which parameters travel.
PARTS = 16


def words(text: bytes) -> list[bytes]:
    # bytes.lower() and bytes.split() know ASCII only: A-Z and the blanks \x20, \x09-\x0D.
    out = text.lower().split()
    out.append(END)
    return out


def held_out() -> Column:
    return id_crc() % 7 == 2


def count_words(texts: DataFrame) -> DataFrame:
    """word, c over all rows."""

    def run(batches):
        def rows(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        counts: Counter = Counter()
        for batch in batches:
            for text in text_bytes(batch):
                counts.update(words(text))
                if len(counts) > HELD:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    counted = texts.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """The most frequent words in order of count, with totals over all words."""

    head: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def classes(self) -> int:
        return min(CLASSES, len(self.head))

    @property
    def rare(self) -> int:
        """Counts plus one of all words outside the classes, and one for the unknown word."""
        return self.tokens + self.distinct + 1 - int((self.counts[: self.classes] + 1).sum())

    def index(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[bytes]]]:
        """Place of every token in the head (-1: not there), and each text's words."""
        split = [words(t) for t in texts]
        flat = chain.from_iterable(split)
        n = sum(map(len, split))
        return np.fromiter(map(self.head.get, flat, repeat(-1)), dtype=np.int32, count=n), split


def vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # How many words have a count: at most about the square root of twice the tokens.
    sizes = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(HEAD).collect()
    least, room = 0, HEAD
    for row in sizes:
        room -= row["n"]
        if room < 0:
            least = row["c"] + 1
            break
    else:
        if len(sizes) == HEAD:
            # There are more counts than were listed, each of at least one word.
            least = sizes[-1]["c"]
    rows = counts.where(F.col("c") >= least).collect()  # at most HEAD rows
    rows = sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))
    return Vocabulary(
        {w: i for i, (w, _) in enumerate(rows)},
        np.array([c for _, c in rows], dtype=np.int64),
        totals["n"] or 0,
        totals["v"],
    )


class LogBilinear:
    """Vectors of context words, vectors and biases of predicted classes, and the positions' matrices."""

    def __init__(self, frequency: np.ndarray):
        rng = np.random.default_rng(11)
        n = len(frequency)
        self.noise = np.asarray(frequency, dtype=np.float64) / frequency.sum()
        self.seen = (rng.standard_normal((n, DIMS)) * 0.1).astype(np.float32)
        self.told = (rng.standard_normal((n, DIMS)) * 0.1).astype(np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        self.places = np.ones((CONTEXT, DIMS), dtype=np.float32)
        self.places[1:] *= 0.5

    NAMES = ("seen", "told", "bias", "places")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].astype(np.float32).reshape(old.shape))
            at += old.size

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.seen[contexts[:, i]] * self.places[i] for i in range(CONTEXT))

    def train(self, contexts: np.ndarray, target: np.ndarray, rng: np.random.Generator, memory: dict) -> None:
        """One pass of noise-contrastive estimation with adaptive steps (Adagrad)."""
        n = len(self.bias)
        log_noise = np.log(self.noise * NOISE).astype(np.float32)
        steps = np.cumsum(self.noise)

        def apply(name: str, grad: np.ndarray) -> None:
            held = memory.setdefault(name, np.full(grad.shape, 1e-2, dtype=np.float32))
            held += grad * grad
            getattr(self, name)[...] -= RATE * grad / np.sqrt(held)

        def spread(rows: np.ndarray, grad: np.ndarray) -> np.ndarray:
            """Sum of the gradients' rows by word."""
            flat = (rows[:, None] * DIMS + np.arange(DIMS)).ravel()
            return np.bincount(flat, weights=grad.ravel(), minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)

        for a in range(0, len(target), BATCH):
            c, w = contexts[a : a + BATCH], target[a : a + BATCH]
            fake = np.minimum(np.searchsorted(steps, rng.random(NOISE)), n - 1)
            vector = self.predicted(c)
            own, other = self.told[w], self.told[fake]
            true = (vector * own).sum(axis=1) + self.bias[w] - log_noise[w]
            false = vector @ other.T + self.bias[fake] - log_noise[fake]
            # Slopes of the loss: true words should look true, noise words false.
            up = (0.5 * (np.tanh(true / 2) - 1)).astype(np.float32)
            down = (0.5 * (np.tanh(false / 2) + 1)).astype(np.float32)
            back = up[:, None] * own + down @ other
            told = spread(w, up[:, None] * vector)
            np.add.at(told, fake, down.T @ vector)
            bias = np.bincount(w, weights=up, minlength=n) + np.bincount(fake, weights=down.sum(axis=0), minlength=n)
            seen = sum(spread(c[:, i], back * self.places[i]) for i in range(CONTEXT))
            places = np.stack([(back * self.seen[c[:, i]]).sum(axis=0) for i in range(CONTEXT)])
            size = np.float32(1 / math.sqrt(len(w)))
            apply("told", told * size)
            apply("seen", seen * size)
            apply("bias", bias.astype(np.float32) * size)
            apply("places", places * size)

    def log_probabilities(self, contexts: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's class probability, normalised over all classes."""
        n = len(self.bias)
        code = np.zeros(len(target), dtype=np.int64)
        for i in range(CONTEXT):
            code = code * n + contexts[:, i]
        _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
        vectors = self.predicted(contexts[first])
        # No score exceeds the product of the norms plus the largest bias. That bound, and the biases, enter the
        # matrix product as two more columns, so the scores come out ready for the exponential.
        bound = np.linalg.norm(vectors, axis=1) * np.linalg.norm(self.told, axis=1).max() + self.bias.max()
        ones = np.ones((max(len(vectors), n), 1), dtype=np.float32)
        left = np.hstack([vectors, ones[: len(vectors)], -bound[:, None]]).astype(np.float32)
        right = np.hstack([self.told, self.bias[:, None], ones[:n]]).astype(np.float32).T
        total = np.empty(len(first), dtype=np.float64)
        for a in range(0, len(first), 1024):
            scores = left[a : a + 1024] @ right
            np.exp(scores, out=scores)
            total[a : a + 1024] = np.log(scores.sum(axis=1)) + bound[a : a + 1024]
        own = np.einsum("ij,ij->i", vectors[inverse], self.told[target]).astype(np.float64) + self.bias[target]
        return own - total[inverse]


def _contexts(place: np.ndarray, ends: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Class of each token and of the tokens before it; before a text stand ends."""
    n = known.classes
    kind = np.where((place < 0) | (place >= n), n, place).astype(np.int64)
    end = known.head.get(END, n)
    end = end if end < n else n
    out = np.full((len(kind), CONTEXT), end, dtype=np.int64)
    starts = np.append(0, ends[:-1])
    since = np.arange(len(kind)) - np.repeat(starts, ends - starts)
    for i in range(CONTEXT):
        out[i + 1 :, i] = kind[: len(kind) - i - 1]
        out[since <= i, i] = end
    return kind, out


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Lists of texts with about TOKENS tokens at most, as a word has two bytes at least."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        if group and size + len(t) > TOKENS * 6:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def train(training: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    n = known.classes
    model = LogBilinear(np.append(known.counts[:n] + 1, known.rare))
    context = training.sparkSession.sparkContext
    # The quotient by 7, as the remainder decides who is held out.
    part = F.pmod(F.floor(id_crc() / 7), F.lit(rounds))
    for r in range(rounds):
        shared = context.broadcast((model, known))

        def run(batches):
            start, words_known = shared.value
            own = LogBilinear(start.noise)
            own.load(start.flat())
            memory: dict = {}
            tokens = 0
            for batch in batches:
                for group in _groups(text_bytes(batch)):
                    place, split = words_known.index(group)
                    ends = np.cumsum([len(s) for s in split])
                    kind, before = _contexts(place, ends, words_known)
                    rng = np.random.default_rng(len(kind))
                    order = rng.permutation(len(kind))
                    own.train(before[order], kind[order], rng, memory)
                    tokens += len(kind)
            if tokens:
                pieces = np.array_split(own.flat(), PARTS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(PARTS), pa.int32()),
                        pa.array([float(tokens)] * PARTS, pa.float64()),
                        pa.array([p.tobytes() for p in pieces], pa.binary()),
                    ],
                    names=["part", "weight", "body"],
                )

        def mean(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            weights = rows["weight"].to_numpy()
            total = np.zeros(len(rows["body"].iloc[0]) // 4)
            for weight, body in sorted(zip(weights, rows["body"])):
                total += np.frombuffer(body, dtype=np.float32) * (weight / weights.sum())
            return pd.DataFrame({"part": [key[0]], "body": [total.astype(np.float32).tobytes()]})

        trained = training.where(part == r).select("text").mapInArrow(run, "part int, weight double, body binary")
        parts = trained.groupBy("part").applyInPandas(mean, "part int, body binary").collect()  # PARTS rows
        if parts:
            bodies = [bytes(p["body"]) for p in sorted(parts, key=lambda p: p["part"])]
            model.load(np.frombuffer(b"".join(bodies), dtype=np.float32))
    return model


_SCORED = (
    "doc_id long, _key long, held_out boolean, n_tokens long, n_head long, base double, model double, "
    "tail array<struct<word: binary, n: long>>"
)


def score(documents: DataFrame, known: Vocabulary, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    shared = documents.sparkSession.sparkContext.broadcast((known, model))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("_key"),
        held_out().alias("held_out"),
        "text",
    )
    n_classes, log_rare, log_all = known.classes, math.log10(known.rare), math.log10(known.tokens + known.distinct + 1)

    def run(batches):
        voc, lm = shared.value
        log_count = np.log10(voc.counts + 1.0)
        for batch in batches:
            texts, at = text_bytes(batch), 0
            for group in _groups(texts):
                place, split = voc.index(group)
                lengths = np.array([len(s) for s in split])
                ends = np.cumsum(lengths)
                row = np.repeat(np.arange(len(group)), lengths)
                kind, before = _contexts(place, ends, voc)
                logs = np.zeros(len(kind))
                for a in range(0, len(kind), TOKENS):
                    logs[a : a + TOKENS] = lm.log_probabilities(before[a : a + TOKENS], kind[a : a + TOKENS])
                logs /= math.log(10)
                in_head = place >= 0
                # Words outside the classes share their class by count plus one; the tail's counts come by the join.
                base = np.zeros(len(place))
                base[in_head] = log_count[place[in_head]]
                logs += np.where(kind == n_classes, base - log_rare, 0.0)
                tails = []
                tail_at = np.flatnonzero(~in_head)
                cut = np.searchsorted(row[tail_at], np.arange(len(group) + 1))
                for i, s in enumerate(split):
                    first = ends[i] - lengths[i]
                    own = Counter([s[j - first] for j in tail_at[cut[i] : cut[i + 1]].tolist()])
                    tails.append([{"word": w, "n": n} for w, n in own.items()])
                part = batch.slice(at, len(group))
                at += len(group)
                sums = lambda x: pa.array(np.bincount(row, weights=x, minlength=len(group)), pa.float64())
                heads = np.bincount(row[in_head], minlength=len(group))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_key"),
                        part.column("held_out"),
                        pa.array(lengths, pa.int64()),
                        pa.array(heads, pa.int64()),
                        sums(base - log_all),
                        sums(logs),
                        pa.array(tails, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                    ],
                    names=["doc_id", "_key", "held_out", "n_tokens", "n_head", "base", "model", "tail"],
                )

    scored = stored(rows.mapInArrow(run, _SCORED), "scored")
    tail = scored.select("_key", F.explode("tail").alias("t")).select("_key", "t.word", "t.n")
    met = tail.join(counts, "word", "left")
    rest = met.groupBy("_key").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.drop("tail").join(rest, "_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


def digest(documents: DataFrame) -> DataFrame:
    training = documents.where(~held_out()).select("doc_id", "text")
    counts = stored(count_words(training), "words")
    known = vocabulary(counts)
    return score(documents, known, train(training, known), counts)
