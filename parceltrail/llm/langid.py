"""Language of a text by its nearest centroid.

A text's vector holds the counts of its hashed byte n-grams (n of 2 and 3, ASCII punctuation, digits and
case folded away), damped by log(1 + tf), weighted by idf and scaled to length 1. Each language has up to
CLUSTERS centroids (spherical k-means over a bounded sample of its documents); the centroid with the
largest cosine gives the language. A text is rejected if it lies far from its centroid: its cosine is
below SLACK times the QUANTILE of the cosines of that centroid's members of about the same length (in distinct
n-grams). Members are the sampled texts and their beginnings, so that short lengths are known too; a member's cosine
is taken to the centroid without it. Where a centroid has few members of a length, its language's count.

Document frequencies are counted over all training documents; only the k-means sample is bounded, at about
SAMPLE documents a language (each is drawn by a hash of its id and text, equal rows are one). The driver sees the centroids and one
frequency for each of the DIMS features, nothing else.

Defined cases: a missing text, or one without a letter, is `und` with score 0 and is rejected; empty texts
have no letter; equal cosines go to the language first in the alphabet; repeated rows are counted and
predicted like any other; a missing lang is no label; with no labelled row at all everything is `und`; a long text is worked on
in slices, with a few bytes of memory for each of its bytes; an empty table gives no rows; further columns are kept by ``classify`` and don't matter.
"""

from __future__ import annotations

from codecs import getincrementaldecoder
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import drawn, free, id_crc, with_columns

DIMS = 4096
CLUSTERS = 4
SAMPLE = 1200
#: Of each centroid's members so large a share lies below the bound, which is then lowered by a factor.
QUANTILE, SLACK = 0.01, 0.9
#: Lengths are told apart by doubling; fewer members than MEMBERS don't make a bound of a centroid's own.
LENGTHS, MEMBERS = 13, 30
#: Bytes of the beginnings of sampled texts.
STARTS = (8, 16, 32, 64, 128, 256, 512, 1024, 2048)
#: Texts are worked on in groups of about so many bytes and at most so many rows.
GROUP_BYTES, GROUP_ROWS = 1 << 20, 512
#: Bytes of a group whose n-grams are worked out at a time; a longer text is a group of its own.
SLICE = 1 << 20
UNKNOWN = "und"

#: ASCII letters in lower case; other ASCII becomes a blank; bytes of longer characters stay.
_FOLD = bytes(
    (b | 32) if 65 <= b <= 90 or 97 <= b <= 122 else (b if b >= 128 else 32) for b in range(256)
)


def features(texts: list[bytes]) -> np.ndarray:
    """Counts of hashed 2- and 3-grams: one row of DIMS for each text; n-grams don't cross texts."""
    if not texts:
        return np.zeros((0, DIMS), dtype=np.int64)
    joined = np.frombuffer(b"  ".join([b"", *(t.translate(_FOLD) for t in texts), b" "]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 2 for t in texts])
    flat = np.zeros(len(texts) * DIMS, dtype=np.int64)
    # A text's n-grams start at the blank before it, so that starts and ends of words count.
    for a in range(0, ends[-1], SLICE):
        at = np.arange(a, min(a + SLICE, ends[-1]))
        row = np.searchsorted(ends, at, side="right")
        one, next_one, third = (joined[np.minimum(at + i, len(joined) - 1)].astype(np.uint32) for i in (1, 2, 3))
        two = one | (next_one << np.uint32(8))
        three = two | (third << np.uint32(16)) | np.uint32(1 << 24)
        some = ~((one == 32) & (next_one == 32)) & (at != ends[row] - 1)
        for grams in (two[some], three[some]):
            place = ((grams * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
            flat += np.bincount(row[some] * DIMS + place, minlength=len(flat))
    return flat.reshape(len(texts), DIMS)


def groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts that are worked on together."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > GROUP_BYTES or i - start >= GROUP_ROWS):
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def length_class(vectors: np.ndarray) -> np.ndarray:
    """Doublings of the number of distinct n-grams of each vector."""
    return np.log2(np.maximum((vectors > 0).sum(axis=1), 1)).astype(int)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    weighed = np.log1p(features(texts).astype(np.float32)) * idf
    norms = np.linalg.norm(weighed, axis=1, keepdims=True)
    return weighed / np.where(norms > 0, norms, 1)


def has_letter(text: bytes) -> bool:
    decoder = getincrementaldecoder("utf-8")("replace")
    return any(any(map(str.isalpha, decoder.decode(text[a : a + SLICE]))) for a in range(0, len(text), SLICE))


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # cosine below which a text is rejected, by centroid and length class
    idf: np.ndarray

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names, scores, rejected = [], [], []
        for a, b in groups(texts):
            part = texts[a:b]
            letters = [has_letter(t) for t in part]
            if not self.langs:
                letters = [False] * len(part)
                best = cosine = least = np.zeros(len(part), dtype=int)
            else:
                points = vectors(part, self.idf)
                cosines = points @ self.centroids.T
                best = cosines.argmax(axis=1)
                cosine = np.clip(cosines[np.arange(len(part)), best], 0, 1)
                least = self.least[best, length_class(points)]
            names += [self.langs[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
            scores.append(np.where(letters, cosine, 0.0))
            rejected.append((cosine < least) | ~np.array(letters))
        if not texts:
            return [], np.zeros(0), np.zeros(0, dtype=bool)
        return names, np.concatenate(scores).astype(float), np.concatenate(rejected)


def held_out() -> Column:
    return id_crc() % 3 == 1


def _frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training texts each feature stands, and the number of texts."""

    def run(batches):
        seen, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            for a, b in groups(texts):
                seen += (features(texts[a:b]) > 0).sum(axis=0)
            n += len(texts)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, DIMS), pa.int32()), pa.array(np.concatenate([[n], seen]), pa.int64())],
                names=["feature", "n"],
            )

    sums = training.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    rows = {r["feature"]: r["n"] for r in sums.collect()}  # DIMS + 1 rows
    return np.array([rows.get(i, 0) for i in range(DIMS)], dtype=float), rows.get(-1, 0)


def _cluster(points: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out starts: centroids, and the one of each point."""
    centres = [points.mean(axis=0)]
    nearest = np.full(len(points), -np.inf)
    for _ in range(min(k, len(points)) - 1):
        c = centres[-1] / max(np.linalg.norm(centres[-1]), 1e-12)
        nearest = np.maximum(nearest, points @ c)
        centres.append(points[nearest.argmin()])
    centres = np.array(centres)
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        filled = np.bincount(own, minlength=len(centres)) > 0
        centres[filled] = sums[filled]
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    kept, own = np.unique((points @ centres.T).argmax(axis=1), return_inverse=True)
    return centres[kept], own


def _bounds(texts: list[bytes], points: np.ndarray, centres: np.ndarray, own: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Least cosine of a text by centroid and length class, from the members of one language's centroids."""
    sums = np.zeros_like(centres)
    np.add.at(sums, own, points)
    nearest, lengths, cosines = [], [], []

    def add(of: np.ndarray, pieces: np.ndarray) -> None:
        """``pieces`` of the points ``of``, against the centroids without those points."""
        found = pieces @ centres.T
        at = np.arange(len(of))
        rest = sums[own[of]] - points[of]
        norms = np.linalg.norm(rest, axis=1)
        # A centroid of one point has nothing left; its member goes to the nearest of the others.
        found[at, own[of]] = np.where(norms > 1e-4, (pieces * rest).sum(axis=1) / np.maximum(norms, 1e-4), -1)
        nearest.append(found.argmax(axis=1))
        lengths.append(length_class(pieces))
        cosines.append(np.maximum(found.max(axis=1), 0))

    for a, b in groups(texts):
        add(np.arange(a, b), points[a:b])
        for size in STARTS:
            of = np.array([i for i in range(a, b) if len(texts[i]) > size and has_letter(texts[i][:size])], dtype=int)
            if len(of):
                pieces = vectors([texts[i][:size] for i in of], idf)
                some = np.linalg.norm(pieces, axis=1) > 0
                add(of[some], pieces[some])
    nearest, lengths, cosines = map(np.concatenate, (nearest, lengths, cosines))
    out = np.zeros((len(centres), LENGTHS))
    for length in range(LENGTHS):
        here = lengths == length
        for c in range(len(centres)):
            members = here & (nearest == c)
            members = members if members.sum() >= MEMBERS else here
            # Without any text so long, the next shorter ones tell.
            before = out[c, length - 1] if length else 0.0
            out[c, length] = SLACK * np.quantile(cosines[members], QUANTILE) if members.any() else before
    return out


def train(documents: DataFrame, clusters: int = CLUSTERS, sample: int = SAMPLE) -> Model:
    training = documents.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    seen, n = _frequencies(training)
    if not n:
        return Model([], np.zeros((0, DIMS)), np.zeros((0, LENGTHS)), np.ones(DIMS))
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    # As many counts as languages; as literals they make the draw a filter of the scan, before any shuffle.
    counts = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], sample / r["n"])])
    some = drawn(training, share[F.col("lang")], 17).select("lang", "text")

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t.encode() for t in rows["text"].fillna("").sort_values()]
        points = np.concatenate([vectors(texts[a:b], idf) for a, b in groups(texts)])
        some = (np.linalg.norm(points, axis=1) > 0) & np.array([has_letter(t) for t in texts])
        texts, points = [t for t, ok in zip(texts, some) if ok], points[some]
        if not len(points):
            return pd.DataFrame({"lang": [], "least": [], "centroid": []})
        centres, own = _cluster(points, clusters)
        least = _bounds(texts, points, centres, own, idf)
        return pd.DataFrame({"lang": key[0], "least": least.tolist(), "centroid": [c.tolist() for c in centres]})

    fitted = some.groupBy("lang").applyInPandas(fit, "lang string, least array<double>, centroid array<float>")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], list(r["centroid"])))  # CLUSTERS rows a language
    return Model(
        [r["lang"] for r in rows],
        np.array([r["centroid"] for r in rows], dtype=np.float32).reshape(len(rows), DIMS),
        np.array([r["least"] for r in rows]).reshape(len(rows), LENGTHS),
        idf,
    )


def classify(documents: DataFrame, model: Model, names: tuple[str, ...] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``documents`` with the predicted language, its cosine and whether it is rejected; nothing is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            values = batch.column(0).cast(pa.binary()).to_pylist()
            names, scores, rejected = known.predict([v or b"" for v in values])
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]

        return work

    name, score, rejected = names
    return with_columns(documents, f"{name} string, {score} double, {rejected} boolean", make, ["text"])


def digest(documents: DataFrame) -> DataFrame:
    predicted = classify(documents.select("doc_id", "text"), train(documents))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(documents: DataFrame) -> DataFrame:
    """The rows whose language is known: rejected ones go; learns from the rows' own labels."""
    columns = [F.col(f"`{c}`") for c in documents.columns]
    names = tuple(free(documents, "_lang", "_score", "_rejected"))
    return classify(documents, train(documents), names).where(~F.col(names[2])).select(*columns)
