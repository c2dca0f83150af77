"""Approximate nearest neighbours with forests of random-projection trees.

Vectors are dealt into blocks of about ROWS rows. Every block gets a forest of TREES trees, each of which halves its rows at
the median of their projection on the line between two centres of a random few rows, down to leaves of LEAF
rows. The forests are written once as a table; every row is in every tree of its block. A query descends all
trees of a block through one priority queue: the next branch is the one whose path, in whichever tree, crossed
the nearest hyperplanes. It stops when its leaves hold BUDGET of the block's rows. These candidates are ranked
by their exact distance, and the blocks' best rows are merged.

Queries meet forests in pairs of bounded blocks, so a task holds one block of either.

Defined cases: vectors that are missing, empty, zero or hold a missing or non-finite component take no part, nor do
rows without an id; vectors meet those of their own length only; a query's own row is its own id, so repeated
ids don't find each other; equal vectors always share a leaf, and ties go to the smaller id; of a block of at most 4 * K rows
all are ranked; an empty table, or one without queries, gives no rows; further columns don't
matter.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import count_rows, stored
from parceltrail.llm.vectors import clean, merged

EVERY, K = 100, 10
ROWS, QUERIES = 8192, 1024
TREES, LEAF = 32, 64
#: Rows of a block that a query ranks exactly: this share; in small blocks so many, but no more than a share of them.
BUDGET, LEAST, MOST = 0.4, 1024, 0.75


class Forest:
    """Trees over one block. Node i of a tree has a normal, an offset and two children; leaves are -1 - leaf."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[tuple[int, int]] = []
        self.leaves: list[np.ndarray] = []
        self.roots = [self._grow(vectors, np.arange(len(vectors)), leaf, rng) for _ in range(trees)]

    def _grow(self, vectors: np.ndarray, rows: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        cut = self._cut(vectors, rows, rng) if len(rows) > leaf else None
        if cut is None:
            self.leaves.append(rows)
            return -len(self.leaves)
        normal, offset, right = cut
        node = len(self.normals)
        self.normals.append(normal)
        self.offsets.append(offset)
        self.children.append((0, 0))
        self.children[node] = (
            self._grow(vectors, rows[~right], leaf, rng),
            self._grow(vectors, rows[right], leaf, rng),
        )
        return node

    @staticmethod
    def _cut(vectors: np.ndarray, rows: np.ndarray, rng: np.random.Generator):
        """A hyperplane that leaves rows on both sides; None if a few tries find all rows equal."""
        for _ in range(4):
            few = vectors[rng.choice(rows, min(len(rows), 64), replace=False)]
            near = ((few - few[0]) ** 2).sum(axis=1) < ((few - few[-1]) ** 2).sum(axis=1)
            if near.all() or not near.any():
                continue
            normal = few[~near].mean(axis=0) - few[near].mean(axis=0)
            size = np.linalg.norm(normal)
            if not size > 0:
                continue
            normal /= size
            # The matrix product rounds by position; equal vectors must get equal projections.
            at = np.einsum("ij,j->i", vectors[rows], normal)
            middle = np.median(at)
            right = at > middle
            if right.any():
                return normal, float(middle), right
            right = at >= middle
            if not right.all():
                return normal, float(np.nextafter(middle, -np.inf)), right
        return None

    def candidates(self, margins: np.ndarray, enough: int) -> np.ndarray:
        """Rows of the leaves nearest to a query; ``margins``: its signed distances to all hyperplanes."""
        margins = margins.tolist()
        queue = [(0.0, root) for root in self.roots]
        heapq.heapify(queue)
        seen: set[int] = set()
        while queue and len(seen) < enough:
            far, node = heapq.heappop(queue)
            while node >= 0:
                margin = margins[node]
                left, right = self.children[node]
                near, other = (right, left) if margin > 0 else (left, right)
                heapq.heappush(queue, (far + margin * margin, other))
                node = near
            seen.update(self.leaves[-1 - node].tolist())
        return np.fromiter(seen, dtype=np.int64, count=len(seen))

    def search(self, vectors, ids, queries, query_ids, k: int, budget: float = BUDGET, least: int = LEAST):
        """(query, vector, distance) of the k nearest candidates for every query."""
        found = []
        enough = max(4 * k, int(budget * len(vectors)), min(least, int(MOST * len(vectors))))
        everything = np.arange(len(vectors))
        normals = np.array(self.normals).reshape(len(self.normals), vectors.shape[1])
        for a in range(0, len(queries), 64):
            margins = queries[a : a + 64] @ normals.T - np.array(self.offsets)
            for q, own, margin in zip(queries[a : a + 64], query_ids[a : a + 64], margins):
                rows = everything if enough >= len(vectors) else self.candidates(margin, enough)
                rows = rows[ids[rows] != own]
                distances = np.sqrt(((vectors[rows] - q) ** 2).sum(axis=1))
                # Ids break ties, so ranking goes by both.
                best = np.lexsort((ids[rows], distances))[:k]
                found += [(int(own), int(i), float(d)) for i, d in zip(ids[rows[best]], distances[best])]
        return found


def build(vectors: DataFrame, blocks: int, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """One row for each block: its ids, vectors and forest as bytes."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        x, ids = np.stack(rows["v"]), rows["vec_id"].to_numpy(np.int64)
        forest = Forest(x, trees, leaf, seed=int(key[1]))
        body = pickle.dumps((x, ids, forest))
        return pd.DataFrame({"dims": [key[0]], "block": [key[1]], "body": [body]})

    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block")
    dealt = vectors.select("dims", block, "vec_id", "v")
    return dealt.groupBy("dims", "block").applyInPandas(run, "dims int, block int, body binary")


def nearest(
    embeddings: DataFrame, every: int = EVERY, k: int = K, rows: int = ROWS, queries: int = QUERIES,
    budget: float = BUDGET, least: int = LEAST,
) -> DataFrame:
    """query_id, rank, vec_id, score (distance) for the rows whose id is divisible by ``every``."""
    some = F.exists("embedding", lambda x: x != 0)
    whole = clean(embeddings).where(some).select("vec_id", F.col("embedding").alias("v"))
    whole = stored(whole.withColumn("dims", F.size("v")), "vectors")
    asked = whole.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, -(-count_rows(whole) // rows))
    query_blocks = max(1, -(-count_rows(asked) // queries))
    forests = stored(build(whole, blocks), "forests")
    # A forest is one row; it goes once to each block of queries.
    left = forests.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    query_block = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(query_blocks)).cast("int").alias("query_block")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    right = asked.select("dims", query_block, every_block, "vec_id", "v")

    def run(forest: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(forest) and len(wanted):
            x, ids, trees = pickle.loads(forest["body"].iloc[0])
            found = trees.search(x, ids, np.stack(wanted["v"]), wanted["vec_id"].to_numpy(np.int64), k, budget, least)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    key = ["dims", "block", "query_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        run, "query_id long, vec_id long, score double"
    )
    return merged(found, k, F.asc("score"))


def digest(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings)
