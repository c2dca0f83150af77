"""Exact top-k by inner product with vector-approximation files.

Components become integers, floor(SCALE * x). Vectors are dealt into blocks of about ROWS rows and the queries into blocks
of about QUERIES; every pair of blocks is one small task. It quantises its vectors to CELLS cells a dimension (the
approximation file), scans the cells for an upper bound of every score, and reads exact vectors in the order of their
bounds until the kth score is above the next bound. So the result is exact whatever the data, and
a task holds two bounded blocks.

All queries meet all vectors, as an exact search has to, but as blocks: a task returns its k best rows for each query.

Defined cases: vectors that are missing, empty or hold a missing or non-finite component take no part, nor do rows
without an id; vectors are compared with those of their own length only; a query's own row is its own id, so
repeated ids don't find each other; repeated rows of one candidate stand for themselves; ties go to the smaller
id; an empty table, or one without queries, gives no rows; a score beyond a long fails the query, as the
contract's type can't hold it; further columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import count_rows, stored
from parceltrail.llm.vectors import clean, merged

SCALE = 256
EVERY, K = 50, 5
ROWS, QUERIES = 8192, 1024
CELLS = 16
#: Exact vectors read at a time, for a query.
STEP = 32
#: Integers that doubles hold exactly.
_EXACT = float(1 << 53)


def approximate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The file: the cell of every component, and the cells' CELLS + 1 bounds in each dimension."""
    low, high = x.min(axis=0), x.max(axis=0)
    bounds = np.floor(low + (high - low) * np.linspace(0, 1, CELLS + 1)[:, None])
    bounds[0], bounds[-1] = low, high
    cells = np.zeros(x.shape, dtype=np.uint8)
    for d in range(x.shape[1]):
        cells[:, d] = np.clip(np.searchsorted(bounds[:, d], x[:, d], side="right") - 1, 0, CELLS - 1)
    return cells, bounds


def upper_bounds(q: np.ndarray, cells: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every query and vector a score that the true one can't exceed."""
    dims = np.arange(cells.shape[1])
    low, high = bounds[cells, dims], bounds[cells.astype(np.int64) + 1, dims]
    # Both products are exact: the integers and their sums stay below 2^53 (checked by the caller).
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the k best vectors of the block for every query; ties to smaller ids."""
    most = np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1]
    if not most < _EXACT:
        return _wide_block(queries, query_ids, vectors, ids, k)
    cells, bounds = approximate(vectors)
    found = []
    for a in range(0, len(queries), 128):
        upper = upper_bounds(queries[a : a + 128], cells, bounds)
        for q, own, bound in zip(queries[a : a + 128], query_ids[a : a + 128], upper):
            order = np.argsort(-bound, kind="stable")
            order = order[ids[order] != own]
            best: list[tuple[int, int]] = []
            for at in range(0, len(order), STEP):
                # Equal bounds may hide an equal score with a smaller id, so only a lower bound ends the search.
                if len(best) == k and -best[-1][0] > bound[order[at]]:
                    break
                near = order[at : at + STEP]
                scores = vectors[near] @ q
                best = sorted(best + [(-int(s), int(i)) for s, i in zip(scores, ids[near])])[:k]
            found += [(int(own), i, -s) for s, i in best]
    return found


def _wide_block(queries, query_ids, vectors, ids, k):
    """The same for integers that doubles can't add exactly: Python's, without approximation."""
    found = []
    vectors = [[int(c) for c in v] for v in vectors.tolist()]
    for q, own in zip(queries.tolist(), query_ids.tolist()):
        q = [int(c) for c in q]
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for v, i in zip(vectors, ids.tolist()) if i != own)
        found += [(own, i, -s) for s, i in best[:k]]
    return found


def top_k(embeddings: DataFrame, every: int = EVERY, k: int = K, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    whole = clean(embeddings).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * SCALE).cast("double")).alias("v")
    )
    whole = stored(whole.withColumn("dims", F.size("v")), "vectors")
    asked = F.pmod("vec_id", F.lit(every)) == 0
    blocks = max(1, -(-count_rows(whole) // rows))
    query_blocks = max(1, -(-count_rows(whole.where(asked)) // queries))
    # Blocks hold rows of any id and of one length; equal vectors spread like any others.
    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(query_blocks)).cast("int")
    every_query_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = whole.select("dims", block.alias("block"), every_query_block.alias("query_block"), "vec_id", "v")
    right = whole.where(asked).select(
        "dims", every_block.alias("block"), query_block.alias("query_block"), "vec_id", "v"
    )

    def run(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vectors) and len(wanted):
            found = search_block(
                np.stack(wanted["v"]), wanted["vec_id"].to_numpy(), np.stack(vectors["v"]), vectors["vec_id"].to_numpy(), k
            )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    key = ["dims", "block", "query_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(run, "query_id long, vec_id long, score long")
    return merged(found, k, F.desc("score"))


def digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings)
