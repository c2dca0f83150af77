"""Pack tokenised documents into as few sequences as possible with a grouping genetic algorithm.

A document is its token ids and one separator id; documents longer than a sequence are cut, the shorter
piece first. Pieces are dealt at random to islands of about ISLAND pieces. Each island evolves a few packings of its
pieces (all start from best fit): crossover takes whole well-filled bins of one parent into the other,
removes the bins that hold the same pieces, and puts their other pieces, largest first, where they fit best;
the emptiest bins are broken up as well. Between epochs each island sends patterns of its perfectly
filled bins (lists of lengths) to the next island in the ring, where a packing is built from them. At last the bins
that are not full are dealt out once more, whole, and evolved again, so that the space left in bins of different
islands comes together.

An island never gets worse: its packing so far is part of its population. All randomness comes from the
island's number and the epoch, so a task that is run again gives the same packing.

Defined cases: a missing text is empty; an empty text is one piece, its separator; repeated rows are packed
each; a row without an id is packed like any other; equal lengths are ordered by id and piece; an empty table gives
no rows; further columns don't matter. Texts are tokenised whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import count_rows, stored

CAPACITY = 2048
SEPARATOR = 0
ISLAND = 4096
POPULATION, GENERATIONS, EPOCHS = 5, 12, 2
#: Patterns that an island sends on; bins at least this full are worth injecting.
ELITE, WELL_FILLED = 256, 0.98
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def tokenizer(model: str, ranks: str) -> Callable[[str], np.ndarray]:
    """Function from a text to its ids.

    ``model`` and ``ranks`` hold the same vocabulary. The ranks are much faster to apply; a text in which the
    special token is spelled out goes through the model, which knows it.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    full = Tokenizer.from_file(model)
    special = [t.content for t in full.get_added_tokens_decoder().values()]

    def ids(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")

    return ids


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces of a document; only the first may be shorter than the capacity."""
    first = len(ids) % capacity or min(len(ids), capacity)
    ends = [first, *range(first + capacity, len(ids) + 1, capacity)]
    return [(start, ids[start:end]) for start, end in zip([0, *ends], ends)]


def pieces(documents: DataFrame, capacity: int = CAPACITY, paths: tuple[str, str] | None = None) -> DataFrame:
    paths = paths or default_tokenizer()

    def run(batches):
        ids_of = tokenizer(*paths)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(ids_of(text.as_py() or ""), np.array([SEPARATOR], dtype="<u4"))
                for i, (start, part) in enumerate(cut(ids, capacity)):
                    rows.append((doc_id, i, start, len(part), zlib.crc32(part.tobytes())))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                arrays = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select("doc_id", "text").mapInArrow(run, PIECE)


class Island:
    """Packings of one island; a packing is the bin number of each piece."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: list[int]):
        self.lengths, self.capacity = lengths, capacity
        self.rng = np.random.default_rng(seed)

    def fill(self, bins: np.ndarray, n: int | None = None) -> np.ndarray:
        return np.bincount(bins, weights=self.lengths, minlength=n or 0).astype(np.int64)

    def fitness(self, bins: np.ndarray) -> tuple[int, float]:
        """Fewer bins first, then fuller ones."""
        fill = self.fill(bins)
        return -int((fill > 0).sum()), float(((fill / self.capacity) ** 2).sum())

    def best_fit(self, bins: np.ndarray, order: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Put the pieces in ``order`` into the fullest bin that takes each; ``used``: fill of the bins there are."""
        cap = self.capacity
        by_free: list[list[int]] = [[] for _ in range(cap + 1)]
        mask = 0
        for b in np.flatnonzero((used > 0) & (used < cap)).tolist():
            by_free[cap - used[b]].append(b)
        for free, own in enumerate(by_free):
            mask |= bool(own) << free
        new = len(used)
        for i, size in zip(order.tolist(), self.lengths[order].tolist()):
            fits = mask >> size
            if fits:
                free = size + (fits & -fits).bit_length() - 1
                b = by_free[free].pop()
                if not by_free[free]:
                    mask ^= 1 << free
            else:
                free, b, new = cap, new, new + 1
            bins[i] = b
            left = free - size
            if left:
                by_free[left].append(b)
                mask |= 1 << left
        return np.unique(bins, return_inverse=True)[1]

    def from_order(self, noise: float) -> np.ndarray:
        key = self.lengths * (1 + noise * self.rng.standard_normal(len(self.lengths)))
        order = np.argsort(-key, kind="stable")
        return self.best_fit(np.zeros(len(order), dtype=np.int64), order, np.zeros(0, dtype=np.int64))

    def from_patterns(self, patterns: list[list[int]]) -> np.ndarray:
        """Bins after the patterns that the own pieces can fill, the rest by best fit."""
        stock: dict[int, list[int]] = {}
        for i, size in enumerate(self.lengths.tolist()):
            stock.setdefault(size, []).append(i)
        bins = np.full(len(self.lengths), -1, dtype=np.int64)
        used = []
        for pattern in patterns:
            while True:
                taken: list[int] = []
                for size in pattern:
                    if stock.get(size):
                        taken.append(stock[size].pop())
                if len(taken) < len(pattern):
                    for i in taken:
                        stock[int(self.lengths[i])].append(i)
                    break
                bins[taken] = len(used)
                used.append(sum(pattern))
        rest = np.flatnonzero(bins < 0)
        rest = rest[np.argsort(-self.lengths[rest], kind="stable")]
        return self.best_fit(bins, rest, np.array(used, dtype=np.int64))

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        fill_a, fill_b = self.fill(a), self.fill(b)
        well = np.flatnonzero(fill_b >= WELL_FILLED * self.capacity)
        chosen = np.zeros(len(fill_b), dtype=bool)
        if len(well):
            chosen[self.rng.choice(well, max(1, int(len(well) * self.rng.uniform(0.05, 0.4))), replace=False)] = True
        injected = chosen[b]
        broken = np.zeros(len(fill_a), dtype=bool)
        broken[a[injected]] = True
        # The emptiest bins and a few others are broken up too, so that their space can be used anew.
        broken[np.argsort(fill_a, kind="stable")[: max(1, len(fill_a) // 50)]] = True
        broken[self.rng.choice(len(fill_a), max(1, len(fill_a) // 50))] = True
        displaced = np.flatnonzero(broken[a] & ~injected)
        child = np.where(injected, b + len(fill_a), a)
        settled = np.ones(len(a), dtype=bool)
        settled[displaced] = False
        used = np.bincount(
            child[settled], weights=self.lengths[settled], minlength=len(fill_a) + len(fill_b)
        ).astype(np.int64)
        order = displaced[np.argsort(-self.lengths[displaced], kind="stable")]
        return self.best_fit(child, order, used)

    def evolve(self, given: np.ndarray | None, patterns: list[list[int]]) -> np.ndarray:
        population = [self.from_order(0.0)]
        if given is not None:
            population.append(np.unique(given, return_inverse=True)[1])
        if patterns:
            population.append(self.from_patterns(patterns))
        while len(population) < POPULATION:
            population.append(self.from_order(0.03 * len(population)))
        scored = sorted(((self.fitness(p), i, p) for i, p in enumerate(population)), key=lambda x: x[:2], reverse=True)
        floor = -(-int(self.lengths.sum()) // self.capacity)
        for step in range(GENERATIONS):
            if -scored[0][0][0] <= floor:
                break
            i, j = self.rng.choice(len(scored), 2, replace=False)
            for x, y in ((i, j), (j, i)):
                child = self.cross(scored[x][2], scored[y][2])
                scored.append((self.fitness(child), POPULATION + 2 * step + (x == j), child))
            scored = sorted(scored, key=lambda x: (x[0], -x[1]), reverse=True)[:POPULATION]
        return scored[0][2]

    def elite(self, bins: np.ndarray) -> list[list[int]]:
        full = np.flatnonzero((self.fill(bins) == self.capacity) & (np.bincount(bins) > 1))
        if len(full) > ELITE:
            full = np.sort(self.rng.choice(full, ELITE, replace=False))
        chosen = np.isin(bins, full)
        rows = sorted(zip(bins[chosen].tolist(), (-self.lengths[chosen]).tolist()))
        patterns: dict[int, list[int]] = {}
        for b, size in rows:
            patterns.setdefault(b, []).append(-size)
        return sorted(patterns.values())


#: No nulls in the numbers: pandas would make floats of them. A pattern has length 0, a piece an empty pattern.
STATE = f"{PIECE}, has_id boolean, island long, bin long, pattern array<int>"


def _epoch(state: DataFrame, islands: int, epoch: int, capacity: int) -> DataFrame:
    """Evolve every island once; returns its pieces with their bins and the patterns for the next island."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        here = int(key[0])
        sent = rows["length"] == 0
        patterns = sorted({tuple(int(x) for x in p) for p in rows["pattern"][sent]})
        own = rows[~sent].sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        if not len(own):
            return own
        island = Island(own["length"].to_numpy(np.int64), capacity, [here, epoch])
        given = own["bin"].to_numpy(np.int64)
        bins = island.evolve(given if given.min() >= 0 else None, [list(p) for p in patterns])
        out = own.assign(island=here, bin=bins)
        elite = island.elite(bins)
        blank = {c: 0 for c in rows.columns} | {"has_id": False, "island": (here + 1) % islands}
        return pd.concat([out, pd.DataFrame([blank | {"pattern": p} for p in elite], columns=rows.columns)])

    return state.groupBy("island").applyInPandas(run, STATE)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, island: int = ISLAND) -> DataFrame:
    """``cut_pieces`` (stored, see ``pieces``) with sequence_id and offset."""
    whole = cut_pieces.where(F.col("length") == capacity)
    rest = cut_pieces.where(F.col("length") < capacity)
    islands = max(1, -(-count_rows(rest) // island))
    at = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(islands))
    empty = F.array().cast("array<int>").alias("pattern")
    known = rest.withColumn("has_id", F.col("doc_id").isNotNull()).fillna(0, "doc_id")
    state = known.select("*", at.alias("island"), F.lit(-1).cast("long").alias("bin"), empty)
    # The deal depends on where a row stands, so it is written before tasks can be run again.
    state = stored(state, "pack")
    for epoch in range(EPOCHS):
        state = stored(_epoch(state, islands, epoch, capacity), "pack")
    placed = state.where(F.col("length") > 0).drop("pattern")
    # Bins that are not full meet again: dealt whole to new islands, numbered anew to stay apart.
    fill = placed.groupBy("island", "bin").agg(F.sum("length").alias("_fill"), F.count(F.lit(1)).alias("_n"))
    number = F.col("island") * (1 << 32) + F.col("bin")
    loose = fill.where(F.col("_fill") < capacity).select("island", "bin")
    n_loose = fill.where(F.col("_fill") < capacity).agg(F.sum("_n").alias("n")).first()["n"] or 0
    again = max(1, -(-n_loose // island))
    apart = (
        placed.join(loose, ["island", "bin"], "left_semi")
        .withColumn("bin", number)
        .withColumn("island", F.pmod(F.xxhash64("bin"), F.lit(again)))
    )
    apart = stored(apart.select(*placed.columns, empty), "pack")
    evolved = stored(_epoch(apart, again, EPOCHS, capacity), "pack").where(F.col("length") > 0)
    # Sequence ids: two families of (island, bin), and one number for each piece that fills a sequence.
    done = placed.join(loose, ["island", "bin"], "left_anti").withColumn("sequence_id", number * 4)
    done = done.unionByName(evolved.drop("pattern").withColumn("sequence_id", number * 4 + 1))
    # A sequence holds at most ``capacity`` pieces, so its window is bounded.
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    done = done.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    done = done.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).select(*names)
    alone = whole.withColumn("sequence_id", F.monotonically_increasing_id() * 4 + 2)
    return done.unionByName(alone.withColumn("offset", F.lit(0).cast("long")).select(*names))


def digest(documents: DataFrame) -> DataFrame:
    return pack(stored(pieces(documents), "pieces"))
