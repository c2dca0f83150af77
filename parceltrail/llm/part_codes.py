"""Compress vectors to codes: each of PARTS consecutive parts of a vector becomes the number of its nearest codebook entry.

Components become integers, floor(SCALE * x), so that every distance and mean is exact. The codebook of a position starts
as that part of the first ENTRIES vectors by id. Each of ROUNDS rounds assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower number) and replaces an entry by the mean of its parts, rounded down; an entry
without parts stays. Then the parts are assigned once more.

The nearest entries are found on a trie. The distinct parts of a position, with their counts, are sorted; a node of the trie
is a run of them with a common prefix, and holds the distances of that prefix to all entries. The trie is walked depth first:
a child adds the squares of its one component to its parent's distances, so parts that begin alike share that
work. A leaf is one distinct part: it takes the least distance, and its count weighs what it adds to its entry's mean.

On Spark the distinct parts are one table, dealt and sorted by range, and each task walks the trie of its run. A round sends back
sums for each (position, entry, component): the codebooks' size, whatever the table's. A vector that makes up a
third of the table is one distinct part in each position.

Defined cases: vectors that are missing or hold a missing or non-finite component are dropped; the codebooks have the length
of the first vector, and a vector of another length gets no code and no error (null); a length that PARTS does not divide
makes the first parts one longer; empty vectors have distance 0; fewer vectors than ENTRIES give as many entries; rows without
an id come last in the order and are coded like any other, and so is each of the rows that share an id (ordered by their
vectors); rows without a label are one label; an empty table gives no rows; further columns don't matter. A component
whose integer exceeds a long fails the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Parts in one trie, and nodes that are expanded at a time.
ROWS, WIDTH = 1 << 16, 1 << 12


def _finite(vector: str) -> Column:
    """Not missing, and no component missing or without a finite value."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _bounds(length: int, parts: int) -> list[tuple[int, int]]:
    """Begin and end of each part of a vector."""
    short, longer = divmod(length, parts)
    ends = [short * (p + 1) + min(p + 1, longer) for p in range(parts)]
    return list(zip([0, *ends[:-1]], ends))


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as longs if their squared distances fit, else as Python's integers."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    fits = 4 * most * most * max(1, arrays[0].shape[1]) < 1 << 62
    return [a.astype(np.int64 if fits else object) for a in arrays]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry of each of the distinct, sorted ``parts``."""
    parts, entries = _exact(parts, entries)
    (n, width), k = parts.shape, len(entries)
    codes, far = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=parts.dtype)
    # Nodes: component, begin and end of their runs, distances of their prefix to all entries.
    todo = [(0, np.zeros(1, dtype=np.int64), np.full(1, n), np.zeros((1, k), dtype=parts.dtype))] if n else []
    while todo:
        depth, begin, end, distances = todo.pop()
        if len(begin) > WIDTH:
            for half in (slice(WIDTH, None), slice(WIDTH)):
                todo.append((depth, begin[half], end[half], distances[half]))
            continue
        if depth == width:
            codes[begin] = best = distances.argmin(axis=1)
            far[begin] = distances[np.arange(len(best)), best]
            continue
        sizes = end - begin
        node = np.repeat(np.arange(len(begin)), sizes)
        rows = np.arange(len(node)) + np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        values = parts[rows, depth]
        first = np.ones(len(rows), dtype=bool)
        first[1:] = (node[1:] != node[:-1]) | (values[1:] != values[:-1])
        child, parent = rows[first], node[first]
        ends = np.append(child[1:], 0)
        last = np.append(parent[1:] != parent[:-1], True)
        ends[last] = end[parent[last]]
        step = values[first][:, None] - entries[None, :, depth]
        todo.append((depth + 1, child, ends, distances[parent] + step * step))
    return codes, far


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, sorted, and the number of each row's own among them."""
    n, width = parts.shape
    order = np.lexsort(parts.T[::-1]) if width else np.arange(n)
    rows = parts[order]
    first = np.zeros(n, dtype=bool)
    first[:1] = True
    first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    own = np.empty(n, dtype=np.int64)
    own[order] = np.cumsum(first) - 1
    return rows[first], own


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


Codebooks = list[np.ndarray]


def integers(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, vector (longs) of the rows that take part."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return embeddings.where(_finite("embedding")).select("vec_id", "label", whole.alias("vector"))


def _first(vectors: DataFrame, entries: int) -> list[list[int]]:
    """The first vectors by id that have the length of the very first."""
    order = [F.asc_nulls_last("vec_id"), "vector"]
    first = vectors.orderBy(*order).select("vector").limit(1).collect()
    if not first:
        return []
    same = vectors.where(F.size("vector") == len(first[0][0]))
    return [r[0] for r in same.orderBy(*order).select("vector").limit(entries).collect()]


def _parts(vectors: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """position, part, n of the distinct parts: written, each file a sorted run."""
    pieces = [F.struct(F.lit(p).alias("position"), F.slice("vector", a + 1, b - a).alias("part")) for p, (a, b) in enumerate(bounds)]
    rows = vectors.where(F.size("vector") == bounds[-1][1]).select(F.explode(F.array(*pieces)).alias("piece")).select("piece.*")
    counted = rows.groupBy("position", "part").agg(F.count(F.lit(1)).alias("n"))
    key = ["position", "part"]
    return stored(counted.repartitionByRange(*key).sortWithinPartitions(*key), "parts")


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """position, entry, component, total: weighted sums of a task's parts; component -1 has their number."""
    totals = [np.zeros((len(b), b.shape[1] + 1), dtype=object) for b in books]

    def walk(rows: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(rows)
        positions = table.column("position").to_numpy()
        for p in np.unique(positions):
            own = table.filter(pa.array(positions == p)).combine_chunks()
            parts = _matrix(own.column("part").chunk(0), books[p].shape[1])
            # Runs of several files may follow each other in one task.
            sorted_parts, place = _distinct(parts)
            weights = np.zeros(len(sorted_parts), dtype=np.int64)
            np.add.at(weights, place, own.column("n").to_numpy())
            codes, _ = nearest(sorted_parts, books[p])
            # Halves of the components keep the products below a long.
            for part, total in ((sorted_parts >> 31, 1 << 31), (sorted_parts & ((1 << 31) - 1), 1)):
                sums = np.zeros(books[p].shape, dtype=np.int64)
                np.add.at(sums, codes, part * weights[:, None])
                totals[p][:, 1:] += sums.astype(object) * total
            counts = np.zeros(len(books[p]), dtype=np.int64)
            np.add.at(counts, codes, weights)
            totals[p][:, 0] += counts

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS:
            walk(held)
            held = []
    if sum(b.num_rows for b in held):
        walk(held)
    found = [
        (p, e, c - 1, Decimal(int(total[e, c])))
        for p, total in enumerate(totals)
        for e in range(len(total))
        if total[e, 0]
        for c in range(total.shape[1])
    ]
    columns = list(zip(*found)) or [()] * 4
    types = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["position", "entry", "component", "total"]
    )


def _better(parts: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round. The driver gets as many sums as the codebooks have components."""
    schema = "position int, entry int, component int, total decimal(38,0)"
    sums = parts.mapInArrow(lambda batches: _sums(batches, books), schema)
    totals: dict = {}
    for r in sums.groupBy("position", "entry", "component").agg(F.sum("total").alias("total")).collect():
        totals.setdefault((r.position, r.entry), {})[r.component] = int(r.total)
    books = [b.copy() for b in books]
    for (p, e), total in totals.items():
        for c in range(books[p].shape[1]):
            books[p][e, c] = total[c] // total[-1]
    return books


def train(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """A codebook for each position from vectors of integers (``integers``, written); none without vectors."""
    first = _first(vectors, entries)
    if not first:
        return []
    bounds = _bounds(len(first[0]), parts)
    books = [np.array([v[a:b] for v in first], dtype=np.int64).reshape(len(first), b - a) for a, b in bounds]
    pieces = _parts(vectors, bounds)
    for _ in range(rounds):
        books = _better(pieces, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error of every row of ``vectors``; each batch is a trie for each position."""
    bounds = _bounds(sum(b.shape[1] for b in books), len(books)) if books else []
    length = bounds[-1][1] if bounds else 0
    digits = np.array([f"{e:02x}" for e in range(max([1, *map(len, books)]))], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            fits = column.value_lengths().to_numpy(zero_copy_only=False) == length
            matrix = _matrix(column.filter(pa.array(fits)), length)
            texts, error = np.full(len(matrix), "", dtype=object), np.zeros(len(matrix), dtype=object)
            for (a, b), book in zip(bounds, books):
                distinct, own = _distinct(matrix[:, a:b])
                codes, far = nearest(distinct, book)
                texts, error = texts + digits[codes][own], error + far[own]
            code, total = np.full(len(fits), None, dtype=object), np.full(len(fits), None, dtype=object)
            code[fits], total[fits] = texts, error
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(total, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return vectors.mapInArrow(run, schema)


def checksum(books: Codebooks) -> str:
    """Hash of all components as decimal text, by position, entry and component."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()


def compress(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every vector that takes part."""
    vectors = stored(integers(embeddings, scale), "integers")
    books = train(vectors, parts, entries, rounds)
    coded = stored(encode(vectors, books), "codes")
    # One label may hold a third of the rows: sums meet the rows in a join that adaptive execution can split.
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    sums = stored(sums, "label-errors")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return joined.withColumn("codebooks_sha256", F.lit(checksum(books)))


def digest(embeddings: DataFrame) -> DataFrame:
    return compress(embeddings).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
