"""SimHash fingerprints, linked by a self-join of binary tries.

The fingerprint of a text has a bit for each bit of XXH64 (seed 42): set if more than half of the text's
3-word shingles have it set. Distinct fingerprints within MAX_BITS differing bits are linked; a class is what
links reach.

The join: a link of at most 3 differing bits has one of the four 16-bit blocks equal. Four tries
hold every fingerprint, each with another block leading, and are cut below that block: a subtrie holds the
fingerprints with an equal block and goes to one task as a sorted run (a sorted run is a trie: a node is a range with
a common prefix). Within it node pairs descend together, bit by bit; a pair collects the bits in which
its paths differ and is dropped when they exceed the budget. A subtrie with more than MOST
fingerprints is cut further: below its next SUB bits, and pairs of these nodes within the budget become
tasks of their own, so that all pairs within reach still meet.

A task doesn't return all pairs: it unites what its pairs link and returns one link for each
fingerprint at most. Copies share a fingerprint, so thousands of copies are one trie leaf.

Defined cases: a missing or empty text, or one of blanks only, has the fingerprint zero and is linked like any
other; fewer than three words form one shingle; rows with equal ids are rows of their own, each with the class of its
text, and ``keep_first`` keeps one of those that it would keep; a row without an id has no component (null), links
nothing and is kept; an empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parceltrail.llm.common import free, stored, text_bytes, with_columns
from parceltrail.llm.components import components

SHINGLE, SEED, MAX_BITS = 3, 42, 3
BITS, BLOCK = 64, 16
#: Fingerprints of a subtrie that one task may hold, and the bits below which larger ones are cut.
MOST, SUB = 200_000, 8
#: Node pairs that a task expands at a time, rows that it gathers before it starts.
PAIRS, ROWS = 1 << 20, 200_000

_hash = partial(xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    # bytes.lower() and bytes.split() know ASCII only: A-Z and the blanks \x20, \x09-\x0D.
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(_hash, shingles), dtype=np.uint64)
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = votes * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())


def with_fingerprint(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``documents`` with _fingerprint, its 64 bits as a long."""

    def make():
        return lambda batch: [_signed([fingerprint(t, shingle) for t in text_bytes(batch)])]

    return with_columns(documents, "_fingerprint long", make, ["text"])


def _split(lo: np.ndarray, hi: np.ndarray, ones_before: np.ndarray) -> np.ndarray:
    """Where the ones of a node's next bit start; ``ones_before``: running count of that bit."""
    return hi - (ones_before[hi] - ones_before[lo])


class Union:
    """Classes of the numbers below n."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            self.root = root


def trie_links(
    prints: np.ndarray, starts: list[tuple[np.ndarray, ...]], depth: int, budget: int, union: Union
) -> None:
    """Unite all rows of ``prints`` within the budget.

    ``prints``: distinct within a node, sorted in each node. ``starts``: node pairs (low and high end of either node, bits
    that differ so far); equal nodes mean a pair of a node with itself. ``depth``: bits already descended.
    """
    todo = [(depth, starts)]
    while todo:
        bit, (alo, ahi, blo, bhi, far) = todo.pop()
        if not len(alo):
            continue
        if len(alo) > PAIRS:
            half = len(alo) // 2
            todo += [(bit, tuple(x[half:] for x in (alo, ahi, blo, bhi, far)))]
            alo, ahi, blo, bhi, far = (x[:half] for x in (alo, ahi, blo, bhi, far))
            todo += [(bit, (alo, ahi, blo, bhi, far))]
            continue
        # Two leaves: their remaining bits decide at once.
        own = (alo == blo) & (ahi == bhi)
        leaves = ~own & (ahi - alo == 1) & (bhi - blo == 1)
        if leaves.any():
            a, b = alo[leaves], blo[leaves]
            near = np.bitwise_count(prints[a] ^ prints[b]) <= budget
            union.link(a[near], b[near])
        go = ~leaves & ~(own & (ahi - alo == 1))
        alo, ahi, blo, bhi, far, own = (x[go] for x in (alo, ahi, blo, bhi, far, own))
        if bit == BITS or not len(alo):
            continue
        ones = np.concatenate([[0], np.cumsum((prints >> np.uint64(BITS - 1 - bit)) & np.uint64(1), dtype=np.int64)])
        am, bm = _split(alo, ahi, ones), _split(blo, bhi, ones)
        cross = ~own
        parts = [
            (alo, am, blo, bm, far),
            (am, ahi, bm, bhi, far),
            (alo, am, bm, bhi, far + 1),
            (am[cross], ahi[cross], blo[cross], bm[cross], far[cross] + 1),
        ]
        alo, ahi, blo, bhi, far = (np.concatenate(x) for x in zip(*parts))
        keep = (ahi > alo) & (bhi > blo) & (far <= budget)
        todo.append((bit + 1, tuple(x[keep] for x in (alo, ahi, blo, bhi, far))))


def _join_runs(block: np.ndarray, sub: np.ndarray, prints: np.ndarray, ids: np.ndarray, budget: int):
    """Links (a, b) of ids from whole subtries: rows sorted by block, sub and turned fingerprint."""
    n = len(prints)
    new = np.ones(n, dtype=bool)
    new[1:] = (block[1:] != block[:-1]) | (sub[1:] != sub[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], n)
    # A task for two nodes has two prefixes: the rows of the second start where the prefix changes.
    pair = sub[lo] >> SUB != sub[lo] & ((1 << SUB) - 1)
    prefix = (prints >> np.uint64(BITS - BLOCK - SUB)) & np.uint64((1 << SUB) - 1)
    turns = np.concatenate([[0], np.cumsum(prefix[1:] != prefix[:-1])])
    union = Union(n)
    own_lo, own_hi = lo[~pair], hi[~pair]
    trie_links(prints, (own_lo, own_hi, own_lo, own_hi, np.zeros(len(own_lo), dtype=np.int64)), BLOCK, budget, union)
    if pair.any():
        plo, phi = lo[pair], hi[pair]
        both = turns[plo] != turns[phi - 1]
        plo, phi = plo[both], phi[both]
        mid = np.searchsorted(turns, turns[plo] + 1)
        far = np.bitwise_count(prefix[plo] ^ prefix[mid]).astype(np.int64)
        trie_links(prints, (plo, mid, mid, phi, far), BLOCK + SUB, budget, union)
    moved = np.flatnonzero(union.root != np.arange(n))
    return ids[moved], ids[union.root[moved]]


def _join_task(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    held: list[list[np.ndarray]] = []

    def flush(rows: list[np.ndarray]):
        a, b = _join_runs(rows[0], rows[1], rows[2].view(np.uint64), rows[3], budget)
        # Rows of equal fingerprints can't occur in a subtrie, so each link joins two of them.
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        if sum(len(h[0]) for h in held) >= ROWS:
            rows = [np.concatenate(x) for x in zip(*held)]
            # The last subtrie may go on in the next batch.
            last = (rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])
            cut = int(last.nonzero()[0][-1]) + 1 if last.any() else 0
            if cut:
                yield flush([x[:cut] for x in rows])
            held = [[x[cut:] for x in rows]]
    if held and len(held[-1][0]):
        yield flush([np.concatenate(x) for x in zip(*held)])


def _turned(blocks: int):
    """The fingerprint with its first ``blocks`` blocks moved to the end."""
    if not blocks:
        return F.col("fingerprint")
    low = F.shiftrightunsigned("fingerprint", BITS - blocks * BLOCK)
    return F.shiftleft("fingerprint", blocks * BLOCK).bitwiseOR(low)


def links(prints: DataFrame, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """Links (a, b) that connect all of ``prints`` (fingerprint: distinct) within ``max_bits``."""
    if max_bits >= BITS // BLOCK:
        raise ValueError(f"at most {BITS // BLOCK - 1} bits: one of {BITS // BLOCK} blocks has to be equal")
    turned = [
        F.struct(
            F.lit(r).alias("trie"),
            _turned(r).alias("print"),
        )
        for r in range(BITS // BLOCK)
    ]
    rows = prints.select("fingerprint", F.explode(F.array(*turned)).alias("t")).select(
        "fingerprint",
        F.col("t.print").alias("print"),
        (F.shiftrightunsigned("t.print", BITS - BLOCK) * (BITS // BLOCK) + F.col("t.trie")).alias("block"),
    )
    # Subtries above the size that a task may hold; none unless the data has them.
    large = rows.groupBy("block").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    large = large.select(F.col("block").alias("_block"))
    rows = rows.join(large, F.col("block") == F.col("_block"), "left")
    near = [m for m in range(1 << SUB) if bin(m).count("1") <= max_bits]
    prefix = F.shiftrightunsigned("print", BITS - BLOCK - SUB).bitwiseAND(F.lit((1 << SUB) - 1))
    pairs = F.transform(
        F.array(*[F.lit(m) for m in near]),
        lambda m: F.shiftleft(F.least(prefix, prefix.bitwiseXOR(m)), SUB) + F.greatest(prefix, prefix.bitwiseXOR(m)),
    )
    whole = F.array(F.lit(0).cast("long"))
    rows = rows.withColumn("sub", F.explode(F.when(F.col("_block").isNull(), whole).otherwise(pairs)))
    rows = rows.select("block", "sub", "print", "fingerprint").repartition("block", "sub")
    # Unsigned order within a subtrie: the leading block is equal, so only its first bit could matter.
    return rows.sortWithinPartitions("block", "sub", "print").mapInArrow(
        lambda batches: _join_task(batches, max_bits), "a long, b long"
    )


def classes(documents: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, *carried: Column) -> DataFrame:
    """doc_id, _fingerprint, component_id, _root (the class as a fingerprint) and ``carried`` of every row."""
    slim = documents.select("doc_id", "text", *carried)
    more = slim.columns[2:]
    prints = stored(with_fingerprint(slim, shingle).drop("text"), "fingerprints")
    # A node for each fingerprint, with its smallest id; copies fall together before the shuffle.
    nodes = stored(
        prints.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("_fingerprint").alias("fingerprint"))
        .agg(F.min("doc_id").alias("id")),
        "nodes",
    )
    found = stored(components(links(nodes, max_bits)), "found")
    linked = nodes.join(found, F.col("fingerprint") == F.col("node"), "left")
    least = linked.where(F.col("node").isNotNull()).groupBy("component").agg(F.min("id").alias("_least"))
    # A component's name is one of its fingerprints, which is not among the nodes that moved.
    own = nodes.select(F.col("fingerprint").alias("_root"), F.col("id").alias("_own"))
    least = least.join(own, F.col("component") == F.col("_root")).select(
        F.col("component").alias("_root"), F.least("_least", "_own").alias("_least")
    )
    named = linked.withColumn("_at", F.coalesce("component", "fingerprint")).join(
        least, F.col("_at") == F.col("_root"), "left"
    )
    named = stored(
        named.select(
            F.col("fingerprint").alias("_print"),
            F.coalesce("_least", "id").alias("component_id"),
            F.col("_at").alias("_root"),
        ),
        "classes",
    )
    joined = prints.join(named, F.col("_fingerprint") == F.col("_print"), "left")
    return joined.select(
        "doc_id",
        "_fingerprint",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        "_root",
        *more,
    )


def digest(documents: DataFrame) -> DataFrame:
    return classes(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("_fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(documents: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """``documents`` without all but one row of each class: a row whose id names the class.

    Rows are decided on by id and text, as an id may stand in several classes. Where a class holds several texts
    with its smallest id, the one with the least hash stays; of its repeated rows one stays. Rows without an id stay.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    key, text, count = free(documents, "_id", "_hash", "_n")
    content = F.xxhash64("text")
    found = stored(classes(documents, max_bits, shingle, content.alias(text)).drop("_fingerprint"), "decided")
    # Equal texts have one fingerprint, so an id and a text are in one class only.
    pairs = (
        found.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias(key), text)
        .agg(F.count(F.lit(1)).alias(count), F.first("component_id").alias("_class"), F.first("_root").alias("_root"))
    )
    pairs = stored(pairs, "pairs")
    named = pairs.where(F.col(key) == F.col("_class"))
    first = named.groupBy("_root", key).agg(F.min(text).alias(text)).select(key, text)
    gone = pairs.join(first, [key, text], "left_anti").select(key, text)
    many = named.where(F.col(count) > 1).join(first, [key, text], "left_semi").select(key, text)
    same = lambda rows: (F.col("doc_id") == F.col(key)) & (content == rows[text])
    rows = documents.join(gone, same(gone), "left_anti")
    # Repeated rows are rare: mostly ``many`` is empty and its branch falls away at run time.
    single = rows.join(many, same(many), "left_anti").select(*columns)
    # Rows may differ in other columns; their hash decides, so that every run keeps the same one.
    comparable = [F.col(f"`{f.name}`") for f in documents.schema if "map<" not in f.dataType.simpleString()]
    again = documents.join(many, same(many), "left_semi").groupBy(F.col("doc_id").alias(key), content.alias(text))
    again = again.agg(F.min_by(F.struct(*columns), F.xxhash64(*comparable)).alias("_row")).select("_row.*")
    return single.unionByName(again)
