"""Merkle manifest of a dataset: a hash tree over its rows, and proofs that a changed row is noticed.

A leaf is the SHA-256 of a row's fields, each with its length. The leaves of a language, in the order of doc_id, are hashed
in runs of FAN until one node is left (its subroot); the subroots, in the order of their languages, go on in the same way to
the root. All digests are lowercase hex text, and a parent hashes the text of its children one after the other.

The tree keeps midstates: while a parent hashes its children it copies the hash state before each child slot. To
replace a child, folding takes up the copy at its slot and hashes the replacement and the right siblings only; what lies
to the left is never hashed again. So a changed row costs one resumed state for each level.

On Spark a block of FAN^LEVELS neighbouring nodes is the unit of work. Upwards, each block becomes one node, and these nodes
are the next table, until every language has one; a table is FAN^LEVELS times smaller than the one below. Downwards, each
block meets one row: the siblings on the way from the block to the root. A task then builds the block's parents with their
states and folds its rows through the block and along that way. Blocks are of equal size whatever the
languages are, so one that holds a third of the rows is many blocks.

Defined cases: a missing field is "-" in the leaf; rows without a language are a language of their own, the first; rows
without an id come first in their language and are never tampered with, as they have no decimal id; rows that
share an id follow each other by their leaves, equal rows in any order, as their leaves are equal; a language of one
row has its leaf as subroot, and a table of one language the subroot as root; an empty table gives no rows; texts of
any length are hashed whole by Spark; further columns don't matter.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import id_crc, numbered, stored

#: Children of a parent, levels of a block, rows that are tampered with: those whose crc32 is divisible by EVERY.
FAN, LEVELS, EVERY = 8, 4, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Parent:
    """A node with the digests of its children and the hash state before each of them."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]):
        state, self.states = sha256(), []
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.children = children
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """The digest with another child at ``slot``: the state there goes on with it and the right siblings."""
        state = self.states[slot].copy()
        state.update(replacement)
        state.update(b"".join(self.children[slot + 1 :]))
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot] + self.children[slot + 1 :])


def levels_of(nodes: int, fan: int, most: int) -> int:
    """Levels above ``nodes`` nodes until one is left, ``most`` at the most."""
    levels = 0
    while nodes > 1 and levels < most:
        nodes, levels = -(-nodes // fan), levels + 1
    return levels


def grow(digests: list[bytes], levels: int, fan: int) -> list[list[Parent]]:
    """The parents above ``digests``, level by level; the last level is one parent."""
    grown = []
    for _ in range(levels):
        grown.append([Parent(digests[i : i + fan]) for i in range(0, len(digests), fan)])
        digests = [p.digest for p in grown[-1]]
    return grown


def _field(value: Column) -> Column:
    text = value.cast("string")
    whole = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(whole, F.lit("-"))


def leaf(**replaced: Column) -> Column:
    """The leaf of a row of documents; ``replaced`` gives other values for fields."""
    return F.sha2(F.concat(*[_field(replaced.get(name, F.col(name))) for name in FIELDS]), 256)


def leaves(documents: DataFrame, every: int = EVERY) -> DataFrame:
    """doc_id, lang, leaf and changed (the leaf of the tampered row, else null), written."""
    lowered = F.translate("text", _UPPER, _LOWER)
    tampered = F.col("doc_id").isNotNull() & (id_crc() % every == 0)
    return documents.select("doc_id", "lang", leaf().alias("leaf"), F.when(tampered, leaf(text=lowered)).alias("changed"))


def _trees(nodes: DataFrame) -> DataFrame:
    """``nodes`` (lang, digest, _place in the order of languages) with the tree's number, the place in it and its size."""
    spans = nodes.groupBy("lang").agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("size"))
    spans = numbered(spans.withColumnRenamed("lang", "_lang"), ["_lang"], "tree", "trees")
    spans = stored(spans, "tree-spans")
    joined = nodes.join(spans, F.col("lang").eqNullSafe(F.col("_lang")))
    return joined.withColumn("place", F.col("_place") - F.col("_start")).drop("_lang", "_start", "_place", "lang")


def _up(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """The nodes of the next table: one for each block of ``nodes`` (tree, place, size, digest)."""
    span = fan**levels

    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place").to_pydict()
        digests = [d.encode() for d in rows["digest"]]
        size = rows["size"][0]
        grown = grow(digests, levels_of(size, fan, levels), fan)
        top = grown[-1][0].digest if grown else digests[0]
        return pa.table(
            {
                "tree": rows["tree"][:1],
                "place": [rows["place"][0] // span],
                "size": [-(-size // span)],
                "digest": [top.decode()],
            }
        )

    blocks = nodes.select("tree", "place", "size", "digest", F.expr(f"place div {span}").alias("block"))
    return blocks.groupBy("tree", "block").applyInArrow(block, "tree long, place long, size long, digest string")


#: A step of the way to the root: the siblings on the left and on the right, as the text that is hashed.
_WAY = "array<struct<left: string, right: string>>"
_WAY_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _steps(grown: list[list[Parent]], at: int, fan: int) -> list[dict]:
    """The way of the node ``at`` through the levels of its block."""
    steps = []
    for level in grown:
        children, slot = level[at // fan].children, at % fan
        left, right = b"".join(children[:slot]), b"".join(children[slot + 1 :])
        steps.append({"left": left.decode(), "right": right.decode()})
        at //= fan
    return steps


def _block_with_way(rows: pa.Table, above: pa.Table, fan: int, levels: int):
    """A block's rows in order, their digests, its parents, and the row of the node above it."""
    rows = rows.sort_by("place").to_pydict()
    digests = [d.encode() for d in rows["digest"]]
    grown = grow(digests, levels_of(rows["size"][0], fan, levels), fan)
    return rows, digests, grown, above.slice(0, 1).to_pylist()[0]


def _meet(nodes: DataFrame, above: DataFrame, span: int):
    """Groups of a block's rows with the row of its node in the table above."""
    below = nodes.withColumn("block", F.expr(f"place div {span}"))
    above = above.withColumnRenamed("place", "block")
    return below.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))


def _down(nodes: DataFrame, above: DataFrame, fan: int, levels: int) -> DataFrame:
    """tree, place, way, subroot, root of ``nodes``; ``above`` has the same of the nodes that their blocks became."""

    def block(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, _, grown, node = _block_with_way(rows, above, fan, levels)
        n = len(rows["place"])
        way = pa.array([_steps(grown, i, fan) + node["way"] for i in range(n)], _WAY_ARROW)
        same = {name: [node[name]] * n for name in ("subroot", "root")}
        return pa.table({"tree": rows["tree"], "place": rows["place"], "way": way, **same})

    kept = nodes.select("tree", "place", "size", "digest")
    schema = f"tree long, place long, way {_WAY}, subroot string, root string"
    return _meet(kept, above, fan**levels).applyInArrow(block, schema)


class Way:
    """The steps above a block, each with the state before the slot that the block's node fills."""

    def __init__(self, steps: list[dict]):
        self.steps = [(sha256(s["left"].encode()), s["right"].encode()) for s in steps]
        self.siblings = "".join(s["left"] + s["right"] for s in steps).encode()

    def fold(self, digest: bytes) -> bytes:
        for before, right in self.steps:
            state = before.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        return digest


def fold_block(
    digests: list[bytes], replaced: list[bytes], grown: list[list[Parent]], way: Way, fan: int
) -> tuple[list[str], list[str]]:
    """For each row of a block the proof's hash, and the root that its replaced digest leads to."""
    proofs, roots = [], []
    for i, digest in enumerate(replaced):
        at, proof = i, sha256()
        for level in grown:
            parent, slot = level[at // fan], at % fan
            proof.update(parent.siblings(slot))
            digest = parent.fold(slot, digest)
            at //= fan
        proof.update(way.siblings)
        proofs.append(proof.hexdigest())
        roots.append(way.fold(digest).decode())
    return proofs, roots


def _tables(nodes: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """``nodes`` and the tables above it, up to the one that holds one node for each tree."""
    tables = [nodes]
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        tables.append(stored(_up(tables[-1], fan, levels), "merkle-up"))
        most = -(-most // fan**levels)
    return tables


def _ways(tables: list[DataFrame], top: DataFrame, fan: int, levels: int) -> DataFrame:
    """The ways of the second table's nodes; of the first if there is no second."""
    for table in reversed(tables[1:-1]):
        top = stored(_down(table, top, fan, levels), "merkle-down")
    return top


def verify(documents: DataFrame, every: int = EVERY, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``documents``."""
    # Equal rows are told apart by a number, so that a third of equal rows is more than one range.
    rows = stored(leaves(documents, every).withColumn("_copy", F.monotonically_increasing_id()), "merkle-leaves")
    ordered = numbered(rows, ["lang", "doc_id", "leaf", "_copy"], "_place", "merkle-order").drop("_copy")
    nodes = stored(_trees(ordered.withColumnRenamed("leaf", "digest")), "merkle-nodes")
    tables = _tables(nodes, fan, levels)

    # The trees' last nodes, in the order of their languages, are the nodes of one tree more.
    subroots = tables[-1].select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("digest"), F.col("digest").alias("subroot")
    )
    count = subroots.count()
    subroots = stored(subroots.withColumn("size", F.lit(count).cast("long")), "merkle-subroots")
    crown = _tables(subroots, fan, levels)
    root = crown[-1].select(
        "tree", "place", F.array().cast(_WAY).alias("way"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    root = stored(root, "merkle-root")
    over = _ways(crown, root, fan, levels)
    if len(crown) > 1:
        over = _down(subroots, over, fan, levels)
    over = over.drop("subroot").join(subroots.select("tree", "place", "subroot"), ["tree", "place"])
    # A subroot is place 0 of its own tree.
    tops = over.select(
        F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "way", "subroot", "root"
    )
    above = _ways(tables, stored(tops, "merkle-tops"), fan, levels)

    def block(rows: pa.Table, above: pa.Table) -> pa.Table:
        ids = rows.sort_by("place").column("doc_id")
        rows, digests, grown, node = _block_with_way(rows, above, fan, levels)
        replaced = [d if c is None else c.encode() for d, c in zip(digests, rows["changed"])]
        proofs, folded = fold_block(digests, replaced, grown, Way(node["way"]), fan)
        return pa.table(
            {
                "doc_id": ids,
                "leaf": rows["digest"],
                "subroot": [node["subroot"]] * len(ids),
                "root": [node["root"]] * len(ids),
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": [f == node["root"] for f in folded],
            }
        )

    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return _meet(nodes, above, fan**levels).applyInArrow(block, schema)


def digest(documents: DataFrame) -> DataFrame:
    return verify(documents)
