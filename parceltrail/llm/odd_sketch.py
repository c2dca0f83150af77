"""Near-duplicate documents by MinHash and odd sketches.

A text's set are its distinct 2-word shingles; documents are linked if 100 * intersection >= 80 * union of their sets, and a
class is what links reach. Equal sets are one node, named by its smallest id, so thousands of copies are one node.

A node has SAMPLES MinHash samples. Four of them make a band, and nodes with an equal band meet in a bucket: a pair of similarity
0.8 shares none of the 32 bands with probability 5e-8, one of 0.9 with 2e-15. All samples, each hashed with its number,
are folded into an odd sketch, a bitmap in which a bit says whether an odd number of samples fell on it. The XOR of two sketches
is the sketch of the samples in which they differ, so its population count gives an estimate of the similarity that is
sharpest for similar sets. A pair below CHECKED, which is seven standard deviations below 0.8, is dropped; every other
candidate is confirmed on the full sets. Where many candidates meet, a second odd sketch, of all shingles instead of the samples, comes
first: the bits in which two of them differ are never more than the shingles in which the sets differ, so it drops
only pairs that can't be linked, and nearly all of these.

The pairs of a bucket are never all listed. First each member is paired with the bucket's least one (the only pair of most
buckets). What these confirmed links connect needs no more pairs. Buckets that still hold several classes propose a spanning
forest of them: as few pairs as connect all classes that both sketches allow to be connected, the most similar first. If
one of these pairs is not confirmed, the remaining pairs of different classes that both sketches allow are listed. These steps compare sketches within chunks of a bucket, so that a
bucket of any size is many tasks; chunks of one and the same class never meet.

Defined cases: a missing or empty text, or one of blanks only, has an empty set, is linked with nothing and kept; a text of one
word has one shingle, the word; texts are read in pieces that end at a blank, so one of any length takes memory for
its set only; a row without an id has no class (null), links nothing and is kept; rows with equal ids are rows of
their own, each with the class of its text; an empty table gives no rows; further columns don't matter. Shingles are compared
by 64-bit hashes, and equal sets are found by a 128-bit hash of these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parceltrail.llm.common import count_rows, stored, text_bytes
from parceltrail.llm.components import components
from parceltrail.llm.simhash import Union

#: Links have LEAST percent of the union in common; pairs whose estimate is below CHECKED can't have.
LEAST, CHECKED = 80, 0.55
SAMPLES, BAND, BITS = 128, 4, 1024
#: Bits of the sketch of all shingles.
WIDE = 4096
#: Bytes of a text that are split into words at a time, words whose hash a task remembers.
PIECE, WORDS = 1 << 20, 1 << 20
#: Shingles and documents that are sampled at a time.
FLAT, DOCS = 1 << 16, 256
#: So many links are united in one task (16 bytes each).
FEW = 2_000_000
#: Members of a bucket in one chunk, rows of a chunk that are compared at a time.
CHUNK, ROWS = 2048, 64

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_U = np.uint64
_SEEDS = np.random.default_rng(20240613).integers(0, 1 << 63, (3, SAMPLES), dtype=np.uint64)
#: Odd multipliers and offsets of the samples, and what tells the samples apart in bands and sketches.
_TIMES, _PLUS, _NUMBER = _SEEDS[0] * _U(2) + _U(1), _SEEDS[1], _SEEDS[2]


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 (Steele, Lea and Flood, 2014)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    """Hashes of words, as many as WORDS remembered."""

    def __missing__(self, word: bytes) -> int:
        found = xxh64_intdigest(word)
        if len(self) < WORDS:
            self[word] = found
        return found


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The lower-case words of a text, in lists; bytes.lower() and split() know ASCII only."""
    at = 0
    while at < len(text):
        end = at + PIECE
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        yield text[at:end].lower().split()
        at = end


def shingles(text: bytes, words: dict) -> np.ndarray:
    """The set of a text: sorted hashes of its distinct 2-word shingles."""
    found, last, first = np.empty(0, dtype=np.uint64), None, None
    for piece in _pieces(text):
        if not piece:
            continue
        hashes = np.fromiter(map(words.__getitem__, piece), dtype=np.uint64, count=len(piece))
        if last is not None:
            hashes = np.concatenate([last, hashes])
        first = hashes[:1] if first is None else first
        last = hashes[-1:]
        pairs = np.unique(_mix(hashes[:-1] * _U(0x9E3779B97F4A7C15) + hashes[1:] * _U(0xC2B2AE3D27D4EB4F)))
        found = np.union1d(found, pairs) if len(found) else pairs
    if first is not None and not len(found):
        found = _mix(first * _U(0x9E3779B97F4A7C15) + _U(0x165667B19E3779F9))
    return found


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples of non-empty sets, a row for each."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SAMPLES), dtype=np.uint64)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat(flat * _TIMES[i] + _PLUS[i], starts)
    return out


def bands(found: np.ndarray) -> np.ndarray:
    """A hash of each band's samples and its number."""
    mixed = _mix(found + _NUMBER).reshape(len(found), -1, BAND)
    out = np.zeros(mixed.shape[:2], dtype=np.uint64)
    for i in range(BAND):
        out = _mix(out + mixed[:, :, i])
    return out


def sketches(found: np.ndarray) -> np.ndarray:
    """Odd sketches: BITS bits as longs, a row for each row of samples."""
    bit = (_mix(found ^ _NUMBER) >> _U(64 - BITS.bit_length() + 1)).astype(np.int64)
    at = bit + np.arange(len(found))[:, None] * BITS
    odd = np.bincount(at.ravel(), minlength=len(found) * BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(found), BITS), axis=1).view(np.uint64)


def wide_sketch(found: np.ndarray) -> bytes:
    """Odd sketch of all shingles of a set."""
    bit = (_mix(found) >> _U(64 - WIDE.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=WIDE).astype(np.uint8) & 1).tobytes()


def can_link(differing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets of ``sizes`` shingles together may be linked, if they differ in ``differing`` shingles at least."""
    return differing * (100 + LEAST) <= sizes * (100 - LEAST)


def similarity(differing: np.ndarray) -> np.ndarray:
    """Estimate from the number of bits in which two sketches differ."""
    share = np.minimum(2 * differing / BITS, 1 - 1 / BITS)
    return 1 + BITS / (4 * SAMPLES) * np.log1p(-share)


def _signatures(sets: list[np.ndarray]) -> tuple[list, list]:
    """Bands and sketch of each set, in groups of a bounded size."""
    all_bands, all_sketches, group, size = [], [], [], 0
    for i, s in enumerate(sets):
        group.append(s)
        size += len(s)
        if size >= FLAT or len(group) == DOCS or i == len(sets) - 1:
            found = samples(group)
            all_bands += list(bands(found).view(np.int64))
            all_sketches += [row.tobytes() for row in sketches(found)]
            group, size = [], 0
    return all_bands, all_sketches


def _set_hash(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def _sketched(documents: DataFrame) -> DataFrame:
    """doc_id, content (a hash of the text), n, key (hash of the set), bands, sketch of every row; no key without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            sets = [shingles(t, words) for t in text_bytes(batch)]
            full = [i for i, s in enumerate(sets) if len(s)]
            made = dict(zip(full, zip(*_signatures([sets[i] for i in full]))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("content"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_hash(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([made[i][0] if i in made else None for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([made[i][1] if i in made else None for i in range(len(sets))], pa.binary()),
                ],
                names=["doc_id", "content", "n", "key", "bands", "sketch"],
            )

    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("content"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, content long, n long, key binary, bands array<long>, sketch binary")


def _nodes(rows: DataFrame) -> DataFrame:
    """node (a number), id, content, n, bands, sketch of each distinct set, written."""
    full = rows.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    least = F.min(F.struct("doc_id", "content"))
    whole = full.groupBy("key").agg(least.alias("least"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")])
    named = whole.select("key", "least.doc_id", "least.content", "n", "bands", "sketch")
    return stored(named.withColumnRenamed("doc_id", "id").withColumn("node", F.monotonically_increasing_id()), "nodes")


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sizes and sketches allow a link."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(f"sketch_{c}").to_pylist()), dtype=np.uint64).reshape(-1, BITS // 64)
                for c in ("a", "b")
            )
            near = similarity(np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)) >= CHECKED
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(side("a"), "a").join(side("b"), "b").where(sized).mapInArrow(run, "a long, b long")


def _sets(documents: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, set, wide of the nodes in ``wanted``, written; a node's text is looked up by its id and content."""
    asked = nodes.join(wanted, "node").select("node", F.col("id").alias("_id"), F.col("content").alias("_content"))
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("content"))
    found = texts.join(asked, (F.col("doc_id") == F.col("_id")) & (F.col("content") == F.col("_content")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            sets = [shingles(t, words) for t in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([wide_sketch(s) for s in sets], pa.binary()),
                ],
                names=["node", "set", "wide"],
            )

    sets = found.select("node", "text").mapInArrow(run, "node long, set array<long>, wide binary")
    # A row that is repeated in the table gives its node several times.
    return stored(sets.groupBy("node").agg(F.first("set").alias("set"), F.first("wide").alias("wide")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` that the full sets link."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    return both.where(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * LEAST).select("a", "b")


def _chunked(members: DataFrame) -> DataFrame:
    """``members`` (bucket, node, class) dealt to pairs of chunks: low <= high, and the row's own chunk.

    A class that fills chunks of its bucket alone has chunks of its own, which needn't meet each other.
    """
    spans = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("rows"))
    big = F.col("rows") > CHUNK
    chunks = F.ceil(F.col("rows") / CHUNK)
    per = spans.groupBy("bucket").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(~big, F.col("rows")).otherwise(0)) / CHUNK)).alias("mixed"),
        F.sum(F.when(big, chunks).otherwise(0)).alias("alone"),
    )
    per = per.select("bucket", "mixed", (F.col("mixed") + F.col("alone")).alias("all"))
    before = Window.partitionBy("bucket").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    own = spans.where(big).select("bucket", "class", chunks.alias("own"), F.coalesce(F.sum(chunks).over(before), F.lit(0)).alias("before"))
    rows = members.join(per, "bucket").join(own, ["bucket", "class"], "left")
    first = F.when(F.col("own").isNull(), 0).otherwise(F.col("mixed") + F.col("before")).cast("long")
    count = F.coalesce("own", "mixed").cast("long")
    rows = rows.withColumns({"first": first, "count": count})
    rows = rows.withColumn("chunk", F.col("first") + F.pmod(F.xxhash64("node"), F.col("count")))
    none = F.array().cast("array<long>")
    to = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(none)
    zero, last = F.lit(0).cast("long"), F.col("all").cast("long") - 1
    others = F.concat(to(zero, F.col("first") - 1), to(F.col("first") + F.col("count"), last))
    partners = F.when(F.col("own").isNull(), to(zero, last)).otherwise(others)
    dealt = rows.withColumn("other", F.explode(partners))
    return dealt.select(
        *members.columns, "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    )


def _forest(x: np.ndarray, y: np.ndarray, near: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Places of the pairs (x, y) of a spanning forest of the classes, the most similar first (Boruvka's algorithm)."""
    names, number = np.unique(cls, return_inverse=True)
    union, chosen, live = Union(len(names)), [], np.arange(len(x))
    while True:
        one, other = union.root[number[x[live]]], union.root[number[y[live]]]
        apart = one != other
        live = live[apart]
        if not len(live):
            return np.concatenate(chosen) if chosen else live
        ends, pair = np.concatenate([one[apart], other[apart]]), np.concatenate([live, live])
        order = np.lexsort((pair, -near[pair], ends))
        first = np.ones(len(order), dtype=bool)
        first[1:] = ends[order][1:] != ends[order][:-1]
        best = np.unique(pair[order][first])
        chosen.append(best)
        union.link(number[x[best]], number[y[best]])


def _compare(rows: pa.Table, forest: bool) -> pa.Table:
    """Pairs of a pair of chunks that a link may join: of different classes, and allowed by both sketches."""
    node, cls, n, chunk = (rows.column(c).to_numpy() for c in ("node", "class", "n", "chunk"))
    sketch, wide = (
        np.frombuffer(b"".join(rows.column(c).to_pylist()), dtype=np.uint64).reshape(-1, bits // 64)
        for c, bits in (("sketch", BITS), ("wide", WIDE))
    )
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    found = [(left[:0], left[:0], np.zeros(0))]
    for at in range(0, len(left), ROWS):
        i = left[at : at + ROWS]
        other = right[right > i[0]] if low == high else right
        # Classes and sizes leave few pairs; only these have their bits compared.
        least, most = np.minimum(n[i, None], n[None, other]), np.maximum(n[i, None], n[None, other])
        x, y = np.nonzero((cls[i, None] != cls[None, other]) & (least * 100 >= most * LEAST))
        x, y = i[x], other[y]
        if low == high:
            x, y = x[x < y], y[x < y]
        near = similarity(np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64))
        x, y, near = (a[near >= CHECKED] for a in (x, y, near))
        allowed = can_link(np.bitwise_count(wide[x] ^ wide[y]).sum(axis=1, dtype=np.int64), n[x] + n[y])
        found.append((x[allowed], y[allowed], near[allowed]))
    x, y, near = (np.concatenate(part) for part in zip(*found))
    if forest:
        kept = _forest(x, y, near, cls)
        x, y = x[kept], y[kept]
    return pa.table({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y])})


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several classes of ``links``, with their class; written."""
    found = components(links, few=FEW).select(F.col("node").alias("_node"), F.col("component").alias("_class"))
    named = members.join(found, F.col("node") == F.col("_node"), "left")
    named = stored(named.withColumn("class", F.coalesce("_class", "node")).drop("_node", "_class"), "members")
    several = named.groupBy("bucket").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    return named.join(several.where("least < most").select("bucket"), "bucket", "left_semi")


def _proposed(members: DataFrame, about: DataFrame, forest: bool) -> DataFrame:
    pairs = _chunked(members).join(about, "node").groupBy("bucket", "low", "high")
    return pairs.applyInArrow(lambda rows: _compare(rows, forest), "a long, b long").distinct()


def links(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the classes of ``nodes``, confirmed on the sets of their texts."""
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    # Most buckets hold one node, and most others two, which is their only pair.
    buckets = spread.groupBy("bucket").agg(
        F.min("node").alias("a"), F.max("node").alias("b"), F.count(F.lit(1)).alias("rows")
    )
    buckets = stored(buckets.where(F.col("rows") > 1), "buckets")
    large = buckets.where(F.col("rows") > 2).select("bucket", "a")
    members = stored(spread.join(large, "bucket"), "large-buckets")
    pairs = buckets.where(F.col("rows") == 2).select("a", "b")
    pairs = pairs.union(members.where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))).distinct()
    tested = stored(_estimated(pairs, nodes), "pairs")
    members = members.select("bucket", "node")
    wanted = tested.select(F.col("a").alias("node")).union(tested.select("b")).union(members.select("node")).distinct()
    sets = _sets(documents, nodes, wanted)
    found = stored(_confirmed(tested, sets), "links")

    about = sets.select("node", "wide").join(members.select("node").distinct(), "node")
    about = stored(about.join(nodes.select("node", "n", "sketch"), "node"), "about")
    for forest in (True, False):
        left = stored(_open(members, found), "open")
        if not left.take(1):
            break
        # A member of a bucket that is open no more has met all others there.
        members = left.drop("class")
        proposed = stored(_proposed(left, about, forest), "pairs")
        fresh = proposed.join(tested, ["a", "b"], "left_anti")
        more = stored(_confirmed(fresh, sets), "links")
        tested, found = tested.union(proposed), found.union(more)
        # If all pairs of the forests are links, each allowed pair is within a class now.
        if count_rows(more) == count_rows(proposed):
            break
    return found


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, content (a hash of the text), n_shingles, component_id, kept of every row of ``documents``."""
    rows = stored(_sketched(documents), "sketches")
    nodes = _nodes(rows)
    found = stored(components(links(documents, nodes), few=FEW), "found")
    named = nodes.select("key", "node", "id").join(found, "node", "left")
    named = stored(named.withColumn("_class", F.coalesce("component", "node")).drop("component"), "classes")
    least = named.groupBy("_class").agg(F.min("id").alias("_least"))
    ids = named.join(least, "_class").select(F.col("key").alias("_key"), F.col("_least"))
    joined = rows.select("doc_id", "content", "n", "key").join(ids, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_least", "doc_id"))
    return joined.select(
        "doc_id",
        "content",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """``documents`` without the rows whose id is not the least of their class; rows that share that id all stay."""
    gone = classes(documents).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("content").alias("_of"))
    same = (documents["doc_id"] == F.col("_gone")) & (F.xxhash64(documents["text"]) == F.col("_of"))
    return documents.join(gone.distinct(), same, "left_anti")


def digest(documents: DataFrame) -> DataFrame:
    return classes(documents).drop("content")
