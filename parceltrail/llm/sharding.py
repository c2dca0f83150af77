"""Shards along a Hilbert curve over metadata, so that readers can skip files by several columns at once.

Documents are quantised in three metadata dimensions, ordered by the index of their cell on a Hilbert
curve, and the order is cut into runs of equal row count. Neighbours on the curve are neighbours in
every dimension, so each shard covers a compact box of the metadata and min/max statistics prune files.

Only DataFrame functions are used. There is no window over all rows: rows are dealt by range, their place
in the partition comes from ``monotonically_increasing_id`` and the partitions' sizes (one row each) are
summed up. The order ends with the text's checksum and the id, so a cell that holds a third of all rows is
cut like any other.

Defined cases: a missing text has no bytes (size 1, checksum 0); missing ids, sources and languages sort
first; equal rows get neighbouring slots; an empty table gives no rows; further columns are ignored by
``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parceltrail.llm.common import stored

SHARDS = 16
#: Bits for each of the three dimensions: 2^(3 * BITS) cells.
BITS = 5
DIMENSIONS = 3
_ROW = (1 << 33) - 1


def _letter_cell(value: Column) -> Column:
    """0 to 31 in alphabetical order of the first character (digits 0 to 5, letters 6 to 31)."""
    code = F.ascii(F.lower(F.coalesce(value, F.lit(""))))
    return (
        F.when(code < 48, 0)
        .when(code < 58, ((code - 48) / 2).cast("int"))
        .when(code < 97, 5)
        .otherwise(F.least(code - 91, F.lit(31)))
        .cast("int")
    )


def _number_cell(value: Column) -> Column:
    """0 to 31 by the number at the end of a name, 31 for all above; names without one by their first letter."""
    digits = F.regexp_extract(F.coalesce(value, F.lit("")), "([0-9]{1,9})$", 1)
    number = F.least(F.nullif(digits, F.lit("")).cast("long"), F.lit(31)).cast("int")
    return F.when(digits == "", _letter_cell(value)).otherwise(number)


def _size_cell(size: Column) -> Column:
    """0 to 31: two steps for each doubling of the size."""
    return F.least((F.log2(size.cast("double")) * 2).cast("int"), F.lit(31))


def hilbert_index(df: DataFrame, axes: list[str], bits: int, out: str) -> DataFrame:
    """Add the place ``out`` on the Hilbert curve through 2^bits cells on each of the ``axes``.

    The axes are rotated and reflected from the highest bit down, then Gray-coded (Skilling, 2004). Each
    step is a projection of its own, so the expressions don't multiply.
    """
    x = [f"_h{i}" for i in range(len(axes))]
    df = df.withColumns({c: F.col(a).cast("int") for c, a in zip(x, axes)})
    for bit in range(bits - 1, 0, -1):
        q, p = 1 << bit, (1 << bit) - 1
        for c in x:
            set_here = F.col(c).bitwiseAND(F.lit(q)) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(c)).bitwiseAND(F.lit(p))
            step = {x[0]: F.when(set_here, F.col(x[0]).bitwiseXOR(F.lit(p))).otherwise(F.col(x[0]).bitwiseXOR(swap))}
            if c != x[0]:
                step[c] = F.when(set_here, F.col(c)).otherwise(F.col(c).bitwiseXOR(swap))
            df = df.withColumns(step)
    for before, c in zip(x, x[1:]):
        df = df.withColumns({c: F.col(c).bitwiseXOR(F.col(before))})
    turn = F.lit(0)
    for bit in range(bits - 1, 0, -1):
        q = 1 << bit
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(q)) != 0, q - 1).otherwise(0))
    df = df.withColumns({"_turn": turn})
    index = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for c in x:
            at = F.shiftright(F.col(c).bitwiseXOR(F.col("_turn")), bit).bitwiseAND(F.lit(1))
            index = index * 2 + at.cast("long")
    return df.withColumns({out: index}).drop(*x, "_turn")


def keyed(documents: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, size, text_crc32, the three cells, ``carried`` and the place on the curve; a row per document."""
    raw = F.coalesce(F.col("text"), F.lit(""))
    slim = documents.select(
        *carried,
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        "lang",
        "source",
    ).withColumns(
        {
            "lang_cell": _letter_cell(F.col("lang")),
            "source_cell": _number_cell(F.col("source")),
            "size_cell": _size_cell(F.col("size")),
        }
    )
    slim = slim.drop("lang", "source")
    return hilbert_index(slim, ["lang_cell", "source_cell", "size_cell"], BITS, "curve")


ORDER = ("curve", "text_crc32", "doc_id")


def _placed(documents: DataFrame, shards: int, *carried: Column) -> DataFrame:
    """What ``keyed`` gives, with shard and slot of every row.

    Shard s holds the rows whose place r in the order has floor(r * shards / rows) = s: counts are at
    most one apart. The ordered rows are written once, as two reads of a range exchange may cut differently.
    """
    placed = stored(
        keyed(documents, *carried)
        .repartitionByRange(*ORDER)
        .sortWithinPartitions(*ORDER)
        .withColumn("_at", F.monotonically_increasing_id()),
        "shards",
    ).withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit(_ROW))})
    # One row for each partition of the range exchange: their number is a setting, not the data's size.
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    rank = F.col("_first") + F.col("_row")
    return (
        placed.join(F.broadcast(parts), "_part")
        .withColumn("_rank", rank)
        .withColumn("shard", F.expr(f"cast(_rank * {shards} div _all as int)"))
        .withColumn("slot", F.expr(f"_rank - (shard * _all + {shards - 1}) div {shards}"))
    )


def assign(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, the cells, curve, shard and slot of every document."""
    return _placed(documents, shards).select(
        "doc_id", "size", "text_crc32", "lang_cell", "source_cell", "size_cell", "curve", "shard", "slot"
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write whole documents as one folder for each shard; returns each shard's count and bounds.

    A document travels with its key as one struct, so each row gets one place, whatever its id.
    """
    clash = [c for c in ("shard", "slot") if c in documents.columns]
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_document")
    rows = _placed(documents, shards, whole).select("_document.*", "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(
        path
    )
    written = documents.sparkSession.read.parquet(path)
    bounds = [f(c).alias(f"{n}_{c}") for c in ("lang", "source", "n_chars") for n, f in (("min", F.min), ("max", F.max))]
    return written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), *bounds)


def digest(documents: DataFrame) -> DataFrame:
    return assign(documents).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
