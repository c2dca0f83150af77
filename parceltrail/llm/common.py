"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parceltrail.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what follows neither recomputes ``df`` nor depends on an executor's disk.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores before them as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def id_crc(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text; a missing id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def drawn(documents: DataFrame, share: float | Column, salt: int) -> DataFrame:
    """doc_id, text (and lang, if there) of a share of the rows, drawn by a hash of id and text; equal rows are one.

    So the sample is as large as asked at most, whatever ids rows share or lack and however often one is repeated.
    """
    place = F.pmod(F.xxhash64(F.lit(salt), "doc_id", "text"), F.lit(1 << 24)) / float(1 << 24)
    return documents.where(place < share).dropDuplicates([c for c in ("doc_id", "lang", "text") if c in documents.columns])


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; missing texts are empty."""
    values = batch.column(column).cast(pa.binary()).to_pylist()
    return [v or b"" for v in values]


def with_columns(
    df: DataFrame, fields: str, make: Callable[[], Callable[[pa.RecordBatch], list]], need: list[str]
) -> DataFrame:
    """``df`` with further columns that Python computes from the columns ``need`` of a batch.

    ``fields`` is the schema text of the new columns; ``make`` runs once in each task and returns the
    function for its batches. New columns stand first, so clashing names of ``df`` need care by the caller.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    taken = set(df.columns) & set(new.names)
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                made = work(batch.select(need))
                yield pa.RecordBatch.from_arrays(
                    [*made, *batch.columns], names=[*new.names, *batch.schema.names]
                )

    return df.mapInArrow(run, StructType([*new.fields, *df.schema.fields]))


def count_rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


_ROW = (1 << 33) - 1


def numbered(df: DataFrame, order: list[str], out: str, label: str) -> DataFrame:
    """``df``, written, with the place (from 0) of every row in the order of ``order``; missing values come first.

    Rows are dealt by range and sorted; only the partitions' sizes are summed up in one place. ``order`` should tell
    rows apart, as equal keys share a partition. Ordered rows are written once, as two reads of a range
    exchange may cut differently.
    """
    at, part, first, n = free(df, "_at", "_part", "_first", "_n")
    rows = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), label
    ).withColumn(part, F.shiftright(at, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition of the exchange: their number is a setting, not the data's size.
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    sizes = sizes.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    place = F.col(first) + F.col(at).bitwiseAND(F.lit(_ROW))
    return rows.join(F.broadcast(sizes), part).withColumn(out, place).drop(at, part, first)
