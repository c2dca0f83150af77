"""Vectors of a table in packed blocks, for the searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Neither missing nor empty, all components present and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def clean(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that can take part."""
    return embeddings.where(usable() & F.col("vec_id").isNotNull()).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )


def merged(found: DataFrame, k: int, best_first: Column) -> DataFrame:
    """The k best rows of each query from (query_id, vec_id, score), as query_id, rank, vec_id, score.

    Every task has already cut its rows to k, so a query's group is as large as k times its tasks.
    """
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(best_first, "vec_id"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
