"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import count_rows, stored


def _least(links: DataFrame) -> DataFrame:
    """For each node its smallest neighbour, itself included."""
    both = links.select(F.col("a").alias("_node"), "b").union(links.select("b", "a").toDF("_node", "b"))
    return both.groupBy("_node").agg(F.min("b").alias("_min")).select("_node", F.least("_min", "_node").alias("_min"))


def _contract(links: DataFrame) -> DataFrame:
    """One step of alternating star contraction; ``links`` holds a > b."""
    # Large star: the larger end of each link moves to the smallest neighbour of the other end.
    # Both sides are stored tables, so that adaptive execution can split a node with many links.
    low = stored(_least(links), "least")
    large = links.join(low, F.col("b") == F.col("_node"), "left").select(
        "a", F.coalesce(F.col("_min"), F.col("b")).alias("b")
    )
    # Small star: the smaller neighbours of a node are linked to the smallest of them.
    least = large.groupBy("a").agg(F.min("b").alias("_min"))
    joined = large.join(least, "a").select("a", "b", "_min")
    small = joined.select("b", "_min").where(F.col("b") != F.col("_min")).toDF("a", "b").union(least.toDF("a", "b"))
    return small.distinct()


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, component of all links of a task, for nodes that are not their component's smallest."""
    held = [[b.column(c).to_numpy() for c in ("a", "b")] for b in batches if b.num_rows]
    if held:
        ends = [np.concatenate(x) for x in zip(*held)]
        nodes, number = np.unique(np.concatenate(ends), return_inverse=True)
        root, a, b = np.arange(len(nodes)), *np.split(number, 2)
        while True:
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
        moved = root != np.arange(len(root))
        found = [pa.array(nodes[moved], pa.int64()), pa.array(nodes[root[moved]], pa.int64())]
        yield pa.RecordBatch.from_arrays(found, names=["node", "component"])


def components(links: DataFrame, most_rounds: int = 60, few: int = 0) -> DataFrame:
    """node, component (smallest node that can be reached) of every node in ``links`` (a, b: long) but the smallest ones.

    Alternating large-star and small-star steps (Kiveris et al., 2014) end in one star for each component
    after a number of rounds that grows with the logarithm of its size. Every round is written to the
    shared folder; the driver sees a count and a checksum only. Up to ``few`` links are united in one task instead.
    """
    links = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    if few and count_rows(links) <= few:
        return links.coalesce(1).mapInArrow(_united, "node long, component long")
    before = None
    for _ in range(most_rounds):
        mark = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if mark["n"] == 0 or mark == before:
            break
        before = mark
        links = stored(_contract(links), "links")
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
