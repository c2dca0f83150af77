"""Equi-join of a large table with a table that has one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Below this many rows a key is never split, however small the table is.
ROWS_PER_PART = 2_000_000
# Hash buckets in which rows are counted before single keys are.
BUCKETS = 65_536
# A key is hot if it alone is this many times the size of an average bucket.
HOT_FACTOR = 4
# Equal rows are numbered in steps of so many.
COPIES = 65_536


@dataclass(frozen=True)
class HotKeys:
    """Frequent values of a table's columns and their rows, as found when the table was written.

    Joins take it in place of a table to count on, so that building them runs no job. Counts may be a little low
    and rows may be gone since; the parts of a key follow from them, the result of a join does not.
    """

    rows: int
    frequent: Mapping[str, Sequence[tuple]]

    def parts(self, key: str, rows_per_part: int) -> list[tuple]:
        """(key, parts), as ``hot_keys`` finds them by counting."""
        if key not in self.frequent:
            raise LookupError(f"frequent values of {key} are not known")
        limit = max(rows_per_part, -(-self.rows * HOT_FACTOR // BUCKETS))
        return sorted((k, -(-n // limit)) for k, n in self.frequent[key] if n > limit)


def fits_broadcast(df: DataFrame) -> bool:
    """True if Catalyst's size estimate is within the session's broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= threshold


def hot_keys(rows: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART) -> list[tuple]:
    """(key, parts) of the keys that hold too many rows for one task.

    Too many means more than ``rows_per_part`` and more than HOT_FACTOR average buckets. As each
    such key holds more than HOT_FACTOR / BUCKETS of the table, there are fewer than
    BUCKETS / HOT_FACTOR of them, whatever the table holds: the driver can hold the list.

    Counting every key would shuffle nearly the whole key column. A hot key makes its bucket hot,
    so rows are first counted by bucket (a task sends at most BUCKETS rows), and by key only in
    hot buckets; mostly there is none. The counts are exact and taken once, when the join is built; both sides
    of the join derive their parts from the same list, also when a lost executor makes Spark compute them again.
    """
    keyed = rows.where(F.col(key).isNotNull()).select(
        key, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("_bucket")
    )
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    average = F.sum("_n").over(Window.partitionBy()) / BUCKETS  # over at most BUCKETS rows
    most = F.greatest(F.lit(rows_per_part), F.ceil(average * HOT_FACTOR))
    hot = sizes.select("_bucket", "_n", most.alias("_most")).where(F.col("_n") > F.col("_most")).collect()
    if not hot:
        return []
    counted = keyed.where(F.col("_bucket").isin([r["_bucket"] for r in hot])).groupBy(key).agg(F.count("*").alias("_n"))
    limit = hot[0]["_most"]
    return sorted((r[0], -(-r[1] // limit)) for r in counted.where(F.col("_n") > limit).collect())


def _listed(spark: SparkSession, like: DataFrame, key: str, hot: list[tuple]) -> DataFrame:
    """The hot keys as a table of literals, in the type of the key."""
    kind = like.schema[key].dataType.simpleString()
    rows = F.array(*[F.struct(F.lit(k).cast(kind).alias(key), F.lit(n).alias("_parts")) for k, n in hot])
    return spark.range(1).select(F.inline(rows))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number ``_copy`` that tells equal rows apart.

    Equal rows become one with their count, and the count is spelled out again in steps, so that no array has
    more than COPIES numbers. Numbers don't depend on where a row stands, so a task that runs again repeats them.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}"))))
    left = F.least(F.lit(COPIES).cast("long"), F.col("_n") - F.col("_block") * COPIES)
    within = F.explode(F.sequence(F.lit(1).cast("long"), left))
    return blocks.withColumn("_in", within).withColumn("_copy", F.col("_block") * COPIES + F.col("_in")).drop(
        "_n", "_block", "_in"
    )


def split_join(
    large: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    count_on: DataFrame | HotKeys | None = None,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Shuffle join in which hot keys of ``large`` are spread over several tasks.

    A row of a hot key gets a part number from a hash of its content, and the matching ``lookup``
    row is repeated once per part; all other rows get part 0. The hash is of the content, not of
    the row's position, so that a recomputed task sends its rows to the same place again; rows of a hot key that are
    equal in every column are numbered first, so they are divided too.

    ``count_on`` names a raw or stored table with the same keys (or more rows per key) to count on, or holds the hot keys
    that were found when the table was written.
    """
    if how not in ("inner", "left"):
        # Repeated lookup rows without a match would show up once per part.
        raise ValueError(f"split_join does not support {how!r}")
    columns = large.columns
    if isinstance(count_on, HotKeys):
        hot = count_on.parts(key, rows_per_part)
    else:
        hot = hot_keys(count_on if count_on is not None else large, key, rows_per_part)
    content = F.xxhash64(*columns)
    # NULL keys match nothing; spread them as well.
    cold_part = F.when(F.col(key).isNull(), F.pmod(content, F.lit(BUCKETS))).otherwise(0).cast("int")
    if not hot:
        spread = large.withColumn("_part", cold_part)
        return spread.join(lookup.withColumn("_part", F.lit(0)), [key, "_part"], how).drop("_part")
    listed = F.broadcast(_listed(large.sparkSession, large, key, hot))
    marked = large.join(listed, key, "left").select(*columns, "_parts")
    cold = marked.where(F.col("_parts").isNull()).drop("_parts").withColumn("_part", cold_part)
    copies = _numbered(marked.where(F.col("_parts").isNotNull()))
    part = F.pmod(F.xxhash64(*columns, "_copy"), F.col("_parts")).cast("int")
    spread = cold.unionByName(copies.withColumn("_part", part).select(*columns, "_part"))
    repeated = (
        lookup.join(listed, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    return spread.join(repeated, [key, "_part"], how).drop("_part")


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    count_on: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """Join ``lookup`` (one row per key) to ``large``.

    A lookup within the session's broadcast threshold is left to Catalyst, which broadcasts it:
    no shuffle of the large side, hence no hot task. Beyond it the join shuffles, with hot keys
    split.
    """
    if fits_broadcast(lookup):
        return large.join(lookup, key, how)
    return split_join(large, lookup, key, how, count_on)
