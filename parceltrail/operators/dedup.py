"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` values of each key; a NULL counts as greatest.

    ``tiebreak`` (all other columns unless given) makes the choice the same in every run. Rows
    that agree on all of them are equal, so it does not matter which of those is kept. NULL keys
    form one group.

    Filtering ``row_number() = 1`` lets Catalyst put a group limit below the shuffle: each input
    partition sends at most one row per key, so a key that holds a third of the table reaches
    its reducer as one row per input partition.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c not in order_by]
    ordering = [F.col(c).desc_nulls_first() for c in [*order_by, *tiebreak]]
    window = Window.partitionBy(*keys).orderBy(*(ordering or [F.col(keys[0])]))
    return df.withColumn("row_num", F.row_number().over(window)).where("row_num = 1").drop("row_num")
