"""Generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Days from the first to the last one that a timestamp can have: 0001-01-01 to 9999-12-31.
LONGEST = 3_652_059


def daily_series(df: DataFrame, ts: str, out: str, align_to_midnight: bool = False, last: str | None = None) -> DataFrame:
    """One row per 24-hour step from the first ``ts`` to the last one (of column ``last``, if given), keeping the first time of day.

    The last calendar day is absent when its latest ``ts`` is earlier in the day than the first
    one of all; ``align_to_midnight`` gives a gap-free calendar instead. No input, no rows.

    Nothing is computed when the series is built: it is the longest series there can be, cut at the two bounds, which are a
    subquery of the plan. So Catalyst takes it for at most LONGEST rows, and adaptive execution sees the real number.
    """
    bounds = df.agg(F.min(ts).cast("timestamp_ntz").alias("lo"), F.max(last or ts).cast("timestamp_ntz").alias("hi"))
    if align_to_midnight:
        midnight = (F.col(c).cast("date").cast("timestamp_ntz").alias(c) for c in ("lo", "hi"))
        bounds = bounds.select(*midnight)
    span = F.struct(F.col("lo"), F.expr("timestampdiff(DAY, lo, hi)").alias("days"))
    steps = df.sparkSession.range(LONGEST).select("id", bounds.select(span).scalar().alias("span"))
    step = F.make_dt_interval(F.col("id").cast("int"))
    return steps.where(F.col("id") <= F.col("span.days")).select((F.col("span.lo") + step).alias(out))
