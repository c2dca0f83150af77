"""Bands of equal size by a measure, exact whatever its distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Runs of neighbouring values whose counts are summed up side by side.
RUNS = 256


def quantile_bands(df: DataFrame, measure: str, bands: int) -> DataFrame:
    """One row ``bands``: for each band that has rows its least value and number, in ascending order.

    A value's band is floor(bands * rows with a smaller value / all rows), so equal values share a band, and with many
    values the bands are of about equal size. Rows without a value have none.

    The counts of the distinct values are summed up in runs of neighbouring values, which are cut at approximate
    quantiles of these values: whatever the distribution, runs hold about as many values each. The cuts only decide which task
    sums up which values; the bands are exact.
    """
    counts = df.where(F.col(measure).isNotNull()).groupBy(F.col(measure).alias("value")).agg(F.count("*").alias("n"))
    shares = F.array(*[F.lit(i / RUNS) for i in range(1, RUNS)])
    cuts = counts.agg(F.percentile_approx("value", shares, 10 * RUNS).alias("cuts"))
    placed = counts.withColumn("cuts", cuts.scalar())
    placed = placed.withColumn("run", F.size(F.filter("cuts", lambda c: c <= F.col("value")))).drop("cuts")
    lower = Window.partitionBy("run").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("run").agg(F.sum("n").alias("n"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # over RUNS rows
    runs = runs.select(
        "run",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("all"),
    )
    below = placed.withColumn("inside", F.coalesce(F.sum("n").over(lower), F.lit(0))).join(runs, "run")
    band = F.expr(f"cast(((before + inside) * {bands}) div `all` as int)")
    least = below.groupBy(band.alias("band")).agg(F.min("value").alias("least"))
    return least.agg(F.sort_array(F.collect_list(F.struct("least", "band"))).alias("bands"))


def with_band(df: DataFrame, value: str, bands: DataFrame, out: str = "band") -> DataFrame:
    """Add the band of a value; the bands are a subquery of the plan, so no row is moved to find its band."""
    listed = df.withColumn("_bands", bands.scalar())
    below = F.filter("_bands", lambda b: b["least"] <= F.col(value))
    band = F.when(F.col(value).isNotNull(), F.try_element_at(below, F.lit(-1))["band"])
    return listed.withColumn(out, band).drop("_bands")
