"""Operators against plain Python on small random tables."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parceltrail.operators.dedup import latest_per_key
from parceltrail.operators.joins import fits_broadcast, hot_keys, lookup_join, split_join
from parceltrail.operators.ranking import rank_by_count, top_by_count
from parceltrail.operators.series import daily_series

few_examples = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
small_int = st.none() | st.integers(0, 4)


def greatest_first(value):
    """Sort key for descending order with None before everything."""
    return (value is not None, -value if value is not None else 0)


@few_examples
@given(st.lists(st.tuples(small_int, small_int, small_int), max_size=25))
def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    expected = {}
    for row in sorted(rows, key=lambda r: (greatest_first(r[1]), greatest_first(r[2]))):
        expected.setdefault(row[0], row)
    found = [tuple(r) for r in latest_per_key(df, ["k"], ["t"]).collect()]
    assert len(found) == len(expected) and {r[0]: r for r in found} == expected


def test_latest_per_key_twice_changes_nothing(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    once = latest_per_key(df, ["k"], ["v"])
    assert sorted(once.collect()) == sorted(latest_per_key(once, ["k"], ["v"]).collect())


def test_latest_per_key_without_other_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in latest_per_key(df, ["k"]).collect()) == [1, 2]


def skewed(spark, n=6000):
    """A third of the rows have key 7, some have none, keys from 40 on match nothing."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(n).select(key.cast("int").alias("k"), F.col("id").alias("v"))


def test_hot_keys(spark):
    assert hot_keys(skewed(spark), "k", 500) == [(7, 5)]  # 2,073 rows, at most 500 per part


def test_hot_keys_ignores_small_tables(spark):
    assert hot_keys(skewed(spark), "k") == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_part", [10, 500, 1_000_000])
def test_split_join_equals_join(spark, shuffle_joins, how, rows_per_part):
    large = skewed(spark)
    lookup = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    found = split_join(large, lookup, "k", how, rows_per_part=rows_per_part)
    expected = large.join(lookup, "k", how)
    assert found.columns == expected.columns
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)


def test_split_join_refuses_other_joins(spark):
    with pytest.raises(ValueError, match="full"):
        split_join(skewed(spark), spark.range(1).selectExpr("cast(id AS int) AS k"), "k", "full")


def test_split_join_with_repeated_lookup_keys(spark, shuffle_joins):
    large = skewed(spark, 300)
    lookup = spark.createDataFrame([(7, "x"), (7, "y"), (8, "z")], "k int, w string")
    found = split_join(large, lookup, "k", "left", rows_per_part=10)
    expected = large.join(lookup, "k", "left")
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)


def test_split_join_spreads_the_hot_key(spark, shuffle_joins):
    lookup = spark.range(50).select(F.col("id").cast("int").alias("k"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = split_join(skewed(spark), lookup, "k", rows_per_part=100).where("k = 7")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) == 4 and max(sizes) < 0.6 * sum(sizes)


def test_split_join_counts_on_another_table(spark, shuffle_joins):
    large, raw = skewed(spark), skewed(spark).unionByName(skewed(spark))
    lookup = spark.range(40).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("w"))
    found = split_join(large, lookup, "k", count_on=raw, rows_per_part=100)
    assert found.count() == large.join(lookup, "k").count()


def test_equal_rows_of_a_hot_key_are_divided(spark, shuffle_joins):
    large = spark.range(200_000).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    large = large.unionByName(spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "k int, v string"))
    lookup = spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("w").alias("w"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        joined = split_join(large, lookup, "k", "left", rows_per_part=1000)
        sizes = [r["count"] for r in joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(setting, "true")
    assert sum(sizes) == 200_000 and len(sizes) == 4 and max(sizes) < 70_000
    rest = joined.where("k is null or k <> 7").collect()
    assert sorted(map(tuple, rest), key=str) == [(1, "x", "w"), (1, "x", "w"), (None, "y", None)]


def test_a_calendar_of_ten_thousand_years_is_not_broadcast(spark):
    purchases = spark.createDataFrame([("0001-01-01 05:00:00",), ("9999-12-31 06:00:00",)], "t string")
    days = daily_series(purchases.select(F.col("t").cast("timestamp_ntz").alias("t")), "t", "day")
    assert days.count() == 3_652_059 and not fits_broadcast(days)
    ends = days.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    assert tuple(ends) == ("0001-01-01 05:00:00", "9999-12-31 05:00:00")
    assert daily_series(purchases.limit(0).select(F.col("t").cast("timestamp_ntz").alias("t")), "t", "d").count() == 0


@pytest.mark.parametrize("kind", ["double", "string"])
def test_only_counts_are_ranked(spark, kind):
    with pytest.raises(ValueError, match="no count"):
        rank_by_count(spark.range(3).select(F.col("id").cast(kind).alias("n")), "n")
    with pytest.raises(Exception, match="no count: -1"):
        rank_by_count(spark.range(3).select((F.col("id") - 1).alias("n")), "n").collect()


def test_rows_without_a_measure_come_last(spark):
    df = spark.createDataFrame([("a", 1.5), (None, 1.5), ("b", None), ("c", 2.0)], "k string, n double")
    found = [(r.k, r["rank"]) for r in top_by_count(df, "n", "k", 4).orderBy("rank", F.asc_nulls_first("k")).collect()]
    assert found == [("c", 1), (None, 2), ("a", 2), ("b", 4)]


def test_lookup_join_broadcasts_small_lookups_only(spark):
    large = skewed(spark)
    lookup = spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("w"))
    small = lookup_join(large, lookup, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "xxhash64" not in small
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100")
    try:
        big = lookup_join(large, lookup, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" in big and "xxhash64" in big


@few_examples
@given(st.lists(st.integers(0, 6), max_size=25))
def test_ranks(spark, counts):
    rows = list(enumerate(counts))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, n bigint")
    expected = {k: 1 + sum(other > n for other in counts) for k, n in rows}
    assert {r.k: r["rank"] for r in rank_by_count(df, "n").collect()} == expected
    top = [(r.k, r["rank"]) for r in top_by_count(df, "n", "k", 5).collect()]
    best = sorted(rows, key=lambda r: (-r[1], r[0]))[:5]
    assert sorted(top) == sorted((k, expected[k]) for k, _ in best)
