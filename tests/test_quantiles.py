"""Bands that the data give, trends, and the fact from raw tables."""

import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from parceltrail import driver_tables as raw
from parceltrail import queries
from parceltrail.operators import quantiles
from parceltrail.operators.quantiles import quantile_bands, with_band
from parceltrail.plans import gold, kpi, silver

SF_DIR = "/root/testdata/sf0.001"


def expected_bands(values, bands):
    counts, below, out = Counter(v for v in values if v is not None), 0, {}
    total = sum(counts.values())
    for value in sorted(counts):
        out[value] = below * bands // total
        below += counts[value]
    return out


@pytest.mark.parametrize("kind", ["spread", "hot", "outliers", "one", "few", "none"])
@pytest.mark.parametrize("bands", [1, 4, 7])
def test_bands_of_any_distribution(spark, monkeypatch, kind, bands):
    monkeypatch.setattr(quantiles, "RUNS", 8)
    rng = random.Random(kind)
    values = {
        "spread": [rng.randrange(10**6) for _ in range(500)],
        "hot": [7 if rng.random() < 0.6 else rng.randrange(300) for _ in range(500)],
        "outliers": [rng.randrange(100) * 10 ** (9 if rng.random() < 0.02 else 0) for _ in range(300)],
        "one": [5] * 20,
        "few": [1, 2, 2, 3],
        "none": [],
    }[kind] + [None] * 3
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(3)
    found = {r.x: r.band for r in with_band(df, "x", quantile_bands(df, "x", bands)).distinct().collect()}
    assert found.pop(None) is None
    assert found == expected_bands(values, bands)


def test_freight_bands_are_of_equal_size(spark):
    fact = spark.range(1000).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("p").alias("product_id"),
        (F.col("id") % 10 == 0).alias("is_late"),
        (F.col("id") % 97).cast("decimal(10,2)").alias("freight_value"),
    )
    dims = spark.createDataFrame([("p", Decimal(1))], "product_id string, weight_g decimal(10,2)")
    report = kpi.late_by_quantile(fact, dims, "freight_value", 5)
    rows = sorted(report.collect())
    assert [r.band for r in rows] == [0, 1, 2, 3, 4] and sum(r.n_orders for r in rows) == 1000
    assert all(a.greatest < b.least for a, b in zip(rows, rows[1:]))
    assert max(r.n_items for r in rows) - min(r.n_items for r in rows) <= 2 * 11


def test_trends_equal_numpy(spark):
    rng = random.Random(5)
    lines, sizes = [], {}
    for p in range(20):
        sizes[f"p{p}"] = (Decimal(rng.randrange(1, 10**6)) / 100, Decimal(rng.randrange(1, 10**5)) / 100)
    for i in range(400):
        product = f"p{rng.randrange(22)}"
        delay = None if i % 9 == 0 else rng.randrange(-20, 40)
        lines.append((f"o{i}", product, bool(delay and delay > 5), delay, Decimal(rng.randrange(5000)) / 100))
    fact = spark.createDataFrame(
        lines, "order_id string, product_id string, is_late boolean, delay_days int, freight_value decimal(10,2)"
    )
    dims = spark.createDataFrame(
        [(k, *v) for k, v in sizes.items()], "product_id string, product_volume_cm3 decimal(32,6), weight_g decimal(10,2)"
    )
    found = {r.measure: r for r in kpi.delay_trend(fact, dims).collect()}
    for at, measure in enumerate(("product_volume_cm3", "weight_g", "freight_value")):
        points = [
            (float(line[4] if at == 2 else sizes[line[1]][at]), line[3], line[2])
            for line in lines
            if line[3] is not None and (at == 2 or line[1] in sizes)
        ]
        x, y, late = np.array(points, dtype=float).T
        r = found[measure]
        assert r.n_items == len(points)
        assert r.days_per_unit == pytest.approx(np.polyfit(x, y, 1)[0], abs=2e-9, rel=1e-6)
        assert r.corr_delay == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-8)
        assert r.corr_late == pytest.approx(np.corrcoef(x, late)[0, 1], abs=1e-8)


def test_trends_of_nothing_and_of_one_value(spark):
    schema = "order_id string, product_id string, is_late boolean, delay_days int, freight_value decimal(10,2)"
    dims = spark.createDataFrame([], "product_id string, product_volume_cm3 decimal(32,6), weight_g decimal(10,2)")
    assert kpi.delay_trend(spark.createDataFrame([], schema), dims).count() == 0
    same = spark.createDataFrame([("o", "p", True, 3, Decimal(1))] * 2, schema)
    rows = kpi.delay_trend(same, dims).collect()
    assert [tuple(r) for r in rows] == [("freight_value", 2, None, None, None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_of_undelivered_orders_are_not_shuffled(spark):
    """The delivered orders are broadcast below the only shuffle of items."""
    orders = queries.orders(spark, SF_DIR)
    plan = plan_of(gold.fact_of_raw(raw.raw_items(spark, SF_DIR), orders))
    top = plan[: plan.index("BroadcastExchange")]
    assert top.count("Exchange hashpartitioning") == 1
    assert top.index("Exchange hashpartitioning") < top.index("BroadcastHashJoin")


def test_the_fact_is_the_same_either_way(spark, shuffle_joins):
    items, orders = raw.raw_items(spark, SF_DIR), queries.orders(spark, SF_DIR)
    # Older rows of the same keys, and items of orders that do not exist.
    more = items.withColumn("shipping_limit_date", F.lit("1990-01-01 00:00:00"))
    lost = items.limit(50).withColumn("order_id", F.lit("none"))
    items = items.unionByName(more).unionByName(lost)
    plain = sorted(map(str, gold.orders_fact(silver.orders_items(items), orders, items).collect()))
    assert sorted(map(str, gold.fact_of_raw(items, orders).collect())) == plain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    found = gold.fact_of_raw(items, orders)
    assert "BroadcastHashJoin" in plan_of(found)
    assert sorted(map(str, found.collect())) == plain
