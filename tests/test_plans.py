"""Shape of the physical plans."""

import re

import pytest

from parceltrail import driver_tables as raw
from parceltrail import queries as q
from parceltrail.plans import gold, layers, silver
from parceltrail.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NO_WRITES = sorted(set(QUERIES) - {
    "csv_roundtrip", "csv_quoted_text", "csv_mixed_files", "replace_load", "people_documents", "layers_end_to_end"
})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_WRITES)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct|NestedLoopJoin", plan)


@pytest.mark.parametrize("name", [n for n in NO_WRITES if n.startswith(("kpi", "gold", "star"))])
def test_shuffle_joins_broadcast_bounded_lists_only(spark, shuffle_joins, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|CartesianProduct|NestedLoopJoin", plan)
    for exchange in plan.split("BroadcastExchange")[1:]:
        # The list of hot keys, the hot buckets below it, or the ranks of distinct counts.
        top = "\n".join(exchange.splitlines()[:4])
        assert re.search(r"_parts|_most|rank", top), top


@pytest.mark.parametrize(
    "name", ["silver_orders", "silver_items", "silver_products", "silver_sellers"]
)
def test_dedup_cuts_rows_before_its_only_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1
    above, below = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_dimensions_of_stored_tables_do_not_shuffle(spark, tmp_path):
    for build, source in (
        (gold.dim_sellers, q.sellers),
        (gold.dim_products, q.products),
    ):
        path = str(tmp_path / source.__name__)
        source(spark, SF_DIR).write.parquet(path)
        plan = plan_of(build(spark.read.parquet(path)))
        assert "Exchange" not in plan


def test_fact_pushes_the_status_filter_and_prunes_columns(spark, tmp_path):
    silver.orders(raw.raw_orders(spark, SF_DIR)).write.parquet(str(tmp_path / "orders"))
    silver.orders_items(raw.raw_items(spark, SF_DIR)).write.parquet(str(tmp_path / "items"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    items = spark.read.parquet(str(tmp_path / "items"))
    plan = plan_of(gold.orders_fact(items, orders))
    assert "EqualTo(order_status,delivered)" in plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert any("order_status" in s and "customer_id" not in s for s in scans)
    assert any("freight_value" in s for s in scans)
    assert all("shipping_limit_date" not in s and "updated_at" not in s for s in scans)


def test_star_join_reads_each_table_a_few_times(spark, shuffle_joins):
    plan = plan_of(QUERIES["star_join"](spark, SF_DIR))
    assert plan.count("FileScan") < 15


def test_calendar_bounds_need_no_item_window(spark):
    orders, items = raw.raw_orders(spark, SF_DIR), raw.raw_items(spark, SF_DIR)
    plan = plan_of(gold.purchases(items, silver.orders(orders)))
    assert "l_linenumber" not in plan and "l_extendedprice" not in plan


def test_grouping_sets_expand_folded_rows(spark):
    plan = plan_of(QUERIES["kpi_late_grouping_sets"](spark, SF_DIR))
    below = plan[plan.index("Expand") :]
    assert below.index("HashAggregate") < below.index("Join")


def test_calendar_report_joins_days_only(spark):
    plan = plan_of(QUERIES["kpi_late_by_month"](spark, SF_DIR))
    join = plan.index("date_id")
    assert "HashAggregate" in plan[join:]


def test_every_registered_layer_has_a_builder():
    assert {raw_table for raw_table, _ in layers.SILVER.values()} == {
        "bronze_orders", "bronze_orders_items", "bronze_products", "bronze_sellers"
    }
