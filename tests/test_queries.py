"""Every registered query against its SQL counterpart, with broadcast and with shuffle joins."""

import pytest

from __spark_entry__ import entry
from parceltrail.oracle import ORACLE
from parceltrail.queries import QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


@pytest.mark.parametrize(
    "name",
    ["gold_fact", "star_join", "kpi_late_by_category", "kpi_late_grouping_sets", "kpi_delay_by_volume",
     "kpi_late_by_month", "kpi_seller_ranking"],
)
def test_query_equals_sql_with_shuffle_joins(spark, shuffle_joins, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry_returns_ten_sellers(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize(
    "name", ["silver_orders", "gold_dim_date", "calendar_at_midnight", "csv_roundtrip", "delay_fractional"]
)
def test_results_do_not_depend_on_the_time_zone(spark, con, name):
    setting = "spark.sql.session.timeZone"
    before = spark.conf.get(setting)
    # A zone whose clock changes at midnight: some local midnights do not exist.
    spark.conf.set(setting, "America/Sao_Paulo")
    try:
        problem = differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    finally:
        spark.conf.set(setting, before)
    assert problem is None
