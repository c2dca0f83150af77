"""The calendar is part of the plan: nothing runs when it is built."""

from datetime import datetime

import pytest

from parceltrail.operators.series import LONGEST, daily_series
from parceltrail.plans import gold, kpi
from parceltrail.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def jobs(spark):
    """Function counting the jobs since the test began."""
    context = spark.sparkContext
    context.setJobGroup("lazy-calendar", "building plans")
    before = set(context.statusTracker().getJobIdsForGroup("lazy-calendar"))
    yield lambda: len(set(context.statusTracker().getJobIdsForGroup("lazy-calendar")) - before)
    context.setLocalProperty("spark.jobGroup.id", None)


def fact_of(spark, *times):
    rows = [(datetime.fromisoformat(t),) for t in times]
    return spark.createDataFrame(rows, "purchase_timestamp timestamp_ntz")


def test_building_a_calendar_runs_no_job(spark, jobs):
    fact = fact_of(spark, "2018-01-02 09:00:00", "2017-12-30 10:00:00")
    calendar = gold.dim_date(fact)
    assert jobs() == 0
    assert calendar.count() == 3
    assert jobs() > 0


@pytest.mark.parametrize("align", [False, True])
def test_the_longest_calendar(spark, align):
    fact = fact_of(spark, "0001-01-01 00:00:00", "9999-12-31 23:59:59")
    days = daily_series(fact, "purchase_timestamp", "day", align)
    assert days.count() == LONGEST
    first, last = days.selectExpr("cast(min(day) as string)", "cast(max(day) as string)").first()
    assert (first, last) == ("0001-01-01 00:00:00", "9999-12-31 00:00:00")


def test_catalyst_knows_the_upper_bound(spark):
    days = daily_series(fact_of(spark, "2018-01-02 09:00:00"), "purchase_timestamp", "day")
    size = days._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert LONGEST * 8 <= size <= LONGEST * 64


def test_bounds_of_two_columns(spark):
    rows = [(datetime(2020, 1, 1, 5), datetime(2020, 1, 1, 20)), (datetime(2020, 1, 3, 1), datetime(2020, 1, 3, 6))]
    days = spark.createDataFrame(rows, "lo timestamp_ntz, hi timestamp_ntz")
    assert daily_series(days, "lo", "day", last="hi").count() == 3


def test_reports_by_day_equal_reports_by_a_stored_calendar(spark, tmp_path):
    fact = QUERIES["gold_fact"](spark, SF_DIR)
    QUERIES["gold_dim_date"](spark, SF_DIR).write.parquet(str(tmp_path / "calendar"))
    stored = spark.read.parquet(str(tmp_path / "calendar"))
    for name, attributes in (("kpi_late_by_month", ("year", "month")), ("kpi_late_by_weekday", ("day_of_week", "day_name"))):
        one = sorted(map(str, QUERIES[name](spark, SF_DIR).collect()))
        assert one == sorted(map(str, kpi.late_by_calendar(fact, stored, *attributes).collect()))
        assert one


def test_the_month_report_reads_the_fact_once(spark):
    """The bounds reuse the days' exchange."""
    report = QUERIES["kpi_late_by_month"](spark, SF_DIR)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
