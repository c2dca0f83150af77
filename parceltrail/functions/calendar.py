"""Calendar attributes of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(ts: Column) -> Column:
    """Integer day key, 20171230 for 30 December 2017."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def padded_name(ts: Column, pattern: str) -> Column:
    """English month (``MMMM``) or day (``EEEE``) name, blank-padded to 9 characters."""
    return F.rpad(F.date_format(ts, pattern), 9, " ")


def day_of_week(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday (Spark's own ``dayofweek`` starts at 1)."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return day_of_week(ts).isin(0, 6)
