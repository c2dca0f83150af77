"""Delivery rules: delay, lateness, region of a seller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DELIVERED = "delivered"

# State codes of each region.
REGION_STATES = {
    "Sudeste": ["SP", "RJ", "MG", "ES"],
    "Sul": ["PR", "SC", "RS"],
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
}


def delay_days(status: Column, delivered: Column, estimated: Column) -> Column:
    """Whole 24-hour days between promise and delivery, cut toward zero; NULL if not delivered.

    ``datediff`` would count midnights instead: 15 hours early is 0 days here, not -1.
    """
    days = F.extract(F.lit("DAY"), delivered - estimated).cast("int")
    return F.when(status == DELIVERED, days)


def is_late(status: Column, delivered: Column, estimated: Column) -> Column:
    """True for a delivery after the promised moment, however short; never NULL."""
    return F.coalesce((status == DELIVERED) & (delivered > estimated), F.lit(False))


def region_of(state: Column) -> Column:
    """Region of an upper-case state code; NULL for an unknown one."""
    (first, codes), *others = REGION_STATES.items()
    return reduce(
        lambda expr, item: expr.when(state.isin(item[1]), item[0]),
        others,
        F.when(state.isin(codes), first),
    )
