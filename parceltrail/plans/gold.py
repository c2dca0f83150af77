"""Star schema: one fact at order-item grain and three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.functions import calendar as cal
from parceltrail.functions.delivery import DELIVERED, region_of
from parceltrail.operators.joins import HotKeys, fits_broadcast, lookup_join
from parceltrail.operators.series import daily_series
from parceltrail.plans import silver

_OUTCOME = ("purchase_timestamp", "delay_days", "is_late")


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == DELIVERED).select("order_id", *_OUTCOME)


def delivered_items(
    items: DataFrame, orders: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    """Items of delivered orders with the delivery outcome of their order.

    ``count_on`` may name the raw items, on which hot orders are cheaper to count than on
    ``items`` when the latter are not stored yet.
    """
    delivered = _delivered(orders)
    wanted = items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )
    return _with_total(lookup_join(wanted, delivered, "order_id", "inner", count_on))


def _with_total(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "purchase_timestamp",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_amount"),
        "delay_days",
        "is_late",
    )


def orders_fact(
    items: DataFrame, orders: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    """One row per item of a delivered order, without the item's number."""
    return delivered_items(items, orders, count_on).drop("order_item_id")


def fact_of_raw(raw_items: DataFrame, orders: DataFrame) -> DataFrame:
    """The fact straight from the raw items.

    If Catalyst broadcasts the delivered orders, the items meet them before they are deduplicated: a key holds its
    order, so an order's outcome is the same for all rows of a key, and no item of an undelivered order is shuffled. Beyond
    that the join would be a shuffle of its own, which the deduplication would have to follow with another.
    """
    delivered = _delivered(orders)
    if not fits_broadcast(delivered):
        return orders_fact(silver.orders_items(raw_items), orders, count_on=raw_items)
    met = raw_items.join(delivered, "order_id")
    return _with_total(silver.orders_items(met, carried=_OUTCOME)).drop("order_item_id")


def purchases(raw_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Times of purchase of the delivered orders that have items: those of the fact.

    Deduplicated items have the same orders as the raw ones, so the items need no other column and no window.
    """
    ordered = raw_items.select("order_id").distinct()
    delivered = orders.where(F.col("order_status") == DELIVERED).select("order_id", "purchase_timestamp")
    return delivered.join(ordered, "order_id", "left_semi").select("purchase_timestamp")


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "city", "state", region_of(F.col("state")).alias("region"))


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category",
        "weight_g",
        (F.col("length_cm") * F.col("height_cm") * F.col("width_cm")).alias("product_volume_cm3"),
    )


def dim_date(
    fact: DataFrame, ts: str = "purchase_timestamp", align_to_midnight: bool = False, last: str | None = None
) -> DataFrame:
    """Calendar from the first to the last purchase in 24-hour steps (see ``daily_series``)."""
    day = F.col("full_date")
    return daily_series(fact, ts, "full_date", align_to_midnight, last).select(
        cal.date_id(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        cal.padded_name(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        cal.day_of_week(day).alias("day_of_week"),
        cal.padded_name(day, "EEEE").alias("day_name"),
        cal.is_weekend(day).alias("is_weekend"),
    )


def wide_fact(
    fact: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    dim_date: DataFrame,
    count_on: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """The fact with the attributes of all its dimensions; NULL where a dimension row is missing.

    The fact has no day key; it is derived from the time of purchase. Hot products and sellers are counted on
    ``count_on``, which should be a raw or stored table; without it, on the fact. The calendar is left to Catalyst and
    adaptive execution: nothing before is partitioned by day, so hot days are split at run time if it is not broadcast.
    """
    raw = fact if count_on is None else count_on
    with_products = lookup_join(fact, dim_products, "product_id", "left", raw)
    with_sellers = lookup_join(with_products, dim_sellers, "seller_id", "left", raw)
    day = cal.date_id(F.col("purchase_timestamp")).alias("date_id")
    return with_sellers.select("*", day).join(dim_date, "date_id", "left")
