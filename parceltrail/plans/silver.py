"""Clean layer: typed columns, one row per key, delivery rules.

Every builder casts first and deduplicates after. A value that cannot be cast fails the load even
in a row that deduplication would drop, and the shuffled rows are narrow: 8-byte timestamps and
decimals instead of text. "Latest" compares the raw text of the date column, which is carried along
for that purpose.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.delivery import delay_days, is_late
from parceltrail.functions.text import capitalise_words, category_label
from parceltrail.operators.dedup import latest_per_key


def _timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def _amount(name: str) -> Column:
    return F.col(name).cast("decimal(10,2)")


def _integer(name: str) -> Column:
    return F.col(name).cast("int")


def _updated_at(run_ts: datetime | None) -> Column:
    """The given clock, read in the session's time zone, or the current time."""
    now = F.lit(str(run_ts)).cast("timestamp") if run_ts else F.current_timestamp()
    return now.alias("updated_at")


def orders(bronze: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    typed = bronze.select(
        "order_id",
        "customer_id",
        F.lower("order_status").alias("order_status"),
        _timestamp("order_purchase_timestamp").alias("purchase_timestamp"),
        _timestamp("order_approved_at").alias("approved_at"),
        _timestamp("order_delivered_carrier_date").alias("delivered_carrier_date"),
        _timestamp("order_delivered_customer_date").alias("delivered_customer_date"),
        _timestamp("order_estimated_delivery_date").alias("estimated_delivery_date"),
        F.col("order_purchase_timestamp").alias("purchase_text"),
    )
    rule_inputs = [
        F.col(c) for c in ("order_status", "delivered_customer_date", "estimated_delivery_date")
    ]
    return latest_per_key(typed, ["order_id"], ["purchase_text"]).select(
        *[c for c in typed.columns if c != "purchase_text"],
        delay_days(*rule_inputs).alias("delay_days"),
        is_late(*rule_inputs).alias("is_late"),
        _updated_at(run_ts),
    )


def orders_items(
    bronze: DataFrame, run_ts: datetime | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """``carried`` names columns of the rows that go through as they are; rows of one key must agree on them."""
    typed = bronze.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        _timestamp("shipping_limit_date").alias("shipping_limit_date"),
        _amount("price").alias("price"),
        _amount("freight_value").alias("freight_value"),
        F.col("shipping_limit_date").alias("limit_text"),
        *carried,
    )
    return latest_per_key(typed, ["order_id", "order_item_id"], ["limit_text"]).select(
        *[c for c in typed.columns if c != "limit_text"],
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
        _updated_at(run_ts),
    )


def products(bronze: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    typed = bronze.select(
        "product_id",
        "product_category_name",
        _integer("product_name_lenght").alias("name_length"),
        _integer("product_description_lenght").alias("description_length"),
        _integer("product_photos_qty").alias("photos_qty"),
        _amount("product_weight_g").alias("weight_g"),
        _amount("product_length_cm").alias("length_cm"),
        _amount("product_height_cm").alias("height_cm"),
        _amount("product_width_cm").alias("width_cm"),
    )
    return latest_per_key(typed, ["product_id"]).select(
        "product_id",
        category_label(F.col("product_category_name")).alias("product_category"),
        *typed.columns[2:],
        _updated_at(run_ts),
    )


def sellers(bronze: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    typed = bronze.select(
        "seller_id",
        _integer("seller_zip_code_prefix").alias("zip_code_prefix"),
        "seller_city",
        F.upper("seller_state").alias("state"),
    )
    return latest_per_key(typed, ["seller_id"]).select(
        "seller_id",
        "zip_code_prefix",
        capitalise_words(F.col("seller_city")).alias("city"),
        "state",
        _updated_at(run_ts),
    )
