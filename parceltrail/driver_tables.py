"""The driver's order, item, part and supplier tables in the shape of the raw layer (all text).

Cases that the driver tables lack are derived from the keys: older copies of some rows, missing
purchase and delivery times, categories and unknown states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lower-case codes, one for each remainder of the seller's key; the last one is unknown to the region rule.
STATES = "sp rj mg es pr sc rs ac ap am pa ro rr to al ba ce ma pb pe pi rn se df go mt ms xx".split()
# Cities in mixed case, which the clean layer has to change.
CITIES = ["mogi-guacu d'oeste", "SAO PAULO", "Embu-GUACU", "são JOSÉ"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_copies(df: DataFrame, key: str) -> DataFrame:
    """Add ``version`` 0 to every row and a second row with version 1 to every tenth key."""
    versions = F.when(F.col(key) % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("version", F.explode(versions))


def _interval(
    days: Column | int = 0, hours: Column | int = 0, secs: Column | int = 0
) -> Column:
    days, hours = (F.lit(part).cast("int") for part in (days, hours))
    return F.make_dt_interval(days, hours, F.lit(0), F.lit(secs))


def _text(col: Column, name: str) -> Column:
    return col.cast("string").alias(name)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 is an older state of the same order. Estimates are 30 days after the order date."""
    key, day, version = F.col("o_orderkey"), F.col("o_orderdate"), F.col("version")
    status = (
        F.when(version == 1, "CREATED")
        .when(F.col("o_orderstatus") == "F", "DELIVERED")
        .when(F.col("o_orderstatus") == "O", "SHIPPED")
        .otherwise("CANCELED")
    )
    purchase = F.when(
        (version == 1) | (key % 97 != 0),
        day + _interval(secs=(key * 37) % 86400) - _interval(hours=version),
    )
    delivered = F.when(
        key % 50 != 0, day + _interval((key * 7 + F.col("o_custkey")) % 60, key % 24)
    )
    rows = _with_copies(table(spark, sf_dir, "orders"), "o_orderkey")
    return rows.select(
        _text(key, "order_id"),
        _text(F.col("o_custkey"), "customer_id"),
        status.alias("order_status"),
        _text(purchase, "order_purchase_timestamp"),
        _text(purchase + _interval(hours=1), "order_approved_at"),
        _text(day + _interval(2), "order_delivered_carrier_date"),
        _text(delivered, "order_delivered_customer_date"),
        _text(day + _interval(30), "order_estimated_delivery_date"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line item table repeats (order, line) keys, so no copies are added."""
    return table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey"), "order_id"),
        _text(F.col("l_linenumber"), "order_item_id"),
        _text(F.col("l_partkey"), "product_id"),
        _text(F.col("l_suppkey"), "seller_id"),
        _text(F.col("l_shipdate"), "shipping_limit_date"),
        _text(F.col("l_extendedprice").cast("decimal(10,2)"), "price"),
        _text(F.col("l_quantity").cast("decimal(10,2)"), "freight_value"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of type PROMO have no category; version 1 has a longer name."""
    size = F.col("p_size")
    category = F.concat(
        F.nullif("p_type", F.lit("PROMO")), F.lit("_"), F.translate("p_name", " ", "_")
    )
    return _with_copies(table(spark, sf_dir, "part"), "p_partkey").select(
        _text(F.col("p_partkey"), "product_id"),
        category.alias("product_category_name"),
        _text(F.length("p_name") + F.col("version"), "product_name_lenght"),
        _text(F.length("p_type"), "product_description_lenght"),
        _text(size % 7, "product_photos_qty"),
        _text(F.col("p_retailprice").cast("decimal(10,2)"), "product_weight_g"),
        _text(size, "product_length_cm"),
        _text(size + 1, "product_height_cm"),
        _text(size + 2, "product_width_cm"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 has a greater postcode."""
    states, cities = (F.array(*[F.lit(s) for s in names]) for names in (STATES, CITIES))
    key = F.col("s_suppkey")
    return _with_copies(table(spark, sf_dir, "supplier"), "s_suppkey").select(
        _text(F.col("s_suppkey"), "seller_id"),
        F.lpad((F.col("s_suppkey") + F.col("version")).cast("string"), 12, "0").alias(
            "seller_zip_code_prefix"
        ),
        F.concat_ws(
            " ", F.element_at(cities, (key % len(CITIES) + 1).cast("int")), F.translate("s_name", "#", "-")
        ).alias("seller_city"),
        F.element_at(states, (key % len(STATES) + 1).cast("int")).alias("seller_state"),
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any table will do: geolocation is loaded and not read again."""
    return table(spark, sf_dir, "customer").select(
        _text(F.col("c_custkey"), "geolocation_zip_code_prefix"),
        F.col("c_name").alias("geolocation_city"),
    )
