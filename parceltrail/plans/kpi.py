"""Reports on the star schema.

The fact repeats an order's outcome on each of its items, so every report first reduces to one row
per (attribute, order) and only then counts. Both steps pre-aggregate before their shuffle; the
first spreads a large attribute value over its orders, the second moves one row per attribute value
and task. Ratios are left unrounded.

Reports that join a dimension take ``count_on``, as in ``operators.joins``: a table on which hot keys
are cheaper to count than on the fact, if the fact is not stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.calendar import date_id
from parceltrail.operators.joins import HotKeys, fits_broadcast, split_join
from parceltrail.operators.quantiles import quantile_bands, with_band
from parceltrail.operators.ranking import rank_by_count, top_by_count

# Order-level measures, each with an aggregate that may be applied again to its own result.
_OUTCOME = {"is_late": F.max, "delay_days": F.max}


def _fold(measures: Mapping[str, Callable[[str], Column]]) -> list[Column]:
    return [fold(name).alias(name) for name, fold in measures.items()]


def _n_late() -> Column:
    return F.count_if("is_late").alias("n_late")


def _n_orders() -> Column:
    return F.count("*").alias("n_orders")


def _ratio(total: str, count: str, name: str) -> Column:
    # Nothing counted gives NULL, not a division error.
    return (F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0))).alias(name)


def _pct(part: str, whole: str, name: str) -> Column:
    return (F.lit(100.0) * F.col(part) / F.nullif(F.col(whole), F.lit(0))).alias(name)


def _attach(
    lines: DataFrame,
    dim: DataFrame,
    key: str,
    attributes: Sequence[str],
    count_on: DataFrame | HotKeys | None,
    measures: Mapping[str, Callable[[str], Column]] = _OUTCOME,
) -> DataFrame:
    """Left join of dimension attributes; facts without a dimension row get NULL.

    Before a shuffle join, rows that differ in nothing but their measures become one row, so that
    no group of copies is left which a split by content could not divide.
    """
    dim = dim.select(key, *attributes)
    if fits_broadcast(dim):
        return lines.join(dim, key, "left")
    others = [c for c in lines.columns if c not in measures]
    folded = lines.groupBy(*others).agg(*_fold(measures))
    return split_join(folded, dim, key, "left", lines if count_on is None else count_on)


def _orders_by(
    fact: DataFrame,
    attribute: str,
    dim: DataFrame | None = None,
    key: str | None = None,
    count_on: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """(attribute, order) rows with the order's outcome."""
    lines = fact.select(key or attribute, "order_id", "is_late", "delay_days")
    if dim is not None:
        lines = _attach(lines, dim, key, [attribute], count_on)
    return lines.groupBy(attribute, "order_id").agg(*_fold(_OUTCOME))


def _late_share(orders: DataFrame, *keys: str) -> DataFrame:
    counted = orders.groupBy(*keys).agg(_n_orders(), _n_late())
    return counted.select("*", _pct("n_late", "n_orders", "pct_late"))


def sla(fact: DataFrame) -> DataFrame:
    """Share of orders delivered on time; orders without a delivery date count as not late."""
    orders = fact.groupBy("order_id").agg(*_fold(_OUTCOME))
    counted = orders.agg(
        _n_orders(), _n_late(), F.count_if(F.col("delay_days").isNull()).alias("n_unknown")
    ).withColumn("n_on_time", F.col("n_orders") - F.col("n_late"))
    return counted.select(
        "*", _pct("n_on_time", "n_orders", "pct_on_time"), _pct("n_late", "n_orders", "pct_late")
    )


def late_share_of_all_orders(orders: DataFrame) -> DataFrame:
    """Late orders against all orders of the clean layer, delivered or not."""
    return _late_share(orders)


def late_by_category(
    fact: DataFrame, dim_products: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    return _late_share(
        _orders_by(fact, "product_category", dim_products, "product_id", count_on), "product_category"
    )


def late_by_region(
    fact: DataFrame, dim_sellers: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    return _late_share(_orders_by(fact, "region", dim_sellers, "seller_id", count_on), "region")


def late_by_seller(fact: DataFrame) -> DataFrame:
    return _late_share(_orders_by(fact, "seller_id"), "seller_id")


def late_by_all(
    fact: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    count_on: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """Category, region and seller breakdowns in one pass over the fact.

    ``breakdown`` names the attribute a row belongs to; the other two are NULL.
    """
    attributes = ["product_category", "region", "seller_id"]
    lines = fact.select("product_id", "seller_id", "order_id", "is_late", "delay_days")
    lines = _attach(lines, dim_products, "product_id", ["product_category"], count_on)
    lines = _attach(lines, dim_sellers, "seller_id", ["region"], count_on)
    # One row for each order and combination, before the grouping sets triple them.
    lines = lines.groupBy(*attributes, "order_id").agg(F.max("is_late").alias("is_late"))
    # One bit per grouping column, 0 where the column is part of the grouping set.
    breakdown = (
        F.when(F.grouping_id() == 0b0110, "category")
        .when(F.grouping_id() == 0b1010, "region")
        .otherwise("seller")
    )
    orders = lines.groupingSets(
        [[a, "order_id"] for a in attributes], *attributes, "order_id"
    ).agg(F.max("is_late").alias("is_late"), breakdown.alias("breakdown"))
    return _late_share(orders, "breakdown", *attributes)


def _average_delay(orders: DataFrame, key: str) -> DataFrame:
    """Mean delay over all dated orders (early ones count negative) and over late ones only."""
    late_days = F.when(F.col("is_late"), F.col("delay_days"))
    summed = orders.groupBy(key).agg(
        F.count("delay_days").alias("n_dated"),
        F.sum("delay_days").alias("sum_delay_days"),
        F.count(late_days).alias("n_late"),
        F.sum(late_days).alias("sum_late_days"),
    )
    return summed.select(
        "*",
        _ratio("sum_delay_days", "n_dated", "avg_delay_days"),
        _ratio("sum_late_days", "n_late", "avg_late_days"),
    )


def average_delay_by_seller(fact: DataFrame) -> DataFrame:
    return _average_delay(_orders_by(fact, "seller_id"), "seller_id")


def average_delay_by_category(
    fact: DataFrame, dim_products: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    return _average_delay(
        _orders_by(fact, "product_category", dim_products, "product_id", count_on), "product_category"
    )


def average_delay_by_region(
    fact: DataFrame, dim_sellers: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    return _average_delay(_orders_by(fact, "region", dim_sellers, "seller_id", count_on), "region")


def seller_ranking(fact: DataFrame) -> DataFrame:
    """Every seller with its rank by number of late orders."""
    return rank_by_count(late_by_seller(fact), "n_late")


def top_offenders(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k sellers with most late orders."""
    return top_by_count(late_by_seller(fact), "n_late", "seller_id", k)


def top_categories(
    fact: DataFrame, dim_products: DataFrame, count_on: DataFrame | HotKeys | None = None, k: int = 10
) -> DataFrame:
    """The k categories with most late orders."""
    late = late_by_category(fact, dim_products, count_on)
    return top_by_count(late, "n_late", "product_category", k)


def top_regions(
    fact: DataFrame, dim_sellers: DataFrame, count_on: DataFrame | HotKeys | None = None, k: int = 10
) -> DataFrame:
    """The k regions with most late orders."""
    return top_by_count(late_by_region(fact, dim_sellers, count_on), "n_late", "region", k)


def top_sellers_by_delay(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k sellers whose late orders are late by most days on average."""
    return top_by_count(average_delay_by_seller(fact), "avg_late_days", "seller_id", k)


def top_categories_by_delay(
    fact: DataFrame, dim_products: DataFrame, count_on: DataFrame | HotKeys | None = None, k: int = 10
) -> DataFrame:
    """The k categories whose late orders are late by most days on average."""
    delays = average_delay_by_category(fact, dim_products, count_on)
    return top_by_count(delays, "avg_late_days", "product_category", k)


def late_by_day(fact: DataFrame) -> DataFrame:
    """Orders and late ones of each day of purchase, with its first and last time of purchase."""
    orders = fact.groupBy("order_id").agg(
        F.max("is_late").alias("is_late"), F.max("purchase_timestamp").alias("purchase_timestamp")
    )
    return orders.groupBy(date_id(F.col("purchase_timestamp")).alias("date_id")).agg(
        F.min("purchase_timestamp").alias("first_purchase"),
        F.max("purchase_timestamp").alias("last_purchase"),
        _n_orders(),
        _n_late(),
    )


def days_by_calendar(days: DataFrame, dim_date: DataFrame, *attributes: str) -> DataFrame:
    """``late_by_day`` summed up by attributes of the calendar."""
    counted = (
        days.join(dim_date.select("date_id", *attributes), "date_id", "left")
        .groupBy(*attributes)
        .agg(F.sum("n_orders").alias("n_orders"), F.sum("n_late").alias("n_late"))
    )
    return counted.select("*", _pct("n_late", "n_orders", "pct_late"))


def late_by_calendar(fact: DataFrame, dim_date: DataFrame, *attributes: str) -> DataFrame:
    """Late orders by attributes of the purchase day.

    Orders are counted per day before the join, so it only sees one row per day.
    """
    return days_by_calendar(late_by_day(fact), dim_date, *attributes)


_BAND_MEASURES = {"is_late": F.max, "n_items": F.sum, "freight": F.sum}


def _by_band(lines: DataFrame) -> DataFrame:
    """Orders, late ones, items and freight of each band, from lines with these; bounds too if the lines have them."""
    extra = {c: f for c, f in (("least", F.min), ("greatest", F.max)) if c in lines.columns}
    orders = lines.groupBy("band", "order_id").agg(*_fold(_BAND_MEASURES | extra))
    counted = orders.groupBy("band").agg(
        *[f(c).alias(c) for c, f in extra.items()],
        _n_orders(),
        _n_late(),
        F.sum("n_items").alias("n_items"),
        F.sum("freight").cast("decimal(38,2)").alias("freight"),
    )
    return counted.select("*", _pct("n_late", "n_orders", "pct_late"))


def _lines_with_freight(fact: DataFrame, *more: Column) -> DataFrame:
    return fact.select(
        "product_id",
        "order_id",
        "is_late",
        F.lit(1).cast("bigint").alias("n_items"),
        F.col("freight_value").alias("freight"),
        *more,
    )


def late_by_size(
    fact: DataFrame,
    dim_products: DataFrame,
    measure: str,
    bounds: Sequence[int],
    count_on: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """Late orders and freight by band of a product measure; band 0 lies below the first bound."""
    band = F.when(F.col(measure) < bounds[0], 0)
    for number, bound in enumerate(bounds[1:], start=1):
        band = band.when(F.col(measure) < bound, number)
    band = band.when(F.col(measure).isNotNull(), len(bounds)).alias("band")
    bands = dim_products.select("product_id", band)
    return _by_band(_attach(_lines_with_freight(fact), bands, "product_id", ["band"], count_on, _BAND_MEASURES))


def late_by_quantile(
    fact: DataFrame,
    dim_products: DataFrame,
    measure: str,
    bands: int = 4,
    count_on: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """Late orders and freight by bands that the data give, with the least and the greatest value of each.

    A product's measure is banded over the products, the fact's freight over its items.
    """
    if measure == "freight_value":
        limits = quantile_bands(fact, measure, bands)
        lines = _lines_with_freight(fact, F.col("freight_value").alias("value"))
    else:
        limits = quantile_bands(dim_products, measure, bands)
        values = dim_products.select("product_id", F.col(measure).alias("value"))
        lines = _attach(_lines_with_freight(fact), values, "product_id", ["value"], count_on, _BAND_MEASURES)
    banded = with_band(lines, "value", limits)
    return _by_band(banded.withColumns({"least": F.col("value"), "greatest": F.col("value")}))


#: Measures whose influence on delays is asked for.
_SIZES = ("product_volume_cm3", "weight_g", "freight_value")


def delay_trend(
    fact: DataFrame, dim_products: DataFrame, count_on: DataFrame | HotKeys | None = None
) -> DataFrame:
    """How the delay of dated items goes with volume, weight and freight: slope in days a unit, and correlations.

    One pass: for each measure the sums of x, y and their products, exact in decimals; a task sends three rows.
    """
    lines = fact.select("product_id", "order_id", "is_late", "delay_days", "freight_value")
    dated = lines.where(F.col("delay_days").isNotNull())
    kept = {"n": F.sum}
    folded = dated.withColumn("n", F.lit(1).cast("bigint"))
    sized = _attach(folded, dim_products, "product_id", list(_SIZES[:2]), count_on, kept)
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("decimal(14,2)").alias("x")) for m in _SIZES])
    points = sized.select("n", "is_late", "delay_days", F.explode(pairs).alias("p")).select(
        "p.measure",
        "p.x",
        F.col("n").cast("decimal(10,0)").alias("w"),
        F.col("delay_days").cast("decimal(7,0)").alias("y"),
        F.col("is_late").cast("int").cast("decimal(1,0)").alias("late"),
    )
    products = {
        "n": F.lit(1), "sx": F.col("x"), "sy": F.col("y"), "sl": F.col("late"), "sxx": F.col("x") * F.col("x"),
        "sxy": F.col("x") * F.col("y"), "sxl": F.col("x") * F.col("late"), "syy": F.col("y") * F.col("y"),
    }
    sums = [F.sum((p * F.col("w")).cast("decimal(38,4)")).cast("double").alias(name) for name, p in products.items()]
    summed = points.where(F.col("x").isNotNull()).groupBy("measure").agg(*sums)

    def spread(a: str, b: str, ab: str) -> Column:
        return F.col("n") * F.col(ab) - F.col(a) * F.col(b)

    def ratio(top: Column, bottom: Column, digits: int) -> Column:
        return F.round(top / F.nullif(bottom, F.lit(0.0)), digits)

    xx, yy, ll = spread("sx", "sx", "sxx"), spread("sy", "sy", "syy"), spread("sl", "sl", "sl")
    return summed.select(
        "measure",
        F.col("n").cast("bigint").alias("n_items"),
        ratio(spread("sx", "sy", "sxy"), xx, 9).alias("days_per_unit"),
        ratio(spread("sx", "sy", "sxy"), F.sqrt(xx) * F.sqrt(yy), 9).alias("corr_delay"),
        ratio(spread("sx", "sl", "sxl"), F.sqrt(xx) * F.sqrt(ll), 9).alias("corr_late"),
    )
