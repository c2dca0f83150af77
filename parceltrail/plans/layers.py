"""The whole run: raw files to clean tables to star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from parceltrail.plans import bronze, gold, silver
from parceltrail.session import require_ansi
from parceltrail.sinks.layers import LayerStore

# Clean table -> (raw table, builder).
SILVER = {
    "orders": ("bronze_orders", silver.orders),
    "orders_items": ("bronze_orders_items", silver.orders_items),
    "products": ("bronze_products", silver.products),
    "sellers": ("bronze_sellers", silver.sellers),
}

# Columns by which tables are joined; their hot values are found while the tables are written.
JOIN_COLUMNS = {
    "orders_items": ("order_id",),
    "orders_fact": ("order_id", "product_id", "seller_id"),
}


def load_bronze(
    store: LayerStore,
    data_path: str,
    sources: Mapping[str, str] = bronze.SOURCES,
    run_ts: datetime | None = None,
    **csv_options: bool | None,
) -> None:
    """Replace the raw tables; ``sources`` maps a table to a file pattern below ``data_path``."""

    def reader(pattern: str) -> Callable[[], DataFrame]:
        path = f"{data_path.rstrip('/')}/{pattern}"
        return lambda: bronze.load_csv(store.spark, path, run_ts, **csv_options)

    with store.load("bronze") as load:
        load.write_all({table: reader(p) for table, p in sources.items()})


def build_silver(store: LayerStore, run_ts: datetime | None = None) -> None:
    require_ansi(store.spark)

    bronze_tables = store.snapshot("bronze")

    def builder(raw: str, build: Callable) -> Callable[[], DataFrame]:
        return lambda: build(bronze_tables.read(raw), run_ts)

    with store.load("silver") as load:
        load.write_all({table: builder(*parts) for table, parts in SILVER.items()}, JOIN_COLUMNS)


def build_gold(store: LayerStore) -> None:
    clean = store.snapshot("silver")

    def fact() -> DataFrame:
        items, orders = clean.read("orders_items"), clean.read("orders")
        return gold.orders_fact(items, orders, clean.hot_keys("orders_items"))

    with store.load("gold") as load:
        load.write_all(
            {
                "orders_fact": fact,
                "dim_sellers": lambda: gold.dim_sellers(clean.read("sellers")),
                "dim_products": lambda: gold.dim_products(clean.read("products")),
            },
            JOIN_COLUMNS,
        )
        # The calendar spans the purchases of the stored fact.
        load.write("dim_date", gold.dim_date(load.read("orders_fact")))


def run(
    spark: SparkSession,
    data_path: str,
    warehouse: str,
    sources: Mapping[str, str] = bronze.SOURCES,
    prefix: str = "",
    run_ts: datetime | None = None,
    keep: int | None = None,
    **csv_options: bool | None,
) -> LayerStore:
    """Raw, clean, star schema, in that order; each layer reads one state of the one before and is replaced as a whole.

    Running again replaces every table, so a repeated run gives the same tables. ``keep``: states of each layer whose
    loads stay; without it, none is removed.
    """
    store = LayerStore(spark, warehouse, prefix)
    load_bronze(store, data_path, sources, run_ts, **csv_options)
    build_silver(store, run_ts)
    build_gold(store)
    if keep is not None:
        for layer in ("bronze", "silver", "gold"):
            store.clean(layer, keep)
    return store


def star(store: LayerStore) -> dict[str, DataFrame]:
    """The stored fact and dimensions by table name, all of one state of the layer."""
    tables = store.snapshot("gold")
    return {table: tables.read(table) for table in ("orders_fact", "dim_sellers", "dim_products", "dim_date")}


def wide_star(store: LayerStore) -> DataFrame:
    """The stored fact with the attributes of its dimensions; building it runs no job."""
    tables = store.snapshot("gold")
    dims = (tables.read(t) for t in ("dim_products", "dim_sellers", "dim_date"))
    return gold.wide_fact(tables.read("orders_fact"), *dims, count_on=tables.hot_keys("orders_fact"))
