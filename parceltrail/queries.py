"""Registered queries over the driver tables: name -> function of (session, folder)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail import driver_tables as raw
from parceltrail.driver_tables import table
from parceltrail.functions.delivery import delay_days, is_late
from parceltrail.functions.text import capitalise_words
from parceltrail.operators.dedup import latest_per_key
from parceltrail.plans import bronze, gold, kpi, layers, people, silver
from parceltrail.session import scratch_dir
from parceltrail.sinks.layers import LayerStore
from parceltrail.sources.csv_text import read_text_csv
from parceltrail.sources.people import documents_or_fallback, parse_documents

VOLUME_BOUNDS = (1_000, 27_000)
WEIGHT_BOUNDS = (930, 965)
MIXED_FILES = 32
# The clock of the queries that show when rows were processed.
RUN_TS = datetime(2024, 1, 15, 12, 30)


# --- layer tables -----------------------------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.orders(raw.raw_orders(spark, sf_dir)).drop("updated_at")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.orders_items(raw.raw_items(spark, sf_dir)).drop("updated_at")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.products(raw.raw_products(spark, sf_dir)).drop("updated_at")


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.sellers(raw.raw_sellers(spark, sf_dir)).drop("updated_at")


def _processed(build, raw_table):
    """Query of a clean table with the time of its processing, as the wall clock shows it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = build(raw_table(spark, sf_dir), RUN_TS)
        return rows.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))

    return query


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_of_raw(raw.raw_items(spark, sf_dir), orders(spark, sf_dir))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_products(products(spark, sf_dir))


def dim_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_sellers(sellers(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(gold.purchases(raw.raw_items(spark, sf_dir), orders(spark, sf_dir)))


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.wide_fact(
        fact(spark, sf_dir),
        dim_products(spark, sf_dir),
        dim_sellers(spark, sf_dir),
        dim_date(spark, sf_dir),
        count_on=raw.raw_items(spark, sf_dir),
    )


def dim_date_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(table(spark, sf_dir, "events"), "ts")


def calendar_at_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(table(spark, sf_dir, "events"), "ts", align_to_midnight=True)


# --- single operators -------------------------------------------------------------------------


def dedup_latest_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.raw_items(spark, sf_dir)
    latest = latest_per_key(rows, ["order_id", "order_item_id"], ["shipping_limit_date"])
    return latest.select(
        "order_id",
        "order_item_id",
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_date"),
    )


def dedup_latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return latest_per_key(events, ["user_id", "event_type"], ["ts"])


def dedup_any_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return latest_per_key(part.unionByName(part), ["p_partkey"])


def dedup_any_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return latest_per_key(supplier.unionByName(supplier), ["s_suppkey"])


def delay_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a delivery promised for one moment: all fractions of a day, both signs."""
    status = F.lit("delivered")
    promised = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id",
        delay_days(status, F.col("ts"), promised).alias("delay_days"),
        is_late(status, F.col("ts"), promised).alias("is_late"),
    )


def initcap_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.concat_ws("-", F.upper("p_name"), "p_brand", F.lit("d'oeste"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", capitalise_words(mixed).alias("words")
    )


def initcap_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word capitalisation of whole texts in several languages."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", capitalise_words(F.col("text")).alias("words")
    )


def casts_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(12,3)").cast("string").alias("o_totalprice"),
    )
    return text.select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("o_totalprice"),
    )


# --- sources and sinks ------------------------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV with blanks in the header and NA tokens, loaded and cast back."""
    path = scratch_dir(spark, "csv")
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" o_orderkey "),
        F.col("o_orderdate").alias("o_orderdate "),
        F.when(F.col("o_orderkey") % 7 == 0, "NaN").otherwise(F.col("o_orderpriority")).alias(
            "o_orderpriority"
        ),
    )
    _write_csv(source, path)
    loaded = bronze.load_csv(spark, path, RUN_TS, multi_line=False)
    return loaded.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        "o_orderpriority",
        "ingestion_date",
        F.col("source_file").endswith(".csv").alias("has_file"),
    )


def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, with their quotes, commas and line breaks, through CSV and back."""
    path = scratch_dir(spark, "csv")
    _write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_text_csv(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def csv_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts in two files' line ends: every second document goes to files with CRLF."""
    path = scratch_dir(spark, "csv")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    escaped = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    lines = documents.select(
        # A missing value is an empty field (a line without fields would be skipped); the text of a missing id finds a file.
        F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(escaped, F.lit(""))).alias("line"),
        F.pmod(F.coalesce("doc_id", F.xxhash64("text")), F.lit(MIXED_FILES)).cast("int").alias("file"),
        F.lit(1).alias("place"),
    )
    headers = spark.range(MIXED_FILES).select(
        F.lit("doc_id,text").alias("line"), F.col("id").cast("int").alias("file"), F.lit(0).alias("place")
    )
    # Lines are put together here, as Spark's CSV writer would turn the LF in quotes into CRLF.
    rows = headers.union(lines).repartition(MIXED_FILES, "file").sortWithinPartitions("file", "place").drop("place")
    for rest, end in enumerate(("\n", "\r\n")):
        rows.where(F.col("file") % 2 == rest).write.partitionBy("file").text(f"{path}/{rest}", lineSep=end)
    loaded = read_text_csv(spark, f"{path}/*/*")
    return loaded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _prefix(root: str) -> str:
    """Database prefix of its own for a scratch folder."""
    return f"run_{root.rsplit('-', 1)[1]}_"


def replace_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded twice holds the rows of the second load only."""
    root = scratch_dir(spark, "replace")
    store = LayerStore(spark, root, prefix=_prefix(root))
    store.create_layer("bronze")
    customers = table(spark, sf_dir, "customer")
    store.replace("bronze", "customers", customers.where("c_acctbal < 0"))
    return store.replace("bronze", "customers", customers.select("c_custkey", "c_mktsegment"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event, with one to three records and their number."""
    one_to_three = F.sequence(F.lit(1), (F.col("event_id") % 3 + 1).cast("int"))
    records = F.transform(
        one_to_three,
        lambda i: F.struct(
            F.col("event_type").alias("craft"),
            F.concat_ws("-", F.col("user_id").cast("string"), i.cast("string")).alias("name"),
        ),
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(F.struct(F.size(records).alias("number"), records.alias("people"))).alias("doc"),
    )


def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


def json_records_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parse_documents(_documents(spark, sf_dir), "doc").drop("doc")
    return people.person_rows(people.count_matches(documents))


def row_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parse_documents(_documents(spark, sf_dir), "doc")
    return people.messages(documents).select("event_id", "message")


def people_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as JSON files and read through the source with the fallback."""
    path = scratch_dir(spark, "json")
    _documents(spark, sf_dir).select("doc").write.text(path)
    rows = people.person_rows(documents_or_fallback(spark, path))
    return rows.groupBy("craft", "number").agg(F.count("*").alias("n"))


# --- reports ----------------------------------------------------------------------------------


def _report(build, *dims, **parameters):
    """Query that applies a report to the fact and the named dimension queries."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        count_on = {"count_on": raw.raw_items(spark, sf_dir)} if dims else {}
        tables = (fact(spark, sf_dir), *(dim(spark, sf_dir) for dim in dims))
        return build(*tables, **parameters, **count_on)

    return query


def _calendar_report(*attributes: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The days' counts hold the calendar's bounds, so the fact is gone through once.
        days = kpi.late_by_day(fact(spark, sf_dir))
        calendar = gold.dim_date(days, "first_purchase", last="last_purchase")
        return kpi.days_by_calendar(days, calendar, *attributes)

    return query


def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of the raw tables through all layers; late share by seller from the stored fact."""
    root = scratch_dir(spark, "layers")
    for name, build in (
        ("orders", raw.raw_orders),
        ("order_items", raw.raw_items),
        ("products", raw.raw_products),
        ("sellers", raw.raw_sellers),
        ("geolocation", raw.raw_geolocation),
    ):
        _write_csv(build(spark, sf_dir), f"{root}/data/raw_{name}_dataset.csv")
    store = layers.run(
        spark, f"{root}/data", f"{root}/tables", prefix=_prefix(root), multi_line=False
    )
    return kpi.late_by_seller(layers.star(store)["orders_fact"])


QUERIES = {
    "dedup_latest_item": dedup_latest_item,
    "dedup_latest_event": dedup_latest_event,
    "dedup_any_product": dedup_any_product,
    "dedup_any_seller": dedup_any_seller,
    "silver_orders": _processed(silver.orders, raw.raw_orders),
    "silver_items": _processed(silver.orders_items, raw.raw_items),
    "silver_products": _processed(silver.products, raw.raw_products),
    "silver_sellers": _processed(silver.sellers, raw.raw_sellers),
    "delay_fractional": delay_fractional,
    "initcap_words": initcap_words,
    "initcap_documents": initcap_documents,
    "casts_from_text": casts_from_text,
    "csv_roundtrip": csv_roundtrip,
    "csv_quoted_text": csv_quoted_text,
    "csv_mixed_files": csv_mixed_files,
    "replace_load": replace_load,
    "gold_fact": fact,
    "gold_dim_sellers": dim_sellers,
    "gold_dim_products": dim_products,
    "gold_dim_date": dim_date,
    "star_join": star_join,
    "dim_date_of_events": dim_date_of_events,
    "calendar_at_midnight": calendar_at_midnight,
    "kpi_sla": _report(kpi.sla),
    "kpi_late_of_all_orders": lambda spark, sf_dir: kpi.late_share_of_all_orders(
        orders(spark, sf_dir)
    ),
    "kpi_late_by_region": _report(kpi.late_by_region, dim_sellers),
    "kpi_late_by_category": _report(kpi.late_by_category, dim_products),
    "kpi_late_by_seller": _report(kpi.late_by_seller),
    "kpi_late_grouping_sets": _report(kpi.late_by_all, dim_products, dim_sellers),
    "kpi_avg_delay_seller": _report(kpi.average_delay_by_seller),
    "kpi_avg_delay_category": _report(kpi.average_delay_by_category, dim_products),
    "kpi_avg_delay_region": _report(kpi.average_delay_by_region, dim_sellers),
    "kpi_seller_ranking": _report(kpi.seller_ranking),
    "kpi_top_offenders": _report(kpi.top_offenders),
    "kpi_top_categories": _report(kpi.top_categories, dim_products),
    "kpi_top_regions": _report(kpi.top_regions, dim_sellers),
    "kpi_top_by_avg_delay_seller": _report(kpi.top_sellers_by_delay),
    "kpi_top_by_avg_delay_category": _report(kpi.top_categories_by_delay, dim_products),
    "kpi_late_by_month": _calendar_report("year", "month"),
    "kpi_late_by_weekend": _calendar_report("is_weekend"),
    "kpi_late_by_weekday": _calendar_report("day_of_week", "day_name"),
    "kpi_delay_by_volume": _report(
        kpi.late_by_size, dim_products, measure="product_volume_cm3", bounds=VOLUME_BOUNDS
    ),
    "kpi_delay_by_weight": _report(
        kpi.late_by_size, dim_products, measure="weight_g", bounds=WEIGHT_BOUNDS
    ),
    "kpi_late_by_volume_quartile": _report(kpi.late_by_quantile, dim_products, measure="product_volume_cm3"),
    "kpi_late_by_weight_quartile": _report(kpi.late_by_quantile, dim_products, measure="weight_g"),
    "kpi_late_by_freight_quartile": _report(kpi.late_by_quantile, dim_products, measure="freight_value"),
    "kpi_delay_trend": _report(kpi.delay_trend, dim_products),
    "json_field": json_field,
    "json_records_inline": json_records_inline,
    "row_message": row_message,
    "people_documents": people_documents,
    "layers_end_to_end": layers_end_to_end,
}
